"""Queries on what precedes the tests: concatenation, flags, filters, covariates, controls and sample routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import query
from .functions import expressions as ex
from .operators import concat, exports, order, preparation, sequences

BATCHES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
COVARIATES = '{"batch": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "cov1": ["a", "b", "a"]}'


def _of_batches(s, df):
    """One frame for each batch, as files of batches would be."""
    joined = df.join(s.cells, "cell")
    return [joined.where(F.col("batch") == b).drop("batch") for b in BATCHES]


@query("SELECT cell || '_' || (CAST(substr(batch, 1, 1) AS INT) - 1) AS cell, gene, n FROM gc JOIN cells USING (cell)")
def concat_batches(s):
    return concat.with_batches(_of_batches(s, s.counts))


@query("SELECT cell, gene, NULL AS guide, n FROM gc UNION ALL SELECT cell, NULL, guide, n FROM gu")
def concat_outer(s):
    return concat.stacked([s.counts, s.guide_counts]).select("cell", "gene", "guide", "n")


@query("""a AS (SELECT symbol, chr, min(gene) AS gene, 0 AS frame FROM genes GROUP BY 1, 2 UNION ALL SELECT name, chr, guide_id, 1 FROM guides UNION ALL SELECT symbol, chr, max(gene) + 1000000, 2 FROM genes GROUP BY 1, 2),
@@SELECT symbol, chr, gene FROM (SELECT *, row_number() OVER (PARTITION BY symbol, chr ORDER BY frame) AS k FROM a) WHERE k = 1""")
def concat_first_wins(s):
    first = s.genes.groupBy("symbol", "chr").agg(F.min("gene").alias("gene"))
    second = s.guides.select(F.col("name").alias("symbol"), "chr", F.col("guide_id").alias("gene"))
    third = s.genes.groupBy("symbol", "chr").agg((F.max("gene") + 1_000_000).alias("gene"))
    return concat.first_wins([first, second, third], ["symbol", "chr"])


@query("""a AS (SELECT doc_id, text FROM documents), b AS (SELECT doc_id, text FROM documents JOIN labels USING (doc_id)), u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
@@SELECT 'doc_id' AS name, count(*) AS n_rows, count(doc_id) AS filled FROM u UNION ALL SELECT 'text', count(*), count(text) FROM u""")
def shared_columns(s):
    """The columns that both tables have, with how many of all their rows have a value in each."""
    frames = [s.table("documents"), s.table("documents").join(s.table("labels"), "doc_id").select("doc_id", "quality", "text")]
    names = concat.shared_columns(frames)
    both = frames[0].select(names).unionByName(frames[1].select(names))
    counted = both.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in names])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col("n_rows"), F.col(c).alias("filled")) for c in names])).alias("x")).select("x.*")


@query("SELECT guide_id AS guide, target, chr FROM guides")
def renamed_columns(s):
    """Renames, and drops the columns that the table to be joined has too."""
    return concat.renamed(s.guides.select("guide_id", "target", "chr", "pos", "name"), {"guide_id": "guide"}, s.genes.select("pos", F.lit("").alias("name"), "gene"))


SYMBOLS = "sym AS (SELECT p_partkey AS gene, CASE p_type WHEN 'SMALL' THEN 'MT-' || p_name WHEN 'LARGE' THEN 'RPS' || p_name WHEN 'PROMO' THEN 'RPL' || p_name ELSE 'X' || p_name END AS symbol FROM part), flg AS (SELECT *, starts_with(symbol, 'MT-') AS mt, starts_with(symbol, 'RPS') OR starts_with(symbol, 'RPL') AS ribo FROM sym),"


def _symbols(s):
    prefix = F.when(F.col("p_type") == "SMALL", "MT-").when(F.col("p_type") == "LARGE", "RPS").when(F.col("p_type") == "PROMO", "RPL").otherwise("X")
    return s.table("part").select(F.col("p_partkey").alias("gene"), F.concat(prefix, "p_name").alias("symbol"))


@query(SYMBOLS + "@@SELECT * FROM flg")
def gene_flags(s):
    return preparation.gene_flags(_symbols(s))


@query(SYMBOLS + """@@SELECT cell, CAST(sum(n) AS BIGINT) AS total, count(*) AS detected, round(ln(1 + sum(n)), 6) AS log_total, round(ln(1 + count(*)), 6) AS log_detected,
round(100.0 * sum(CASE WHEN mt THEN n ELSE 0 END) / sum(n), 6) AS percent_mt, round(100.0 * sum(CASE WHEN ribo THEN n ELSE 0 END) / sum(n), 6) AS percent_ribo FROM gc JOIN flg USING (gene) GROUP BY cell""")
def cell_shares(s):
    return preparation.cell_shares(s.counts, preparation.gene_flags(_symbols(s)))


@query("SELECT gene, count(*) AS cells, CAST(sum(n) AS BIGINT) AS total, round(sum(n) / max(k), 6) AS mean, round(100.0 * (1 - count(*) / max(k)), 6) AS pct_dropout FROM gc, (SELECT count(*) AS k FROM cells) GROUP BY gene")
def gene_dropout(s):
    return preparation.gene_dropout(s.counts, s.cells)


@query("SELECT cell, gene, n FROM gc WHERE cell IN (SELECT cell FROM gc GROUP BY cell HAVING count(*) >= 4)")
def min_genes_filter(s):
    return preparation.cells_with_genes(s.counts, 4)


@query("SELECT cell, gene, n FROM gc WHERE gene IN (SELECT gene FROM gc GROUP BY gene HAVING count(*) >= 10)")
def min_cells_filter(s):
    return preparation.genes_in_cells(s.counts, 10)


@query("f AS (SELECT batch, row_number() OVER (ORDER BY min(cell), batch) AS batch_number FROM cells GROUP BY batch),@@SELECT cell, batch, batch_number FROM cells JOIN f USING (batch)")
def batch_codes(s):
    return preparation.batch_codes(s.cells, "cell").select("cell", "batch", "batch_number")


@query("SELECT cell, umis, round(ln(1 + umis) - avg(ln(1 + umis)) OVER (), 6) AS centred FROM (SELECT cell, sum(n) AS umis FROM gu GROUP BY cell)")
def centred_covariate(s):
    return preparation.centred(s.guide_counts.groupBy("cell").agg(F.sum("n").alias("umis")), "umis", "centred")


@query("SELECT cell, batch, cov1 FROM cells LEFT JOIN (VALUES ('1-URGENT', 'a'), ('2-HIGH', 'b'), ('3-MEDIUM', 'a')) v(batch, cov1) USING (batch)")
def batch_covariates(s):
    return preparation.with_covariates(s.cells, preparation.covariate_table(s.spark, COVARIATES)).select("cell", "batch", "cov1")


@query("""l AS (SELECT 1 AS i, 'same' AS c, count(DISTINCT 'x') AS k FROM nation UNION ALL SELECT 2, 'n_regionkey', count(DISTINCT n_regionkey) FROM nation
UNION ALL SELECT 3, 'empty', count(DISTINCT CAST(NULL AS VARCHAR)) FROM nation UNION ALL SELECT 4, 'n_name', count(DISTINCT n_name) FROM nation),@@SELECT string_agg(c, ' + ' ORDER BY i) AS formula FROM l WHERE k > 1""")
def covariate_formula(s):
    table = s.table("nation").withColumn("same", F.lit("x")).withColumn("empty", F.lit(None).cast("string"))
    return s.spark.createDataFrame([(preparation.formula(table, ["same", "n_regionkey", "empty", "n_name"]),)], "formula string")


@query("SELECT unnest(['depth', 'batch']) AS covariate")
def independent_covariates(s):
    """`double` is twice depth and `copy` has the levels of batch, so that both would cost the model matrix its rank."""
    table = s.cells.join(s.metrics.select("cell", F.col("total").cast("double").alias("depth")), "cell").withColumn("double", 2 * F.col("depth")).withColumn("copy", F.lower("batch")).withColumn("one", F.lit(1))
    return s.spark.createDataFrame([(c,) for c in preparation.independent(table, ["depth", "double", "one", "batch", "copy"])], "covariate string")


@query("SELECT doc_id AS guide_id, text AS spacer FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
def dropped_incomplete(s):
    docs = s.table("documents")
    return preparation.dropped_without(docs, "doc_id", "text", "lang")[0].select(F.col("doc_id").alias("guide_id"), F.col("text").alias("spacer"))


KINDS = "k AS (SELECT guide_id, CASE guide_id % 3 WHEN 0 THEN NULL WHEN 1 THEN NOT control ELSE true END AS targeting, CASE guide_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Non-Targeting' ELSE 'targeting' END AS kind, CASE guide_id % 5 WHEN 0 THEN 'my NON-targeting x' ELSE target END AS name FROM guides),"


def _kinds(s):
    g = F.col("guide_id")
    targeting = F.when(g % 3 == 1, ~F.col("control")).when(g % 3 == 2, True)
    return s.guides.select("guide_id", targeting.alias("targeting"), F.when(g % 4 == 1, "Non-Targeting").when(g % 4 > 1, "targeting").alias("kind"), F.when(g % 5 == 0, "my NON-targeting x").otherwise(F.col("target")).alias("name"))


@query(KINDS + "@@SELECT guide_id, NOT coalesce(targeting, true) OR coalesce(lower(kind) = 'non-targeting', false) OR coalesce(contains(lower(name), 'non-targeting'), false) AS is_control FROM k")
def control_mask_contains(s):
    return _kinds(s).select("guide_id", preparation.control_by_contains(F.col("targeting"), F.col("kind"), F.col("name")).alias("is_control"))


@query(KINDS + "@@SELECT guide_id, coalesce(kind, CASE WHEN coalesce(targeting, false) THEN 'targeting' ELSE 'non-targeting' END) AS type FROM k")
def filled_types(s):
    return _kinds(s).select("guide_id", preparation.filled_type(F.col("kind"), F.col("targeting")).alias("type"))


@query("SELECT size, count(*) AS elements FROM (SELECT count(*) AS size FROM guides WHERE NOT control GROUP BY target) GROUP BY size")
def guides_per_element(s):
    return preparation.element_sizes(s.guides)


@query("""sz AS (SELECT CAST(greatest(1, floor(median(n))) AS BIGINT) AS size FROM (SELECT count(*) AS n FROM guides WHERE NOT control GROUP BY target)),
@@SELECT guide_id, target AS element FROM guides WHERE NOT control UNION ALL SELECT guide_id, 'non-targeting|' || ((row_number() OVER (ORDER BY guide_id) - 1) // size + 1) FROM guides, sz WHERE control""")
def control_elements_median(s):
    return preparation.control_elements(s.guides, "median")


@query("SELECT guide_id, CASE WHEN control THEN 'non-targeting' ELSE target END AS element FROM guides")
def control_elements_same(s):
    return preparation.control_elements(s.guides, "same")


SHEET = "sheet AS (SELECT s_suppkey AS id, CASE s_nationkey % 3 WHEN 0 THEN 'scRNA sequencing' WHEN 1 THEN 'gRNA sequencing' ELSE 'cell hashing barcode sequencing' END AS file_modality, 'spec' || s_nationkey || '.yml' AS seqspec, CASE WHEN s_suppkey % 2 = 0 THEN 'list' || s_nationkey END AS barcode_onlist FROM supplier), short AS (SELECT id, CASE file_modality WHEN 'scRNA sequencing' THEN 'scRNA' WHEN 'gRNA sequencing' THEN 'gRNA' ELSE 'hash' END AS file_modality, seqspec, barcode_onlist FROM sheet),"


def _sheet(s):
    k = F.col("s_nationkey") % 3
    name = F.when(k == 0, "scRNA sequencing").when(k == 1, "gRNA sequencing").otherwise("cell hashing barcode sequencing")
    nation = F.col("s_nationkey").cast("string")
    return s.table("supplier").select(F.col("s_suppkey").alias("id"), name.alias("file_modality"), F.concat(F.lit("spec"), nation, F.lit(".yml")).alias("seqspec"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("list"), nation)).alias("barcode_onlist"))


@query(SHEET + "@@SELECT id, file_modality, seqspec FROM short")
def modality_recode(s):
    return preparation.recoded(_sheet(s), ["id", "file_modality", "seqspec"])


@query(SHEET + "@@SELECT id, seqspec FROM short WHERE lower(file_modality) = 'scrna'")
def modality_routing(s):
    return preparation.routed(preparation.recoded(_sheet(s), ["id", "file_modality", "seqspec"]), "scRNA").select("id", "seqspec")


@query(SHEET + "@@SELECT lower(file_modality) AS modality, 'seqspec' AS \"column\", min(seqspec) AS value FROM short GROUP BY 1 UNION ALL SELECT lower(file_modality), 'barcode_onlist', min(barcode_onlist) FROM short GROUP BY 1")
def first_metadata(s):
    return preparation.first_values(preparation.recoded(_sheet(s), ["file_modality", "seqspec", "barcode_onlist"]), ["seqspec", "barcode_onlist"])


@query("SELECT batch, string_agg(DISTINCT CAST(o_orderstatus AS VARCHAR), ',' ORDER BY CAST(o_orderstatus AS VARCHAR)) AS files, count(*) AS n FROM (SELECT o_orderpriority AS batch, o_orderstatus FROM orders) GROUP BY batch")
def batch_files(s):
    """The distinct files of each batch as one text."""
    return s.table("orders").groupBy(F.col("o_orderpriority").alias("batch")).agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("files"), F.count("*").alias("n"))


@query("SELECT DISTINCT p_brand AS chr, p_type AS kind, p_size AS size FROM part")
def distinct_rows(s):
    return s.table("part").select(F.col("p_brand").alias("chr"), F.col("p_type").alias("kind"), F.col("p_size").alias("size")).distinct()


@query("SELECT gene, l_partkey IS NOT NULL AS counted, 'G' || gene || '.' || (gene % 7) AS gene_id, symbol FROM genes LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem) ON l_partkey = gene")
def gtf_annotation(s):
    """Genes with the first annotation row of their id, whose version doesn't count: every gene has two rows here, the first with its symbol."""
    rows = s.genes.select((2 * F.col("gene")).alias("row"), F.concat(F.lit("G"), F.col("gene").cast("string"), F.lit("."), (F.col("gene") % 7).cast("string")).alias("gene_id"), "symbol")
    later = rows.select((F.col("row") + 1).alias("row"), F.concat(F.substring_index("gene_id", ".", 1), F.lit(".9")).alias("gene_id"), F.lit("later").alias("symbol"))
    first = order.first_per_key(rows.unionByName(later).withColumn("name", F.substring_index("gene_id", ".", 1)), ["name"], ["row"])
    counted = s.counts.select("gene").distinct().withColumn("counted", F.lit(True))
    named = s.genes.select("gene", F.concat(F.lit("G"), F.col("gene").cast("string")).alias("name")).join(counted, "gene", "left").na.fill(False, ["counted"])
    return named.join(first, "name", "left").select("gene", "counted", "gene_id", "symbol")


@query("SELECT cell, guide, concat_ws('|', name, chr) AS label FROM gu JOIN guides ON guide = guide_id WHERE target LIKE 'G%'")
def one_hot_pairs(s):
    """(cell, guide) pairs that stand for ones of the cell by guide table, zeros left out."""
    named = s.guides.where(F.col("target").startswith("G")).select(F.col("guide_id").alias("guide"), F.concat_ws("|", "name", "chr").alias("label"))
    return exports.crosstab(s.assigned.join(named, "guide"), ["cell", "guide", "label"]).select("cell", "guide", "label")


@query("t AS (SELECT l_orderkey AS cell, min(l_returnflag) AS a, max(l_returnflag) AS b FROM lineitem GROUP BY 1),@@SELECT cell, a AS cluster, CASE WHEN a = b THEN 'HTO1' ELSE 'HTO1-HTO2' END AS hto_type FROM t")
def demux_config(s):
    """Cells of a demultiplexing report with the names of its clusters, whose configuration has blanks to trim."""
    report = s.table("lineitem").groupBy(F.col("l_orderkey").alias("cell")).agg(F.min("l_returnflag").alias("cluster"), F.max("l_returnflag").alias("other")).withColumn("single", F.col("cluster") == F.col("other"))
    config = s.spark.createDataFrame([(c, single, " HTO1" if single else " HTO1-HTO2 ") for c in "ANR" for single in (True, False)], "cluster string, single boolean, hto_type string")
    return report.join(F.broadcast(config), ["cluster", "single"], "left").select("cell", "cluster", F.trim("hto_type").alias("hto_type"))


@query("x AS (SELECT CASE WHEN count(DISTINCT l_returnflag) > 2 THEN 'negative' ELSE string_agg(DISTINCT l_returnflag, '-') END AS tags FROM lineitem GROUP BY l_orderkey),@@SELECT round(100.0 * avg(CASE WHEN tags = 'negative' THEN 1.0 ELSE 0.0 END), 6) AS pct_negative, round(100.0 * avg(CASE WHEN tags <> 'negative' AND NOT contains(tags, '-') THEN 1.0 ELSE 0.0 END), 6) AS pct_singlet, round(100.0 * avg(CASE WHEN contains(tags, '-') THEN 1.0 ELSE 0.0 END), 6) AS pct_multiplet FROM x")
def tag_shares(s):
    tags = s.table("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("t"))
    return tags.select(F.when(F.size("t") > 2, "negative").otherwise(F.array_join("t", "-")).alias("tags")).agg(*exports.tag_shares(F.col("tags")))


@query("SELECT guide_id, printf('%,d', guide_id * 12345) AS thousands, printf('%.1f', guide_id * 100.0 / 128) || '%' AS percent FROM guides")
def number_formats(s):
    return s.guides.select("guide_id", ex.thousands(F.col("guide_id") * 12345).alias("thousands"), ex.percent(F.col("guide_id") / 128).alias("percent"))


@query("SELECT doc_id AS read_id FROM documents WHERE text IS NOT NULL AND ('0x' || substr(md5(doc_id || ':42'), 1, 15))::BIGINT < " + str(int(0.1 * 16**15)))
def fastq_subsample(s):
    """A tenth of the reads by their hash, the same in every run: the sample is what is asked for."""
    return preparation.subsampled(s.reads, 0.1).select("read_id")


@query("SELECT guide_order, substr(spacer, 1, a - 1) || letter || substr(spacer, a + 1) AS variant FROM (SELECT item_id AS guide_order, text AS spacer, unnest(range(1, length(text) + 1)) AS a FROM benchmark), (SELECT unnest(['A', 'C', 'G', 'T']) AS letter) GROUP BY 1, 2")
def mismatch_table(s):
    return sequences.mismatches(s.table("benchmark").select(F.col("item_id").alias("guide_order"), F.col("text").alias("spacer")))
