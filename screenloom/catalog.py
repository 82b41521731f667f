"""Every operator as a query over the given tables, with its SQL where SQL can express it.

The tables stand in for a screen: lineitem has the counts (orders are cells, parts genes, suppliers guides), documents the reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import expressions as ex
from .operators import effects, evaluation, genomics, guides, models, order, pairs, qc, sequences, statistics
from .plans import store

STEPS = [10, 50, 100, 150]
LIMIT = 100_000
RESULT_DIGITS = 6
Q_DIGITS = 9
PART_ROWS = 200_000  # rows of lineitem for each partition of counts and of pairs
HALF = 1e-12  # so that a value between two rounded ones goes up in any engine


class Screen:
    """The screen's tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def parts(self) -> int:
        """Partitions for counts and pairs, so that a task's sums stay in memory: a pass over the files' row counts."""
        return -(-self.table("lineitem").count() // PART_ROWS)

    @cached_property
    def counts(self) -> DataFrame:
        """Counts, dealt by cell alone: sums by cell and joins on it need no further shuffle."""
        return store.dealt(self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", self.parts).groupBy(F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").cast("long").alias("n"))

    @cached_property
    def guide_counts(self) -> DataFrame:
        return store.dealt(self.table("lineitem").select("l_orderkey", "l_suppkey"), "l_orderkey", self.parts).groupBy(F.col("l_orderkey").alias("cell"), F.col("l_suppkey").alias("guide")).agg(F.count("*").alias("n"))

    @cached_property
    def assigned(self) -> DataFrame:
        return self.guide_counts.select("cell", "guide")

    @cached_property
    def cells(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("cell"), F.col("o_orderpriority").alias("batch"))

    @cached_property
    def genes(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("gene"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("chr"), (F.col("p_partkey") * 1000).alias("pos"), (F.col("p_type") == "SMALL").alias("mt"))

    @cached_property
    def guides(self) -> DataFrame:
        own = F.floor(F.col("s_suppkey") / 4) * 20
        control = F.col("s_nationkey") % 5 == 0
        return self.table("supplier").select(
            F.col("s_suppkey").alias("guide_id"), F.col("s_name").alias("name"), F.concat(F.lit("Brand#"), (F.col("s_nationkey") + 1).cast("string")).alias("chr"), (F.col("s_suppkey") * 20000).alias("pos"),
            control.alias("control"), F.when(control, ex.CONTROL).otherwise(F.concat(F.lit("G"), own.cast("string"))).alias("target"), F.when(~control, own).alias("target_gene"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return qc.cell_metrics(self.counts, self.genes)

    @cached_property
    def effects(self) -> DataFrame:
        return effects.effects(self.counts, self.assigned, self.cells, digits=RESULT_DIGITS, parts=self.parts).withColumnRenamed("guide", "guide_id")

    @cached_property
    def kept_effects(self) -> DataFrame:
        """The effects, worked out once for a query that reads them several times."""
        return store.written(self.effects, "effects")

    @cached_property
    def results(self) -> DataFrame:
        return statistics.bh(self.kept_effects, "p_value").withColumn("q_value", F.round(F.col("q_value") + HALF, Q_DIGITS))

    @cached_property
    def rejected(self) -> Column:
        """Whether a result is rejected at 0.05: by the largest rejected p, without an order of all results."""
        return F.coalesce(F.col("p_value") <= F.lit(statistics.rejection_cut(self.kept_effects, "p_value", 0.05)), F.lit(False))

    @cached_property
    def edges(self) -> DataFrame:
        return self.kept_effects.where("abs(z) >= 3").select(F.concat(F.lit("s"), F.col("guide_id").cast("string")).alias("src"), F.concat(F.lit("g"), F.col("gene").cast("string")).alias("dst"), F.abs("log2_fc").alias("w"))

    @cached_property
    def reads(self) -> DataFrame:
        return self.table("documents").where("text is not null").select(F.col("doc_id").alias("read_id"), F.col("text").alias("seq"))

    @cached_property
    def spacers(self) -> DataFrame:
        """Guides in the reads' own alphabet: the benchmark's items, each text once."""
        return self.table("benchmark").where("text <> ''").groupBy(F.col("text").alias("spacer")).agg(F.min("item_id").alias("guide_order"))

    @cached_property
    def peaks(self) -> DataFrame:
        return self.guides.select(F.col("guide_id").alias("id"), "chr", (F.col("pos") - 3000).alias("start"), (F.col("pos") + 3000).alias("stop"))

    @cached_property
    def tags(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("cell"), F.concat("l_returnflag", "l_linestatus").alias("feature")).agg(F.sum("l_quantity").cast("long").alias("n"))


Query = Callable[[Screen], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

PRE = """
gc AS MATERIALIZED (SELECT l_orderkey AS cell, l_partkey AS gene, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2),
gu AS MATERIALIZED (SELECT l_orderkey AS cell, l_suppkey AS guide, count(*) AS n FROM lineitem GROUP BY 1, 2),
cells AS (SELECT o_orderkey AS cell, o_orderpriority AS batch FROM orders),
genes AS (SELECT p_partkey AS gene, p_name AS symbol, p_brand AS chr, p_partkey * 1000 AS pos, p_type = 'SMALL' AS mt FROM part),
guides AS (SELECT s_suppkey AS guide_id, s_name AS name, 'Brand#' || (s_nationkey + 1) AS chr, s_suppkey * 20000 AS pos, s_nationkey % 5 = 0 AS control,
  CASE WHEN s_nationkey % 5 = 0 THEN 'non-targeting' ELSE 'G' || (s_suppkey // 4 * 20) END AS target, CASE WHEN s_nationkey % 5 <> 0 THEN s_suppkey // 4 * 20 END AS target_gene FROM supplier),
metrics AS (SELECT cell, CAST(sum(n) AS BIGINT) AS total, count(*) AS detected, round(100.0 * sum(CASE WHEN mt THEN n ELSE 0 END) / sum(n), 6) AS percent_mt, round(ln(1 + sum(n)), 6) AS log_total FROM gc JOIN genes USING (gene) GROUP BY cell),
"""
EFFECTS = """
size1 AS (SELECT guide, count(*) AS m FROM gu GROUP BY guide),
gene_sum AS (SELECT gene, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS q FROM gc GROUP BY gene),
own AS MATERIALIZED (SELECT guide, gene, sum(gc.n)::DOUBLE AS s1, sum(gc.n * gc.n)::DOUBLE AS q1 FROM gc JOIN gu USING (cell) GROUP BY 1, 2),
raw AS (SELECT guide AS guide_id, gene, m AS cells, s1 / m AS m1, (s - s1) / (t - m) AS m0, (q1 - s1 * s1 / m) / nullif(m - 1, 0) AS v1, (q - q1 - (s - s1) * (s - s1) / (t - m)) / nullif(t - m - 1, 0) AS v0, t - m AS r
  FROM own JOIN gene_sum USING (gene) JOIN size1 USING (guide), (SELECT count(*) AS t FROM cells)),
zed AS (SELECT *, (m1 - m0) / nullif(sqrt(v1 / cells + v0 / r), 0) AS z0 FROM raw),
tee AS (SELECT *, 1 / (1 + 0.3275911 * abs(z0) / sqrt(2)) AS t0 FROM zed),
eff AS MATERIALIZED (SELECT guide_id, gene, cells, round(log2((m1 + 0.01) / (m0 + 0.01)), 6) AS log2_fc, round(z0, 6) AS z,
  round(t0 * (0.254829592 + t0 * (-0.284496736 + t0 * (1.421413741 + t0 * (-1.453152027 + t0 * 1.061405429)))) * exp(-z0 * z0 / 2), 6) AS p_value FROM tee),
bhr AS (SELECT p_value AS p, count(*) AS c FROM eff WHERE p_value IS NOT NULL GROUP BY 1),
bhq AS (SELECT p, p * sum(c) OVER () / sum(c) OVER (ORDER BY p) AS q0 FROM bhr),
bhm AS MATERIALIZED (SELECT p, round(least(1.0, min(q0) OVER (ORDER BY p DESC)) + 1e-12, 9) AS q_value FROM bhq),
res AS (SELECT guide_id, gene, cells, log2_fc, z, p_value, q_value FROM eff LEFT JOIN bhm ON p = p_value),
"""


def query(sql: str | None = None, with_effects: bool = False):
    """Register a query under its function's name, with the SQL of its rows; it may use the tables of PRE and EFFECTS."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            head, _, body = sql.rpartition("@@")
            _SQL[f.__name__] = "WITH " + (PRE + (EFFECTS if with_effects else "") + head).rstrip().rstrip(",") + " " + body
        return f

    return add


@query("SELECT * FROM metrics")
def cell_metrics(s):
    return s.metrics


@query("SELECT gene, count(*) AS cells, CAST(sum(n) AS BIGINT) AS total FROM gc GROUP BY gene")
def gene_detection(s):
    return qc.gene_detection(s.counts)


@query("SELECT * FROM metrics WHERE percent_mt < 20")
def mito_pct_filter(s):
    return qc.mito_filter(s.metrics, 20.0)


@query("SELECT gene, count(*) AS cells, CAST(sum(n) AS BIGINT) AS total FROM gc GROUP BY gene HAVING count(*) > (SELECT floor(count(DISTINCT cell) * 0.002) FROM gc)")
def gene_fraction_filter(s):
    return qc.fraction_filter(s.counts, 0.002)


def _seven(c: str) -> str:
    return f"round(median({c}), 6) AS {c}_median, round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max, round(quantile_cont({c}, 0.25), 6) AS {c}_q25, round(quantile_cont({c}, 0.75), 6) AS {c}_q75"


@query(f"SELECT coalesce(batch, 'all') AS batch, count(*) AS n_cells, {_seven('total')}, {_seven('detected')} FROM metrics JOIN cells USING (cell) GROUP BY GROUPING SETS ((batch), ())")
def batch_summary_grouping_sets(s):
    return qc.summaries(s.metrics.join(s.cells, "cell"), ["total", "detected"])


@query("SELECT cell, coalesce(g.guides, 0) AS guides, coalesce(g.umis, 0) AS guide_umis FROM cells LEFT JOIN (SELECT cell, count(*) AS guides, CAST(sum(n) AS BIGINT) AS umis FROM gu GROUP BY cell) g USING (cell)")
def guide_cell_counts(s):
    return qc.guide_metrics(s.cells, s.guide_counts)


@query("SELECT round(avg(coalesce(k, 0)), 6) AS mean_guides, CASE WHEN avg(coalesce(k, 0)) > 1.5 THEN 'high' ELSE 'low' END AS moi FROM cells LEFT JOIN (SELECT cell, count(*) AS k FROM gu GROUP BY cell) USING (cell)")
def moi_call(s):
    return qc.moi(s.cells, s.assigned)


@query("SELECT CAST(t AS INT) AS threshold, count(*) FILTER (total > t) AS cells FROM metrics, (SELECT unnest([10, 50, 100, 150]) AS t) GROUP BY t")
def umi_threshold_ladder(s):
    return qc.ladder(s.metrics, "total", STEPS)


RANKS = "ranks AS (SELECT cell, total, row_number() OVER (ORDER BY total DESC, cell) AS rank, log_total FROM metrics),"
KNEE = RANKS + """ ends AS (SELECT min(rank) AS r0, max(rank) AS r1, arg_min(log_total, rank) AS y0, arg_max(log_total, rank) AS y1 FROM ranks),
far AS (SELECT rank, total, round(abs((y1 - y0) * (rank - r0) - (r1 - r0) * (log_total - y0)) / sqrt((r1 - r0) * (r1 - r0) + (y1 - y0) * (y1 - y0)), 6) AS distance FROM ranks, ends),
knee AS (SELECT * FROM far ORDER BY distance DESC, rank LIMIT 1),"""


@query(RANKS + "@@SELECT * FROM ranks")
def barcode_rank(s):
    return qc.barcode_rank(s.metrics)


@query(KNEE + "@@SELECT * FROM knee")
def knee_point(s):
    return qc.knee(qc.barcode_rank(s.metrics))


@query(KNEE + "@@SELECT * FROM metrics WHERE total >= (SELECT total FROM knee)")
def knee_filter(s):
    return qc.knee_filter(s.metrics)


@query("SELECT cell FROM metrics INTERSECT SELECT cell FROM gu INTERSECT SELECT cell FROM cells")
def barcode_intersection(s):
    return s.metrics.select("cell").intersect(s.assigned.select("cell")).intersect(s.cells.select("cell"))


@query("""steps AS (SELECT 0 AS step, 'all' AS name, count(*) AS cells FROM cells UNION ALL SELECT 1, 'counted', count(*) FROM metrics UNION ALL SELECT 2, 'mito', count(*) FROM metrics WHERE percent_mt < 20
UNION ALL SELECT 3, 'guides', count(*) FROM metrics WHERE percent_mt < 20 AND cell IN (SELECT cell FROM gu)),@@SELECT *, coalesce(lag(cells) OVER (ORDER BY step) - cells, 0) AS removed FROM steps""")
def cell_funnel(s):
    return qc.funnel(s.cells, s.metrics, s.assigned, 20.0)


@query("SELECT event_id, coalesce(lower(trim(v)) IN ('true', '1', 't', 'yes'), true) AS value FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN ' YES' WHEN 2 THEN NULL WHEN 3 THEN '0' WHEN 4 THEN 't' ELSE 'x' END AS v FROM events)")
def bool_normalize(s):
    k = F.col("event_id") % 6
    text = F.when(k == 0, "True").when(k == 1, " YES").when(k == 3, "0").when(k == 4, "t").when(k == 5, "x")
    return s.table("events").select("event_id", ex.is_true(text).alias("value"))


@query("SELECT guide_id, control OR target = 'non-targeting' AS is_control FROM guides")
def control_mask(s):
    return s.guides.select("guide_id", ex.is_control(~F.col("control"), F.lit(None).cast("string"), F.col("target")).alias("is_control"))


SIZE = "size AS (SELECT CAST(greatest(1, floor(median(n))) AS BIGINT) AS size FROM (SELECT count(*) AS n FROM guides WHERE NOT control GROUP BY target)),"


@query(SIZE + "@@SELECT size FROM size")
def median_guides_per_target(s):
    return guides.guides_per_target(s.guides)


@query(SIZE + "b AS (SELECT guide_id, (row_number() OVER (ORDER BY guide_id) - 1) // size + 1 AS g FROM guides, size WHERE control),@@SELECT guide_id, 'non-targeting|' || g AS target, 'non-targeting' AS chr, g AS \"start\", g AS \"end\" FROM b")
def control_buckets(s):
    return guides.control_buckets(s.guides)


@query("SELECT guide_id, CASE WHEN guide_id % 7 = 0 THEN 'name_only::' || target ELSE 'coords::' || target || '::' || chr || '::' || pos || '::' || (pos + 20) END AS key FROM guides")
def target_keys(s):
    end = F.when(F.col("guide_id") % 7 != 0, (F.col("pos") + 20).cast("double"))
    return s.guides.select("guide_id", ex.target_key(F.col("target"), F.col("chr"), F.col("pos").cast("double"), end).alias("key"))


NEAR = f"near AS (SELECT guide_id, gene, g.chr, abs(g.pos - u.pos) AS distance FROM guides u JOIN genes g ON g.chr = u.chr AND abs(g.pos - u.pos) <= {LIMIT}),"


@query(NEAR + "@@SELECT n.guide_id, gene, coalesce(CASE WHEN gene % 2 = 0 THEN 'own' END, target) AS target, coalesce(CASE WHEN gene % 3 = 0 THEN 'chrX' END, u.chr) AS chr FROM near n JOIN guides u USING (guide_id)")
def pairs_enrich_coalesce(s):
    near = pairs.within_distance(s.guides, s.genes, LIMIT).select("guide_id", "gene", F.when(F.col("gene") % 2 == 0, "own").alias("target"), F.when(F.col("gene") % 3 == 0, "chrX").alias("chr"))
    return pairs.enriched(near, s.guides)


@query("SELECT s_suppkey AS guide_id, s_name AS name, n_name AS nation, r_name AS region FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def validated_merge(s):
    from .plans.checks import require_unique

    nation = require_unique(s.table("nation"), "n_nationkey")
    joined = s.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(s.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select(F.col("s_suppkey").alias("guide_id"), F.col("s_name").alias("name"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("SELECT cell, min(target) AS target, string_agg(name, '|' ORDER BY name) AS collapsed FROM gu JOIN guides ON guide = guide_id GROUP BY cell HAVING count(DISTINCT target) = 1 AND count(*) BETWEEN 2 AND 2")
def collapse_guides(s):
    named = s.assigned.join(s.guides.select(F.col("guide_id").alias("guide"), "name"), "guide").select("cell", F.col("name").alias("guide"))
    return guides.collapse(named, s.guides.select(F.col("name").alias("guide_id"), "target"))


@query(NEAR + "@@SELECT * FROM near")
def pairs_by_distance(s):
    return pairs.within_distance(s.guides, s.genes, LIMIT)


@query("SELECT guide_id, gene FROM guides, genes")
def pairs_all(s):
    return pairs.all_pairs(s.guides, s.genes)


@query(NEAR + "@@SELECT cell, count(*) AS guides FROM gu WHERE guide IN (SELECT guide_id FROM near UNION SELECT guide_id FROM guides WHERE control) GROUP BY cell")
def cis_subset(s):
    return pairs.cis_cells(pairs.within_distance(s.guides, s.genes, LIMIT), s.guides, s.assigned)


@query(NEAR + "@@SELECT guide_id, gene FROM near WHERE gene IN (SELECT gene FROM genes WHERE NOT mt) AND guide_id IN (SELECT guide_id FROM guides WHERE NOT control)")
def pairs_semi_filter(s):
    near = pairs.within_distance(s.guides, s.genes, LIMIT).select("guide_id", "gene")
    return pairs.present(near, s.genes.where("not mt"), s.guides.where("not control")).select("guide_id", "gene")


@query("SELECT * FROM eff", True)
def perturbation_effects(s):
    return s.effects


#: Element effects as one query over tu, without names of their own.
ELEMENT_ROWS = """WITH size1 AS (SELECT guide, count(*) AS m FROM tu GROUP BY guide), own AS (SELECT guide, gene, sum(gc.n)::DOUBLE AS s1, sum(gc.n * gc.n)::DOUBLE AS q1 FROM gc JOIN tu USING (cell) GROUP BY 1, 2),
raw AS (SELECT guide AS target, gene, m AS cells, s1 / m AS m1, (s - s1) / (t - m) AS m0, (q1 - s1 * s1 / m) / nullif(m - 1, 0) AS v1, (q - q1 - (s - s1) * (s - s1) / (t - m)) / nullif(t - m - 1, 0) AS v0, t - m AS r
  FROM own JOIN gene_sum USING (gene) JOIN size1 USING (guide), (SELECT count(*) AS t FROM cells)), zed AS (SELECT *, (m1 - m0) / nullif(sqrt(v1 / cells + v0 / r), 0) AS z0 FROM raw), tee AS (SELECT *, 1 / (1 + 0.3275911 * abs(z0) / sqrt(2)) AS t0 FROM zed)
SELECT target, gene, round(log2((m1 + 0.01) / (m0 + 0.01)), 6) AS log2_fc, round(t0 * (0.254829592 + t0 * (-0.284496736 + t0 * (1.421413741 + t0 * (-1.453152027 + t0 * 1.061405429)))) * exp(-z0 * z0 / 2), 6) AS p_value FROM tee"""
ELEMENTS = EFFECTS.replace("gu GROUP BY guide", "tu GROUP BY guide").replace("JOIN gu USING (cell)", "JOIN tu USING (cell)").split("bhr AS")[0]


@query("tu AS (SELECT DISTINCT cell, target AS guide FROM gu JOIN guides ON guide = guide_id)," + ELEMENTS + "@@SELECT guide_id AS target, gene, cells, log2_fc, z, p_value FROM eff")
def element_effects(s):
    return effects.effects(s.counts, effects.by_target(s.assigned, s.guides), s.cells, unit="target", parts=s.parts)


@query("tu AS (SELECT DISTINCT cell, target AS guide FROM gu JOIN guides ON guide = guide_id)," + EFFECTS.split("bhr AS")[0] + "el AS (SELECT * FROM (" + ELEMENT_ROWS + """)),
b AS (SELECT u.guide_id, gene, log2_fc AS b_log2_fc, p_value AS b_p_value FROM el JOIN guides u USING (target)), a AS (SELECT guide_id, gene, log2_fc AS a_log2_fc, p_value AS a_p_value FROM eff),
@@SELECT coalesce(a.guide_id, b.guide_id) AS guide_id, coalesce(a.gene, b.gene) AS gene, a_log2_fc, a_p_value, b_log2_fc, b_p_value FROM a FULL JOIN b ON a.guide_id = b.guide_id AND a.gene = b.gene""")
def merge_methods_outer(s):
    """Results by guide and results by element, laid to the element's guides: many pairs have the latter alone."""
    return effects.by_guide_and_target(s.counts, s.assigned, s.cells, s.guides, RESULT_DIGITS, s.parts)


@query("""a AS (SELECT CASE WHEN NOT control THEN target END AS element, chr, count(*) AS a_n FROM guides GROUP BY 1, 2), b AS (SELECT CASE WHEN NOT mt THEN 'G' || gene END AS element, chr, count(*) AS b_n FROM genes GROUP BY 1, 2),
@@SELECT coalesce(a.element, b.element) AS element, coalesce(a.chr, b.chr) AS chr, a_n, b_n FROM a FULL JOIN b ON a.element IS NOT DISTINCT FROM b.element AND a.chr IS NOT DISTINCT FROM b.chr""")
def merge_methods_nullsafe(s):
    """Guides by element and genes by element, both by chromosome; controls and flagged genes have no element, and those meet."""
    a = s.guides.groupBy(F.when(~F.col("control"), F.col("target")).alias("element"), "chr").agg(F.count("*").alias("n"))
    b = s.genes.groupBy(F.when(~F.col("mt"), F.concat(F.lit("G"), F.col("gene").cast("string"))).alias("element"), "chr").agg(F.count("*").alias("n"))
    return effects.merged(a, b, ["element", "chr"], null_safe=True)


@query("SELECT (r - 1) // 300 AS chunk, min(r) AS first, max(r) AS last, count(*) AS genes FROM (SELECT row_number() OVER (ORDER BY gene) AS r FROM genes) GROUP BY 1")
def chunk_manifest(s):
    return guides.chunks(s.genes, 300)


@query("""r AS (SELECT row_number() OVER (ORDER BY gene) AS r FROM genes), t AS (SELECT count(*) AS n, count(*) > 300 AND count(*) * (SELECT count(*) FROM cells) > 2147483647 AS cut FROM genes),
@@SELECT 'auto' AS mode, CASE WHEN cut THEN (r - 1) // 300 ELSE 0 END AS chunk, min(r) AS first, max(r) AS last, count(*) AS genes FROM r, t GROUP BY 2""")
def chunk_plan_auto(s):
    return guides.planned_chunks(s.genes, s.cells.count(), 300)


@query("""t AS (SELECT count(*) AS n, CAST(ceil(count(*) / 300.0) AS BIGINT) AS k FROM genes), r AS (SELECT row_number() OVER (ORDER BY gene) - 1 AS r FROM genes),
@@SELECT CASE WHEN r < n % k * (n // k + 1) THEN r // (n // k + 1) ELSE n % k + (r - n % k * (n // k + 1)) // (n // k) END AS chunk, min(r) AS start, max(r) + 1 AS stop FROM r, t GROUP BY 1""")
def balanced_chunks(s):
    return guides.balanced_chunks(s.genes, 300)


@query("SELECT gene, symbol, chr FROM (SELECT *, count(*) OVER (PARTITION BY symbol, chr) AS k FROM genes) WHERE k > 1")
def duplicate_keys(s):
    return order.repeated_keys(s.genes.select("gene", "symbol", "chr"), ["symbol", "chr"])


@query("SELECT gene, symbol, chr FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY gene) AS k FROM genes) WHERE k = 1")
def dedup_keep_first(s):
    return order.first_per_key(s.genes.select("gene", "symbol", "chr"), ["symbol"], ["gene"])


@query("SELECT gene, symbol, CASE WHEN k = 0 THEN symbol ELSE symbol || '-' || k END AS unique_name FROM (SELECT gene, symbol, row_number() OVER (PARTITION BY symbol ORDER BY gene) - 1 AS k FROM genes)")
def unique_gene_names(s):
    return order.unique_names(s.genes.select("gene", "symbol"), "symbol", "gene")


@query("SELECT guide_id, gene, p_value, q_value FROM res", True)
def bh_fdr(s):
    return s.results.select("guide_id", "gene", "p_value", "q_value")


@query("SELECT guide_id, gene, least(1.0, p_value * (SELECT count(p_value) FROM eff)) AS p_bonferroni FROM eff", True)
def bonferroni(s):
    return statistics.bonferroni(s.effects, "p_value").select("guide_id", "gene", "p_bonferroni")


@query("""k AS (SELECT guide_id, p_value AS p, count(*) AS c FROM eff WHERE p_value IS NOT NULL GROUP BY 1, 2),
k0 AS (SELECT guide_id, p, p * sum(c) OVER (PARTITION BY guide_id) / sum(c) OVER (PARTITION BY guide_id ORDER BY p) AS q0 FROM k),
k1 AS (SELECT guide_id, p, round(least(1.0, min(q0) OVER (PARTITION BY guide_id ORDER BY p DESC)) + 1e-12, 9) AS q_value FROM k0),
@@SELECT e.guide_id, gene, q_value FROM eff e LEFT JOIN k1 ON k1.guide_id = e.guide_id AND p = p_value""", True)
def bh_by_group(s):
    return statistics.bh(s.effects.select("guide_id", "gene", "p_value"), "p_value", by=["guide_id"]).select("guide_id", "gene", F.round(F.col("q_value") + HALF, Q_DIGITS).alias("q_value"))


PER = """per AS (SELECT guide_id, count(*) AS n_tests, count(*) FILTER (q_value < 0.05) AS n_sig, count(*) FILTER (q_value < 0.05 AND log2_fc > 0) AS n_up, count(*) FILTER (q_value < 0.05 AND log2_fc < 0) AS n_down,
round(median(log2_fc), 7) AS median_fc, max(abs(log2_fc)) AS max_abs_fc, round(count(*) FILTER (q_value < 0.05) / count(*), 6) AS frac_sig FROM res WHERE log2_fc IS NOT NULL AND p_value IS NOT NULL GROUP BY guide_id),"""


@query(PER + "@@SELECT * FROM per", True)
def per_guide_trans(s):
    return evaluation.per_guide(s.kept_effects, s.rejected)


@query(PER + "@@SELECT control, count(*) AS guides, CAST(sum(n_tests) AS BIGINT) AS tests, CAST(sum(n_sig) AS BIGINT) AS sig, round(median(n_sig), 6) AS median_sig, round(avg(n_sig), 6) AS mean_sig FROM per JOIN guides USING (guide_id) GROUP BY control", True)
def overall_trans(s):
    return evaluation.overall(evaluation.per_guide(s.kept_effects, s.rejected), s.guides)


INTENDED = "intended AS (SELECT u.guide_id, target, log2_fc, p_value FROM guides u LEFT JOIN eff e ON e.guide_id = u.guide_id AND gene = target_gene WHERE NOT control),"


@query(INTENDED + "@@SELECT * FROM intended", True)
def intended_target_rows(s):
    return evaluation.intended(s.effects, s.guides)


@query(INTENDED + "@@SELECT count(*) AS guides, count(*) FILTER (p_value < 0.05) AS sig, count(*) FILTER (log2_fc <= log2(0.4)) AS strong, count(*) FILTER (log2_fc <= log2(0.4) AND p_value < 0.05) AS strong_sig, round(median(log2_fc), 7) AS median_fc FROM intended WHERE log2_fc IS NOT NULL AND p_value IS NOT NULL", True)
def knockdown_metrics(s):
    return evaluation.knockdown(evaluation.intended(s.effects, s.guides))


LABELLED = """lab AS (SELECT guide_id, gene, round(1 - p_value, 6) AS score, 1 AS label FROM eff JOIN guides USING (guide_id) WHERE NOT control AND gene = target_gene AND p_value IS NOT NULL
UNION ALL SELECT guide_id, gene, round(1 - p_value, 6), 0 FROM eff JOIN guides USING (guide_id) WHERE control AND p_value IS NOT NULL AND gene IN (SELECT target_gene FROM guides WHERE NOT control)),"""


@query(LABELLED + "@@SELECT * FROM lab", True)
def eval_table_unbalanced(s):
    return evaluation.labelled(s.kept_effects, s.guides)


EVENTS = "lab AS (SELECT value AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events),"
CURVE = """stp AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM lab GROUP BY score),
cur AS (SELECT *, CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp FROM stp),"""


def _scored(s):
    return s.table("events").select(F.col("value").alias("score"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"))


@query(EVENTS + CURVE + "@@SELECT * FROM cur")
def roc_points(s):
    return statistics.curve(_scored(s))


AREAS = """ends AS (SELECT sum(pos) AS ap, sum(neg) AS an FROM stp),
@@SELECT round(sum(neg * (tp + tp - pos) / 2.0) / max(ap * an), 6) AS auroc,
round(sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2.0) / max(ap), 6) AS auprc, CAST(max(ap) AS BIGINT) AS positives, CAST(max(an) AS BIGINT) AS negatives FROM cur, ends"""


@query(EVENTS + CURVE + AREAS)
def roc_auc(s):
    return statistics.areas(_scored(s))


@query(LABELLED + CURVE + AREAS, True)
def pr_auc(s):
    return statistics.areas(evaluation.labelled(s.kept_effects, s.guides))


@query(LABELLED + """neg AS (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5(guide_id || ':' || gene || ':42'), 1, 15))::BIGINT, guide_id, gene) AS k FROM lab WHERE label = 0),
@@SELECT * FROM lab WHERE label = 1 UNION ALL SELECT guide_id, gene, score, label FROM neg WHERE k <= (SELECT count(*) FROM lab WHERE label = 1)""", True)
def eval_table_balanced(s):
    return statistics.balanced(evaluation.labelled(s.kept_effects, s.guides), ["guide_id", "gene"])


@query("SELECT guide_id, gene, log2_fc FROM eff JOIN guides USING (guide_id) WHERE (target, gene) IN (SELECT 'G' || gene, gene + 20 FROM genes)", True)
def validated_links(s):
    known = s.genes.select(F.concat(F.lit("G"), F.col("gene").cast("string")).alias("target"), (F.col("gene") + 20).alias("gene"))
    return s.effects.join(s.guides.select("guide_id", "target"), "guide_id").join(known, ["target", "gene"], "left_semi").select("guide_id", "gene", "log2_fc")


@query("SELECT guide_id, gene, p_value FROM eff ORDER BY p_value NULLS LAST, guide_id, gene LIMIT 1000", True)
def top_hits(s):
    return s.effects.select("guide_id", "gene", "p_value").orderBy(F.asc_nulls_last("p_value"), "guide_id", "gene").limit(1000)


@query("SELECT guide_id, gene, CASE WHEN log2_fc >= 1 AND p_value <= 0.05 THEN 'up' WHEN log2_fc <= -1 AND p_value <= 0.05 THEN 'down' ELSE 'none' END AS class FROM eff", True)
def volcano_classes(s):
    return evaluation.volcano(s.effects)


@query("""d AS (SELECT * FROM eff WHERE log2_fc < 0 AND p_value IS NOT NULL),@@(SELECT guide_id, gene, 'fold' AS "by" FROM d ORDER BY log2_fc, guide_id, gene LIMIT 10) UNION ALL (SELECT guide_id, gene, 'p' FROM d ORDER BY p_value, guide_id, gene LIMIT 10)""", True)
def volcano_labels(s):
    return evaluation.volcano_labels(s.kept_effects)


EDGES = "edges AS (SELECT 's' || guide_id AS src, 'g' || gene AS dst, abs(log2_fc) AS w FROM eff WHERE abs(z) >= 3), deg AS (SELECT node, round(sum(w), 6) AS degree, count(*) AS edges FROM (SELECT src AS node, w FROM edges UNION ALL SELECT dst, w FROM edges) GROUP BY node),"


@query(EDGES + "@@SELECT * FROM deg", True)
def network_degree(s):
    return evaluation.degrees(s.edges)


@query(EDGES + "@@SELECT node, degree FROM deg WHERE node IN (SELECT src FROM edges) ORDER BY degree DESC, node LIMIT 10", True)
def central_nodes(s):
    found = evaluation.degrees(s.edges).join(s.edges.select(F.col("src").alias("node")).distinct(), "node", "left_semi")
    return found.select("node", "degree").orderBy(F.desc("degree"), "node").limit(10)


KNOWN = "known AS (SELECT u.chr AS chr1, u.pos AS start1, g.chr AS chr2, g.pos AS start2, log2_fc, gene = target_gene AS own FROM eff JOIN guides u USING (guide_id) JOIN genes g USING (gene) WHERE log2_fc IS NOT NULL AND p_value IS NOT NULL),"


@query(KNOWN + "@@SELECT chr1, start1, start1 + 1 AS end1, chr2, start2, start2 + 1 AS end2, log2_fc AS score FROM known WHERE NOT own", True)
def bedpe(s):
    return genomics.tracks(s.effects, s.guides, s.genes)[0]


@query(KNOWN + "@@SELECT chr1 AS chr, start1 AS \"start\", start1 + 1 AS \"end\", log2_fc AS score FROM known WHERE own", True)
def bedgraph(s):
    return genomics.tracks(s.effects, s.guides, s.genes)[1]


TSS = "tss AS (SELECT gene AS id, chr, greatest(0, pos - 2000) AS \"start\", pos + 2000 AS stop FROM genes), peaks AS (SELECT guide_id AS id, chr, pos - 3000 AS \"start\", pos + 3000 AS stop FROM guides),"


@query(TSS + "@@SELECT * FROM tss")
def tss_windows(s):
    return genomics.tss_windows(s.genes, 2000)


@query(TSS + "@@SELECT a.id AS a_id, b.id AS b_id, a.chr, least(a.stop, b.stop) - greatest(a.\"start\", b.\"start\") AS overlap FROM tss a JOIN peaks b ON a.chr = b.chr AND a.\"start\" < b.stop AND b.\"start\" < a.stop")
def interval_overlap(s):
    return pairs.overlapping(genomics.tss_windows(s.genes, 2000), s.peaks, 8000)


ENRICH = TSS + """bound AS (SELECT DISTINCT b.chr AS factor, a.id AS gene FROM tss a JOIN peaks b ON a.chr = b.chr AND a."start" < b.stop AND b."start" < a.stop),
tests AS (SELECT chr AS factor, gene, min(p_value) AS p_value FROM eff JOIN guides USING (guide_id) GROUP BY 1, 2),
enr AS (SELECT factor, count(*) AS tests, count(*) FILTER (p_value <= 0.001) AS rejections, count(*) FILTER (b.gene IS NOT NULL) AS targets, count(*) FILTER (p_value <= 0.001 AND b.gene IS NOT NULL) AS overlap FROM tests t LEFT JOIN bound b USING (factor, gene) GROUP BY factor),"""


def _enrichment(s):
    tests = s.effects.join(F.broadcast(s.guides.select("guide_id", F.col("chr").alias("factor"))), "guide_id").groupBy("factor", "gene").agg(F.min("p_value").alias("p_value"))
    bound = genomics.bound_genes(s.genes, s.peaks, 2000).join(s.peaks.select(F.col("id").alias("peak"), F.col("chr").alias("factor")), "peak").select("factor", "gene")
    return genomics.enrichment(tests, bound, 0.001)


@query(ENRICH + "@@SELECT *, round(overlap / nullif(targets, 0), 6) AS recall FROM enr", True)
def tf_enrichment_counts(s):
    return _enrichment(s)


@query(ENRICH + """f AS (SELECT *, rejections AS r, targets AS c, tests AS n FROM enr),
t AS (SELECT factor, k, lgamma(r + 1) - lgamma(k + 1) - lgamma(r - k + 1) + lgamma(n - r + 1) - lgamma(c - k + 1) - lgamma(n - r - c + k + 1) - lgamma(n + 1) + lgamma(c + 1) + lgamma(n - c + 1) AS l FROM f, LATERAL (SELECT unnest(range(overlap, least(r, c) + 1)) AS k) WHERE least(r, c, n - r, n - c) > 0 AND n - r - c + k >= 0),
@@SELECT factor, round(p, 6) AS p_value, CASE WHEN least(r, c, n - r, n - c) > 0 THEN round(overlap * (n - r - c + overlap) / ((r - overlap) * (c - overlap))::DOUBLE, 6) END AS odds_ratio FROM f LEFT JOIN (SELECT factor, least(1.0, sum(exp(l))) AS p FROM t GROUP BY factor) USING (factor)""", True)
def fisher_greater(s):
    e = _enrichment(s)
    cells = [F.col("overlap"), F.col("rejections") - F.col("overlap"), F.col("targets") - F.col("overlap"), F.col("tests") - F.col("rejections") - F.col("targets") + F.col("overlap")]
    return e.select("factor", F.round(statistics.fisher_greater(*cells), 6).alias("p_value"), F.round(statistics.odds_ratio(*cells), 6).alias("odds_ratio"))


@query("x AS (SELECT batch, guide, count(*) AS n FROM gu JOIN cells USING (cell) GROUP BY 1, 2), y AS (SELECT batch, n, row_number() OVER (PARTITION BY batch ORDER BY n, guide) AS i, count(*) OVER (PARTITION BY batch) AS k FROM x),@@SELECT batch, round(sum((2 * i - k - 1) * n) / (max(k) * sum(n)), 6) AS gini FROM y GROUP BY batch")
def gini(s):
    return statistics.gini(s.assigned.join(s.cells, "cell").groupBy("batch", "guide").agg(F.count("*").alias("n")), "n", ["batch"])


@query("SELECT gene, reverse(translate(symbol, 'ACGTacgt', 'TGCAtgca')) AS rc FROM genes")
def reverse_complement(s):
    return s.genes.select("gene", ex.reverse_complement(F.col("symbol")).alias("rc"))


READS = """reads AS (SELECT 'R1_Fwd' AS config, doc_id AS read_id, text AS seq FROM documents WHERE text IS NOT NULL), sp AS (SELECT min(item_id) AS guide_order, text AS spacer FROM benchmark WHERE text <> '' GROUP BY 2),
"""
HITS = """hits AS (SELECT config, read_id, seq, guide_order, spacer, instr(seq, spacer) - 1 AS position FROM (SELECT config, read_id, seq, guide_order, spacer, row_number() OVER (PARTITION BY config, read_id ORDER BY guide_order) AS k FROM reads JOIN sp ON contains(seq, spacer)) WHERE k = 1),
fl AS (SELECT *, lpad(substr(seq, greatest(1, position - 11), least(position, 12)), 12, '-') AS flank FROM hits),"""


@query(READS + HITS + "@@SELECT read_id, guide_order, position FROM hits")
def guide_search(s):
    return sequences.guide_hits(s.reads, s.spacers)


@query(READS + HITS + "@@SELECT read_id, guide_order, position, flank FROM fl")
def upstream_flank_mode(s):
    return sequences.guide_hits(s.reads, s.spacers, flank=12)


ORIENT = HITS + """md AS (SELECT config, position, c FROM (SELECT config, position, count(*) AS c, row_number() OVER (PARTITION BY config ORDER BY count(*) DESC, position) AS k FROM fl GROUP BY 1, 2) WHERE k = 1),
tf AS (SELECT config, max(f) AS f FROM (SELECT config, count(*) AS f FROM fl JOIN md USING (config, position) GROUP BY config, flank) GROUP BY 1), cf AS (SELECT config, count(*) AS r FROM reads GROUP BY 1), ns AS (SELECT count(*) AS k FROM sp),
gs AS (SELECT config, row_number() OVER (PARTITION BY config ORDER BY x, guide_order) AS i, x FROM (SELECT config, guide_order, count(h.read_id) AS x FROM cf CROSS JOIN sp LEFT JOIN hits h USING (config, guide_order) GROUP BY 1, 2)),
gi AS (SELECT config, sum((2 * i - k - 1) * x) / (max(k) * nullif(sum(x), 0)) AS g FROM gs, ns GROUP BY 1), n AS (SELECT config, count(*) AS n FROM hits GROUP BY 1),
sc AS (SELECT config, coalesce(n, 0) AS hits, coalesce(round(n / r, 6), 0.0) AS hit_ratio, coalesce(round(c / n, 6), 0.0) AS position_purity, coalesce(round(f / c, 6), 0.0) AS flank_purity, CASE WHEN n > 0 THEN round(g, 6) ELSE 0.0 END AS gini,
  CASE WHEN n > 0 THEN round(3 * n / r + 2 * c / n + f / c + 1 - g, 6) ELSE 0.0 END AS score FROM cf LEFT JOIN n USING (config) LEFT JOIN md USING (config) LEFT JOIN tf USING (config) LEFT JOIN gi USING (config)),
@@SELECT *, row_number() OVER (ORDER BY score DESC, config) = 1 AS is_winner FROM sc"""


def _oriented(s, reads: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    hits = sizes = None
    for config, (own, spacers) in reads.items():
        one = sequences.guide_hits(own, spacers, flank=12).withColumn("config", F.lit(config))
        size = own.agg(F.count("*").alias("reads")).withColumn("config", F.lit(config))
        hits, sizes = (one, size) if hits is None else (hits.unionByName(one), sizes.unionByName(size))
    return sequences.orientation(store.written(hits, "hits"), sizes, s.spacers)


@query(READS + ORIENT)
def orientation_score(s):
    return _oriented(s, {"R1_Fwd": (s.reads, s.spacers)})


@query("""texts AS (SELECT 'R1' AS r, doc_id AS read_id, text AS seq FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'R2', conv_id * 1000 + turn, text FROM conversations WHERE text IS NOT NULL),
sp AS (SELECT min(item_id) AS guide_order, text AS spacer FROM benchmark WHERE text <> '' GROUP BY 2),
reads AS (SELECT r || '_' || d AS config, read_id, CASE d WHEN 'Fwd' THEN seq ELSE reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) END AS seq FROM texts, (SELECT unnest(['Fwd', 'Rev']) AS d)),""" + ORIENT)
def orientation_winner(s):
    """Both read sets against the guides as they are and against reverse complements: of the reads, so that flanks read in their direction."""
    turns = s.table("conversations").where("text is not null").select((F.col("conv_id") * 1000 + F.col("turn")).alias("read_id"), F.col("text").alias("seq"))
    made = {}
    for name, reads in (("R1", s.reads), ("R2", turns)):
        made[f"{name}_Fwd"] = (reads, s.spacers)
        made[f"{name}_Rev"] = (reads.select("read_id", ex.reverse_complement(F.col("seq")).alias("seq")), s.spacers)
    return _oriented(s, made)


@query(READS + """b AS (SELECT p - 1 AS position, base, count(*) AS n FROM (SELECT unnest(l) AS base, generate_subscripts(l, 1) AS p FROM (SELECT string_split(seq, '') AS l FROM reads WHERE seq <> '')) GROUP BY 1, 2), t AS (SELECT count(*) AS r FROM reads),
@@SELECT CAST(position AS INT) AS position, base, round(sum(n) / max(r), 6) AS share FROM (SELECT * FROM b UNION ALL SELECT position, 'N', (SELECT r FROM t) - sum(n) FROM b GROUP BY 1), t GROUP BY 1, 2 HAVING sum(n) > 0""")
def nucleotide_frequency(s):
    return sequences.base_frequencies(s.reads)


@query("x AS (SELECT l_orderkey AS cell, l_returnflag || l_linestatus AS feature, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2),@@SELECT cell, feature, round(ln(1 + n / exp(sum(ln(1 + n)) OVER (PARTITION BY cell) / 6)), 6) AS clr FROM x")
def clr_transform(s):
    return qc.centred_log_ratio(s.tags, 6)


@query("h AS (SELECT cell, string_agg(DISTINCT feature, '-' ORDER BY feature) AS tag FROM (SELECT l_orderkey AS cell, l_returnflag AS feature FROM lineitem) GROUP BY cell),@@SELECT cell, tag, CASE WHEN contains(tag, '-') THEN 'multiplets' ELSE tag END AS split FROM h WHERE NOT contains(tag, '-')")
def hto_parse(s):
    per = s.table("lineitem").groupBy(F.col("l_orderkey").alias("cell")).agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), "-").alias("tag"))
    return per.withColumn("split", F.when(F.col("tag").contains("-"), "multiplets").otherwise(F.col("tag"))).where((F.col("tag") != "negative") & (F.col("split") != "multiplets"))


@query("""k AS (SELECT DISTINCT cell, control FROM gu JOIN guides ON guide = guide_id), l AS (SELECT cell, 'perturbed' AS label FROM gu WHERE guide = 3 UNION ALL (SELECT cell, 'control' FROM k WHERE control EXCEPT SELECT cell, 'control' FROM k WHERE NOT control)),
@@SELECT cell, label, coalesce(n, 0) AS n FROM l LEFT JOIN (SELECT cell, n FROM gc WHERE gene = 5) USING (cell)""")
def gene_expression_by_guide(s):
    return guides.expression_by_guide(s.counts, s.assigned, s.guides, 3, 5)


@query("SELECT 'n_cells' AS parameter, CAST(count(*) AS VARCHAR) AS value FROM cells UNION ALL SELECT 'n_guides', CAST(count(*) AS VARCHAR) FROM guides")
def runinfo_unpivot(s):
    row = s.cells.agg(F.count("*").alias("n_cells")).crossJoin(s.guides.agg(F.count("*").alias("n_guides")))
    return row.select(F.col("n_cells").cast("string"), F.col("n_guides").cast("string")).unpivot([], ["n_cells", "n_guides"], "parameter", "value")


@query("SELECT event_id, CAST(CAST(json_extract_string(props, '$.k') AS INT) AS BIGINT) AS k FROM events")
def json_values(s):
    return s.table("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT guide_id, coalesce(n, 0) AS cells FROM guides LEFT JOIN (SELECT guide, count(*) AS n FROM gu GROUP BY guide) ON guide = guide_id")
def cells_per_guide(s):
    return guides.assignment_counts(s.guides, s.assigned)


@query("""h AS (SELECT gene, CAST(sum(n) * 1000 AS BIGINT) AS n FROM gc GROUP BY gene), d AS (SELECT gene, n, CAST(pow(10, length(n::VARCHAR) - 3) AS BIGINT) AS d FROM h),
r AS (SELECT gene, (n // d + CASE WHEN n % d * 2 > d OR (n % d * 2 = d AND n // d % 2 = 1) THEN 1 ELSE 0 END) * d AS r FROM d), u AS (SELECT gene, r, CASE WHEN r >= 1e12 THEN 12 WHEN r >= 1e9 THEN 9 WHEN r >= 1e6 THEN 6 ELSE 3 END AS p FROM r),
@@SELECT gene, regexp_replace(printf('%.6f', r / pow(10, p)), '\\.?0+$', '') || CASE p WHEN 3 THEN 'K' WHEN 6 THEN 'M' WHEN 9 THEN 'B' ELSE 'T' END AS text FROM u""")
def human_format(s):
    return s.counts.groupBy("gene").agg((F.sum("n") * 1000).alias("n")).select("gene", ex.human(F.col("n").cast("double")).alias("text"))


@query()
def mixture_assignment(s):
    return models.assign_mixture(s.tags.join(s.cells, "cell").select("batch", "cell", F.when(F.col("feature") == "AF", 1).otherwise(2).cast("long").alias("guide"), "n"))


@query("""gs AS (SELECT gene, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS q FROM gc GROUP BY gene), sz AS (SELECT guide, count(*) AS m FROM gu GROUP BY guide),
ow AS (SELECT guide, gene, sum(gc.n)::DOUBLE AS s1, sum(gc.n * gc.n)::DOUBLE AS q1 FROM gc JOIN gu USING (cell) GROUP BY 1, 2), mo AS (SELECT *, t - m AS rest, s / t AS mean FROM ow JOIN gs USING (gene) JOIN sz USING (guide), (SELECT count(*) AS t FROM cells)),
va AS (SELECT *, greatest((q / t - mean * mean - mean) / greatest(mean * mean, 1e-12), 0) AS spread FROM mo),
@@SELECT guide, gene, round((s1 - m * mean) / sqrt(greatest(m * rest / t * (mean + spread * mean * mean), 1e-12)), 6) AS score_z FROM va""")
def glm_score(s):
    return models.glm_score(effects.sums(s.counts, s.assigned, s.cells, parts=s.parts).select("guide", "gene", *models.moments()))


@query()
def hto_gmm(s):
    values = qc.centred_log_ratio(s.tags, 6).join(s.cells, "cell").select("batch", "cell", F.col("feature").alias("tag"), F.col("clr").alias("value"))
    return models.hashing_tags(values)


@query()
def knee_spline(s):
    ranks = qc.barcode_rank(s.metrics)
    return models.second_knee(ranks, qc.knee(ranks).first()["rank"])


def _vectors(s):
    return s.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))


@query()
def pca_hto(s):
    return models.principal_components(_vectors(s))


@query()
def doublet_scores(s):
    return models.doublet_scores(_vectors(s))


def _register() -> None:
    """The other modules of queries register theirs when they are imported; they import this one."""
    from . import catalog_inputs, catalog_results  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _register()
    return {name: (lambda spark, folder, f=f: f(Screen(spark, folder))) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _register()
    return dict(_SQL)
