"""Queries on test results: exports, annotations, networks, evaluation and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import EDGES, INTENDED, LABELLED, LIMIT, TSS, query
from .operators import assignment, effects, evaluation, exports, genomics, guides, models, neighbours, order, pairs, preparation, qc, regression, statistics
from .plans import store

META = "meta AS (SELECT guide_id, target, chr, pos AS \"start\", pos + 20 AS \"end\" FROM guides),"


def _meta(s):
    return s.guides.select("guide_id", "target", "chr", F.col("pos").alias("start"), (F.col("pos") + 20).alias("end"))


@query(META + '@@SELECT guide_id, gene, log2_fc, p_value, target, chr, "start", "end" FROM eff JOIN meta USING (guide_id)', True)
def results_with_guides(s):
    return exports.with_guides(s.effects.select("guide_id", "gene", "log2_fc", "p_value"), _meta(s), ["target", "chr", "start", "end"])


SCORES = """gs0 AS (SELECT gene, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS q FROM gc GROUP BY gene), mo0 AS (SELECT o.guide AS guide_id, o.gene, size1.m, s1, s / t AS mean, q, t, t - size1.m AS rest FROM own o JOIN gs0 USING (gene) JOIN size1 USING (guide), (SELECT count(*) AS t FROM cells)),
sco AS (SELECT guide_id, gene, round((s1 - m * mean) / sqrt(greatest(m * rest / t * (mean + greatest((q / t - mean * mean - mean) / greatest(mean * mean, 1e-12), 0) * mean * mean), 1e-12)), 6) AS score_z FROM mo0),"""


@query(SCORES + "@@SELECT guide_id, gene, log2_fc AS effects_log2_fc, p_value AS effects_p_value, score_z AS score_score_z FROM eff LEFT JOIN (SELECT * FROM sco WHERE score_z > 0) USING (guide_id, gene)", True)
def methods_side_by_side(s):
    """The effects with the score test's positive results beside them: both are worked out from one row of sums."""
    sums = effects.sums(s.counts, s.assigned, s.cells, parts=s.parts).withColumnRenamed("guide", "guide_id")
    made = models.glm_score(effects.tested(sums.select("*", F.struct(*models.moments()).alias("of")), ["guide_id", "gene", "of"]).select("guide_id", "gene", "log2_fc", "p_value", "of.*"))
    return exports.side_by_side(made, ["guide_id", "gene"], {"effects": ["log2_fc", "p_value"], "score": [F.when(F.col("score_z") > 0, F.col("score_z")).alias("score_z")]})


@query("SELECT guide_id, gene, log2_fc, target, chr, pos FROM eff JOIN (SELECT guide_id, 'coords::' || guide_id AS key, target, chr, pos FROM guides) USING (guide_id)", True)
def target_key_decode(s):
    key = F.concat(F.lit("coords::"), F.col("guide_id").cast("string"))
    found = exports.decoded(s.kept_effects.select("guide_id", "gene", "log2_fc", key.alias("key")), s.guides.select(key.alias("key"), "target", "chr", "pos"))
    return found.select("guide_id", "gene", "log2_fc", "target", "chr", "pos")


@query("SELECT symbol, round(sum(coalesce(total, 0)) / (count(*) * max(k)), 9) AS avg_expression FROM genes LEFT JOIN (SELECT gene, sum(n) AS total FROM gc GROUP BY gene) USING (gene), (SELECT count(*) AS k FROM cells) GROUP BY symbol")
def average_expression(s):
    return exports.average_expression(s.counts, s.genes, s.cells)


@query(META + """@@SELECT gene, target, string_agg(CAST(guide_id AS VARCHAR), ',' ORDER BY lpad(CAST(guide_id AS VARCHAR), 9, '0')) AS guides, arg_min(chr, guide_id) AS chr, arg_min("start", guide_id) AS "start", arg_min("end", guide_id) AS "end", arg_min(log2_fc, guide_id) AS log2_fc
FROM (SELECT guide_id, gene, coalesce(log2_fc, 0) AS log2_fc, target, chr, "start", "end" FROM eff JOIN meta USING (guide_id)) GROUP BY 1, 2""", True)
def element_export(s):
    rows = exports.with_guides(s.effects.select("guide_id", "gene", F.coalesce("log2_fc", F.lit(0.0)).alias("log2_fc")), _meta(s), ["target", "chr", "start", "end"])
    return exports.element_export(rows, ["chr", "start", "end", "log2_fc"])


COLLAPSED = """g0 AS (SELECT guide_id, name, target, reverse(name) AS spacer, chr FROM guides), cl AS (SELECT cell, target, string_agg(name, '|' ORDER BY name) AS collapsed, string_agg(spacer, '|' ORDER BY name) AS spacers, arg_min(chr, name) AS chr FROM gu JOIN g0 ON guide = guide_id GROUP BY 1, 2),"""


def _collapsed(s):
    named = s.assigned.join(s.guides.select(F.col("guide_id").alias("guide"), "name"), "guide").select("cell", F.col("name").alias("guide"))
    return exports.collapsed_features(named, s.guides.select(F.col("name").alias("guide_id"), "target", F.reverse("name").alias("spacer"), "chr"), ["chr"])


@query(COLLAPSED + "@@SELECT * FROM cl")
def collapsed_cells(s):
    return _collapsed(s)[0]


@query(COLLAPSED + "@@SELECT collapsed, arg_min(target, cell) AS target, arg_min(spacers, cell) AS spacers, arg_min(chr, cell) AS chr FROM cl GROUP BY collapsed")
def collapsed_features(s):
    return _collapsed(s)[1]


@query("SELECT target, gene, round(avg(log2_fc), 10) AS log2_fc, min(p_value) AS p_value FROM eff JOIN guides USING (guide_id) GROUP BY 1, 2", True)
def element_means(s):
    return exports.element_means(s.effects.join(F.broadcast(s.guides.select("guide_id", "target")), "guide_id"), ["target", "gene"])


@query("SELECT target, min(p_value) AS p_value FROM eff JOIN guides USING (guide_id) GROUP BY 1 ORDER BY p_value NULLS LAST, target LIMIT 10", True)
def first_targets(s):
    return exports.first_targets(s.effects.join(s.guides.select("guide_id", "target"), "guide_id"), 10)


@query("SELECT chr AS factor, min(p_value) AS p_value, row_number() OVER (ORDER BY min(p_value) NULLS LAST, chr) AS place FROM eff JOIN guides USING (guide_id) GROUP BY 1", True)
def factor_order(s):
    per = s.effects.join(s.guides.select("guide_id", F.col("chr").alias("factor")), "guide_id").groupBy("factor").agg(F.min("p_value").alias("p_value"))
    ranked = order.ranked(store.written(per.withColumn("p", F.coalesce("p_value", F.lit(2.0))), "factors"), "p", ["factor"], "place")
    return ranked.select("factor", "p_value", "place")


@query("SELECT batch, label, count(*) AS n FROM (SELECT o_orderpriority AS batch, o_orderstatus AS label FROM orders) GROUP BY 1, 2")
def crosstab(s):
    return exports.crosstab(s.table("orders").select(F.col("o_orderpriority").alias("batch"), F.col("o_orderstatus").alias("label")), ["batch", "label"])


@query("SELECT count(*) AS cells, count(k) AS with_guide, count(*) FILTER (k = 1) AS with_one, round(count(k) / count(*), 6) AS frac_with_guide, round(count(*) FILTER (k = 1) / count(*), 6) AS frac_with_one FROM cells LEFT JOIN (SELECT cell, count(*) AS k FROM gu GROUP BY cell) USING (cell)")
def guide_groups(s):
    return exports.guide_groups(s.cells, s.assigned)


@query("SELECT guide_id, CAST(coalesce(total, 0) AS BIGINT) AS total FROM guides LEFT JOIN (SELECT guide, sum(n) AS total FROM gu GROUP BY guide) ON guide = guide_id")
def guide_sums(s):
    return exports.guide_sums(s.guides, s.guide_counts).orderBy("total", "guide_id")


@query(EDGES + "@@SELECT DISTINCT src, dst, w AS weight FROM edges WHERE w >= 1.5", True)
def network_edges(s):
    rows = s.edges.select("src", "dst", F.col("w").alias("weight"), F.lit(None).cast("double").alias("p_value"))
    return exports.edge_table(rows, 1.5).select("src", "dst", "weight")


NET = "net AS (SELECT DISTINCT 's' || guide_id AS src, 'g' || gene AS dst, log2_fc AS weight, p_value FROM eff WHERE abs(log2_fc) >= 1),"


@query(NET + """e AS (SELECT dst AS node, p_value, 1 AS k FROM net UNION ALL SELECT src, NULL, 0 FROM net),
@@SELECT node, CAST(sum(k) AS BIGINT) AS in_edges, min(p_value) AS min_p, CASE WHEN sum(k) > 0 THEN round(-log10(greatest(min(p_value), 1e-300)) * 100, 6) ELSE 100.0 END AS size FROM e GROUP BY node""", True)
def network_nodes(s):
    """Nodes are counted by their numbers, where effects lie dealt by gene, and named after."""
    rows = s.effects.select(F.col("guide_id").alias("src"), F.col("gene").alias("dst"), F.col("log2_fc").alias("weight"), "p_value")
    return exports.node_sizes(exports.edge_table(rows, 1.0), ("s", "g"))


COORDS = """co AS (SELECT CAST(gene AS VARCHAR) AS name, chr, CASE WHEN mt THEN NULL ELSE pos END AS "start", pos + 500 AS "end" FROM genes),
@@SELECT * FROM co WHERE "start" IS NOT NULL UNION ALL SELECT target, arg_min(chr, guide_id), arg_min(pos, guide_id), arg_min(pos + 20, guide_id) FROM guides WHERE target <> 'non-targeting' AND target NOT IN (SELECT name FROM co WHERE "start" IS NOT NULL) GROUP BY target"""


@query(COORDS)
def coordinate_table(s):
    genes = s.genes.select("gene", "chr", F.when(~F.col("mt"), F.col("pos")).alias("start"), (F.col("pos") + 500).alias("end"))
    return exports.coordinates(genes, _meta(s))


@query("SELECT guide_id, gene, log2_fc, symbol FROM eff LEFT JOIN (SELECT DISTINCT gene, symbol FROM genes WHERE NOT mt) USING (gene)", True)
def results_with_symbols(s):
    return s.effects.select("guide_id", "gene", "log2_fc").join(s.genes.where("not mt").select("gene", "symbol").distinct(), "gene", "left")


@query("SELECT guide_id, gene, q_value FROM res JOIN guides USING (guide_id) WHERE target_gene IS NULL OR gene <> target_gene", True)
def trans_without_intended(s):
    """Results but those of guides on their own target; controls have none and stay."""
    return s.results.join(s.guides.select("guide_id", "target_gene"), "guide_id").where(~F.col("gene").eqNullSafe(F.col("target_gene"))).select("guide_id", "gene", "q_value")


@query("SELECT guide_id, gene, log2_fc, p_value, row_number() OVER (ORDER BY gene, guide_id) AS place FROM eff", True)
def results_in_order(s):
    """Results by gene, then guide, with their place."""
    return order.ranked(s.effects.select("guide_id", "gene", "log2_fc", "p_value"), "gene", ["guide_id"], "place")


@query("SELECT guide_id, gene, q_value <= 0.05 AS significant FROM res WHERE q_value IS NOT NULL", True)
def corrected_shortcut(s):
    """Values that are adjusted already are held against the rate as they are."""
    return s.results.where("q_value is not null").select("guide_id", "gene", (F.col("q_value") <= 0.05).alias("significant"))


@query(LABELLED + "@@SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 0) < count(*) FILTER (label = 1) AS too_few FROM lab", True)
def controls_evaluation(s):
    """The evaluation table of direct targets against controls on the same genes, without the guard of balance: whether negatives are too few is told."""
    table = evaluation.labelled(s.kept_effects, s.guides)
    positive, negative = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return table.agg(positive.alias("positives"), negative.alias("negatives"), (negative < positive).alias("too_few"))


LINKS = """pos AS (SELECT guide_id, gene, round(1 - p_value, 6) AS score FROM eff JOIN guides USING (guide_id) WHERE p_value IS NOT NULL AND (target, gene) IN (SELECT 'G' || gene, gene + 20 FROM genes)),
@@SELECT guide_id, gene, score, 1 AS label FROM pos UNION ALL SELECT guide_id, gene, round(1 - p_value, 6), 0 FROM eff JOIN guides USING (guide_id) WHERE control AND p_value IS NOT NULL AND gene IN (SELECT gene FROM pos)"""


@query(LINKS, True)
def validated_links_table(s):
    known = s.genes.select(F.concat(F.lit("G"), F.col("gene").cast("string")).alias("target"), (F.col("gene") + 20).alias("gene"))
    return evaluation.linked(store.written(s.effects.select("guide_id", "gene", "p_value"), "effects"), s.guides, known)


@query("""b AS (SELECT guide_id, gene, log2_fc, p_value, row_number() OVER (ORDER BY ('0x' || substr(md5(guide_id || ':' || gene || ':42'), 1, 15))::BIGINT, guide_id, gene) AS place FROM eff WHERE p_value IS NOT NULL),
@@SELECT guide_id, gene, log2_fc, p_value FROM b WHERE place <= 10000""", True)
def volcano_background(s):
    """At most 10,000 results as the plot's background, by the smallest hashes: the sample is what is asked for."""
    text = F.concat_ws(":", F.col("guide_id").cast("string"), F.col("gene").cast("string"), F.lit("42"))
    hashed = s.effects.where("p_value is not null").select("guide_id", "gene", "log2_fc", "p_value", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("h"))
    return hashed.orderBy("h", "guide_id", "gene").limit(10_000).drop("h")


@query("x AS (SELECT chr AS factor, guide_id, pos, s_acctbal AS score FROM guides JOIN supplier ON s_suppkey = guide_id), q AS (SELECT factor, quantile_cont(score, 0.75) AS cut FROM x GROUP BY factor),@@SELECT factor, guide_id, pos, score FROM x JOIN q USING (factor) WHERE score >= cut")
def peak_quantile(s):
    scored = s.guides.join(s.table("supplier").select(F.col("s_suppkey").alias("guide_id"), F.col("s_acctbal").alias("score")), "guide_id").select(F.col("chr").alias("factor"), "guide_id", "pos", "score")
    return genomics.strong_peaks(scored, 0.75)


@query("SELECT gene, chr FROM (SELECT gene, 'chr' || CASE WHEN gene % 30 = 23 THEN 'X' WHEN gene % 30 = 24 THEN 'Y' ELSE CAST(gene % 30 AS VARCHAR) END AS chr FROM genes) WHERE chr IN ('chrX', 'chrY') OR CAST(substr(chr, 4) AS INT) BETWEEN 1 AND 22")
def chromosome_whitelist(s):
    k = F.col("gene") % 30
    named = s.genes.select("gene", F.concat(F.lit("chr"), F.when(k == 23, "X").when(k == 24, "Y").otherwise(k.cast("string"))).alias("chr"))
    return named.where(F.col("chr").isin(preparation.CHROMOSOMES))


WINDOWS = TSS + """w AS (SELECT unnest([500, 1000, 2500, 5000, 10000]) AS width), bw AS (SELECT DISTINCT width, b.chr AS factor, gene FROM w, genes g JOIN peaks b ON g.chr = b.chr AND greatest(0, g.pos - width) < b.stop AND b."start" < g.pos + width),
tw AS (SELECT chr AS factor, gene, min(p_value) AS p_value FROM eff JOIN guides USING (guide_id) GROUP BY 1, 2),
@@SELECT width, factor, count(*) AS tests, count(*) FILTER (p_value <= 0.001) AS rejections, count(*) FILTER (b.gene IS NOT NULL) AS targets, count(*) FILTER (p_value <= 0.001 AND b.gene IS NOT NULL) AS overlap FROM tw CROSS JOIN w LEFT JOIN bw b USING (width, factor, gene) GROUP BY 1, 2"""


@query(WINDOWS, True)
def enrichment_windows(s):
    tests = s.effects.join(F.broadcast(s.guides.select("guide_id", F.col("chr").alias("factor"))), "guide_id").groupBy("factor", "gene").agg(F.min("p_value").alias("p_value"))
    peaks = s.peaks.select("id", "chr", "start", "stop", F.col("chr").alias("factor"))
    return genomics.enrichment_by_window(tests, s.genes, peaks, [500, 1000, 2500, 5000, 10000], 0.001)


NEAR0 = "near0 AS (SELECT guide_id, gene FROM guides u JOIN genes g ON g.chr = u.chr AND abs(g.pos - u.pos) <= 100000), ch AS (SELECT gene, (row_number() OVER (ORDER BY gene) - 1) // 300 AS chunk FROM genes),"


@query(NEAR0 + "@@SELECT chunk, guide_id FROM near0 JOIN ch USING (gene) GROUP BY 1, 2 UNION SELECT chunk, guide_id FROM (SELECT DISTINCT chunk FROM ch), guides WHERE control")
def chunk_guides(s):
    """Guides that are tested in each chunk of genes, controls in all."""
    return guides.chunk_guides(pairs.within_distance(s.guides, s.genes, 100_000), s.genes, s.guides, 300)


@query(NEAR0 + """kg AS (SELECT DISTINCT gene FROM near0), ku AS (SELECT guide_id FROM near0 UNION SELECT guide_id FROM guides WHERE control), kc AS (SELECT DISTINCT cell FROM gu WHERE guide IN (SELECT guide_id FROM ku)),
@@SELECT cell, gene, n FROM gc WHERE gene IN (SELECT gene FROM kg) AND cell IN (SELECT cell FROM kc)""")
def cis_counts(s):
    """Counts of tested genes in cells with a tested guide or a control."""
    near = pairs.within_distance(s.guides, s.genes, 100_000)
    return pairs.cis_counts(near, s.guides, s.assigned, s.counts)


@query(INTENDED + "@@SELECT guide_id, target, log2_fc, p_value, log2_fc <= log2(0.4) AND p_value < 0.05 AS works FROM intended", True)
def working_guides(s):
    return evaluation.intended(s.effects, s.guides).withColumn("works", (F.col("log2_fc") <= F.log2(F.lit(0.4))) & (F.col("p_value") < 0.05))


DEPTHS = [40.0, 90.0, 150.0]
STRATIFIED = """ce AS (SELECT cell, batch, coalesce(total, 0) AS depth FROM cells LEFT JOIN metrics USING (cell)), st AS (SELECT *, batch || ':' || ((depth >= 40)::INT + (depth >= 90)::INT + (depth >= 150)::INT) AS stratum FROM ce),
sz AS (SELECT batch, stratum, count(*) AS k, avg(depth) AS d FROM st GROUP BY 1, 2), ky AS (SELECT cell, gene, n, stratum FROM gc JOIN st USING (cell)), oy AS (SELECT gene, stratum, sum(n)::DOUBLE AS y, sum(n * n)::DOUBLE AS q FROM ky GROUP BY 1, 2),
rt AS (SELECT gene, batch, sum(y) AS yb FROM oy JOIN sz USING (stratum) GROUP BY 1, 2), db AS (SELECT batch, sum(k * d) AS dd FROM sz GROUP BY 1), mn AS MATERIALIZED (SELECT gene, batch, stratum, k, yb / dd * d AS mu FROM rt JOIN db USING (batch) JOIN sz USING (batch)),
sp AS (SELECT gene, greatest(0.0, (sum(coalesce(q, 0) - 2 * coalesce(y, 0) * mu + k * mu * mu) - sum(k * mu)) / sum(k * mu * mu)) AS phi FROM mn LEFT JOIN oy USING (gene, stratum) GROUP BY 1), mo AS MATERIALIZED (SELECT gene, batch, stratum, k, mu, 1 + phi * mu AS sc FROM mn JOIN sp USING (gene)),
wh AS (SELECT gene, batch, sum(k * mu / sc) AS whole FROM mo GROUP BY 1, 2), mi AS MATERIALIZED (SELECT guide, gene, stratum, sum(ky.n)::DOUBLE AS y FROM ky JOIN gu USING (cell) GROUP BY 1, 2, 3), he AS (SELECT guide, stratum, count(*) AS m FROM gu JOIN st USING (cell) GROUP BY 1, 2),
te AS (SELECT guide, gene, batch, coalesce(y, 0) AS y, m * mu AS e, sc FROM (SELECT DISTINCT guide, gene FROM mi) JOIN he USING (guide) JOIN mo USING (gene, stratum) LEFT JOIN mi USING (guide, gene, stratum)),
ba AS (SELECT guide, gene, batch, sum(y) AS o, sum(e) AS e, sum((y - e) / sc) AS u, sum(e / sc) AS a FROM te GROUP BY 1, 2, 3), fi AS (SELECT guide, gene, sum(o) AS o, sum(e) AS e, sum(u) AS u, sum(a - a * a / whole) AS v FROM ba JOIN wh USING (gene, batch) GROUP BY 1, 2),
zz AS (SELECT *, CASE WHEN v > 1e-9 THEN u / sqrt(v) END AS z0 FROM fi), tt AS (SELECT *, 1 / (1 + 0.3275911 * abs(z0) / sqrt(2)) AS t0 FROM zz),
@@SELECT guide, gene, o::BIGINT AS observed, round(e, 6) AS expected, round(log2((o + 0.01) / (e + 0.01)), 6) AS log2_fc, round(z0, 6) AS z, round(t0 * (0.254829592 + t0 * (-0.284496736 + t0 * (1.421413741 + t0 * (-1.453152027 + t0 * 1.061405429)))) * exp(-z0 * z0 / 2), 6) AS p_value FROM tt"""


@query(STRATIFIED)
def stratified_score(s):
    """Negative-binomial score test of every guide and gene with batch and depth as covariates."""
    cells = s.cells.join(s.metrics.select("cell", F.col("total").alias("depth")), "cell", "left").na.fill(0, ["depth"])
    return models.stratified_score(s.counts, s.assigned, cells, DEPTHS, parts=s.parts)


def _design(s):
    """Batch and the logarithm of depth, in steps of a 64th."""
    cells = s.cells.join(s.metrics.select("cell", F.log("total").alias("log_depth")), "cell", "left").na.fill(0, ["log_depth"])
    return regression.design(cells, ["batch"], ["log_depth"])


@query()
def nb_regression(s):
    """Coefficients of every gene's negative-binomial regression on batch and depth."""
    made = _design(s)
    return regression.coefficients(regression.nb_regression(s.counts, made), made.names)


@query()
def resampled_p_values(s):
    """Every guide and gene within the cis distance, against treated cells drawn anew within batch and depth."""
    made = _design(s)
    near = store.written(pairs.within_distance(s.guides, s.genes, LIMIT).select(F.col("guide_id").alias("guide"), "gene"), "near")
    placed = store.dealt(s.counts.join(made.placed, "cell"), "gene", s.parts)
    tested = store.written(placed.join(near.select("gene").distinct(), "gene", "left_semi"), "tested")
    fits = store.written(regression.nb_regression(tested, made), "fits")
    return regression.resampled_p(tested, s.assigned, made, fits, near)


@query()
def mixture_with_covariates(s):
    """Cells of each guide by its counts, where depth and batch move both components' means."""
    counts = s.table("lineitem").groupBy(F.col("l_orderkey").alias("cell"), F.col("l_suppkey").alias("guide")).agg(F.sum("l_quantity").cast("long").alias("n"))
    return assignment.assign_with_covariates(counts, _design(s))


def _tag_sets(s):
    values = qc.centred_log_ratio(s.tags, 6).join(s.cells, "cell").select("batch", "cell", F.col("feature").alias("tag"), F.col("clr").alias("value"))
    return models.tag_sets(store.written(values, "tag-values"))


@query()
def hto_joint(s):
    """Each cell's most likely set of tags with its probability and that of the next."""
    return _tag_sets(s)


@query()
def hto_clusters(s):
    """The sets of tags that occur, with their cells."""
    return models.tag_clusters(_tag_sets(s))


def _pca_by_batch(s):
    vectors = s.table("embeddings").select((F.col("label") % 3).cast("string").alias("batch"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    return models.components_by_batch(vectors, 10)


@query()
def pca_by_batch(s):
    return _pca_by_batch(s)


@query()
def neighbours_by_batch(s):
    """The graph of each batch's nearest neighbours over its principal components."""
    return neighbours.neighbour_graph(_pca_by_batch(s))


@query()
def doublet_filter(s):
    """Cells that aren't called doublets, by the threshold that the simulated ones' scores give."""
    from . import catalog

    return models.called_doublets(catalog._vectors(s)).where("not is_doublet").select("id")


@query("SELECT guide_id, count(*) AS n_tests, round(median(log2_fc), 7) AS median_fc, round(avg(log2_fc), 10) AS mean_fc FROM eff WHERE log2_fc IS NOT NULL AND p_value IS NOT NULL GROUP BY guide_id", True)
def per_guide_means(s):
    tested = s.effects.dropna(subset=["log2_fc", "p_value"])
    return tested.groupBy("guide_id").agg(F.count("*").alias("n_tests"), F.round(F.median("log2_fc"), 7).alias("median_fc"), F.round(F.avg("log2_fc"), 10).alias("mean_fc"))


@query("SELECT control, round(median(n_tests), 6) AS median_tests, count(*) AS guides FROM (SELECT guide_id, count(*) AS n_tests FROM res WHERE q_value IS NOT NULL GROUP BY 1) JOIN guides USING (guide_id) GROUP BY control", True)
def tests_by_kind(s):
    per = s.results.where("q_value is not null").groupBy("guide_id").agg(F.count("*").alias("n_tests"))
    return exports.with_guides(per, s.guides, ["control"]).groupBy("control").agg(F.round(F.median("n_tests"), 6).alias("median_tests"), F.count("*").alias("guides"))


@query("SELECT batch, round(sum((2 * i - k - 1) * n) / (max(k) * sum(n)), 6) AS gini FROM (SELECT batch, n, row_number() OVER (PARTITION BY batch ORDER BY n) AS i, count(*) OVER (PARTITION BY batch) AS k FROM (SELECT batch, gene, sum(n) AS n FROM gc JOIN cells USING (cell) GROUP BY 1, 2)) GROUP BY batch")
def gene_inequality(s):
    return statistics.gini(s.counts.join(s.cells, "cell").groupBy("batch", "gene").agg(F.sum("n").alias("n")), "n", ["batch"])
