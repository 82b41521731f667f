"""What keeps the queries' cost in proportion to their rows: pairs shuffled once, dear tables read once."""

from pyspark.sql import functions as F

from screenloom import catalog
from screenloom.operators import assignment, effects, evaluation, exports, genomics, guides, models, order, regression, statistics


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def screen(spark):
    counts = spark.createDataFrame([(c, g, (c * g) % 5 + 1) for c in range(40) for g in range(6) if (c + g) % 3], "cell long, gene long, n long")
    treated = spark.createDataFrame([(c, c % 4) for c in range(40)], "cell long, guide long")
    cells = spark.createDataFrame([(c, "b" + str(c % 2), float(20 + c)) for c in range(40)], "cell long, batch string, depth double")
    return counts, treated, cells


def test_pairs_are_shuffled_once(spark):
    """Pairs of guides and genes are dealt by gene alone, and a grouping by gene and target takes place there."""
    counts, treated, cells = screen(spark)
    made = effects.effects(counts, treated, cells)
    targets = F.broadcast(spark.createDataFrame([(i, f"T{i % 2}") for i in range(4)], "guide long, target string"))
    grouped = made.join(targets, "guide").groupBy("gene", "target").agg(F.min("p_value").alias("p"))
    physical = grouped._jdf.queryExecution().sparkPlan().toString() + grouped._jdf.queryExecution().executedPlan().toString()
    assert not any(f"hashpartitioning({a}#" in line and f", {b}#" in line for line in physical.split("\n") for a, b in (("guide", "gene"), ("gene", "target")))
    assert grouped.count() == 12


def test_ranked_numbers_all_rows(spark):
    """Rows without a key are numbered too, before the others."""
    rows = [(None, 2), (None, 1), *[(i % 7, i) for i in range(50)]]
    made = order.ranked(spark.createDataFrame(rows, "k int, t int"), "k", ["t"])
    assert "aggregate(" not in plan(made)  # no search for each row's bucket
    got = made.collect()
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.k, r.t) for r in sorted(got, key=lambda r: r["rank"])] == expected and sorted(r["rank"] for r in got) == list(range(1, 53))


def test_background_needs_no_full_order(spark):
    assert "GlobalLimit" in plan(catalog.queries()["volcano_background"](spark, "/root/testdata/sf0.001"))


def test_curves_read_their_table_once(spark, tmp_path):
    spark.createDataFrame([(i, i % 9 / 10, int(i % 4 == 0)) for i in range(60)], "id long, score double, label int").write.parquet(str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert not any("/scored/" in f for f in statistics.areas(scored).inputFiles())


def test_balanced_reads_its_table_once(spark, tmp_path):
    spark.createDataFrame([(i, i % 9 / 10, int(i % 4 == 0)) for i in range(60)], "id long, score double, label int").write.parquet(str(tmp_path / "once"))
    made = statistics.balanced(spark.read.parquet(str(tmp_path / "once")), ["id"])
    assert not any("/once/" in f for f in made.inputFiles()) and made.count() == 30


def test_chunks_of_controls_are_not_compared(spark):
    """Rows of chunks and controls are each made once and go through no grouping; repeated and null guides stay single."""
    near = spark.createDataFrame([(1, 0), (1, 1), (2, 5), (3, 5), (None, 5)], "guide_id long, gene long")
    known = spark.createDataFrame([(1, False), (2, True), (2, True), (3, False), (None, True)], "guide_id long, control boolean")
    made = guides.chunk_guides(near, spark.range(6).select(F.col("id").alias("gene")), known, 3)
    assert plan(made).lstrip().startswith("Union")
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, [(0, 1), (1, 3), (0, 2), (1, 2), (0, None), (1, None)]))


def test_score_lays_out_no_blocks(spark):
    """Vectors meet the pairs where they are: none is sent to a block of other units or genes."""
    counts, treated, cells = screen(spark)
    made = models.stratified_score(counts, treated, cells, [30.0, 50.0])
    assert "InArrow" not in plan(made) and made.count() == 24


def test_elements_are_laid_out_in_place(spark):
    """The full join of results by guide and by target, against Spark's own; the rows it lays out go through no exchange."""
    a = spark.createDataFrame([(1, 10, 0.5, 0.1), (2, 10, None, 0.2), (9, 10, 1.0, 0.3), (3, 11, 2.0, None)], "guide_id long, gene long, log2_fc double, p_value double")
    by_target = spark.createDataFrame([("T", 10, 5.0, 0.5), ("T", 12, None, None), ("U", 11, 6.0, 0.6)], "target string, gene long, log2_fc double, p_value double")
    known = spark.createDataFrame([(1, "T"), (2, "T"), (3, "U"), (4, "T"), (5, None)], "guide_id long, target string")
    made = effects.merged_by_guide(a, by_target, known)
    wide = by_target.join(known, "target").select("guide_id", "gene", "log2_fc", "p_value")
    plain = effects.merged(a, wide, ["guide_id", "gene"])
    assert made.columns == plain.columns and sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
    assert "FullOuter" not in plan(made)


def test_pairs_are_laid_out_after_their_shuffle(spark):
    """A count is dealt by gene with its cell's units; pairs are made where they are added up, and aren't sorted to meet their gene's totals."""
    counts, treated, cells = screen(spark)
    made = effects.effects(counts, treated.unionByName(treated.withColumn("guide", F.col("guide") + 10)), cells)
    text = plan(made)
    assert -1 < text.find("Generate inline") < text.find("RepartitionByExpression [gene")
    assert "ShuffledHashJoin" in made._jdf.queryExecution().sparkPlan().toString()
    got = {(r.guide, r.gene): r.z for r in made.collect()}
    assert len(got) == 48 and all(got[g, gene] == got[g + 10, gene] for g in range(4) for gene in range(6))


def test_families_are_adjusted_without_a_join(spark):
    """Adjusted values of each family from one reading of the rows: ties take the last one's, null p and null families stay."""
    rows = [(f, p) for f in ("a", "b", None) for p in (0.01, 0.02, 0.02, 0.5, None, 0.03, 0.9)] + [("c", None), ("d", 0.7)]
    made = statistics.bh(spark.createDataFrame(rows, "family string, p double"), "p", by=["family"])
    assert "Join" not in plan(made)

    def adjusted(p, others):
        return None if p is None else min(1.0, min(x * len(others) / sum(y <= x for y in others) for x in others if x >= p))

    expected = [(f, p, adjusted(p, [y for g, y in rows if g == f and y is not None])) for f, p in rows]
    key = lambda r: tuple((v is not None, v) if v is not None else (False, "") for v in r)
    got = made.collect()
    assert sorted([tuple(r)[:2] for r in got], key=str) == sorted(rows, key=str)
    for a, b in zip(sorted(map(tuple, got), key=str), sorted(expected, key=str)):
        assert key(a)[:2] == key(b)[:2] and (a[2] == b[2] or abs(a[2] - b[2]) < 1e-12)


def test_guides_are_fitted_together(spark):
    """Guides share a task's calls and have the posteriors that each has alone; a block has several guides, and null guides are left out."""
    rows = [(c, g, 1 + (c * (g + 3)) % 4 + (40 if c % (g + 4) == 0 else 0)) for g in range(6) for c in range(120) if (c + g) % 5]
    counts = spark.createDataFrame([*rows, (1, None, 5)], "cell long, guide long, n long")
    made = regression.design(spark.createDataFrame([(c, f"b{c % 2}", float(c % 3)) for c in range(150)], "cell long, batch string, depth double"), ["batch"], ["depth"])
    called = assignment.assign_with_covariates(counts, made, 0.0)
    assert "FlatMapGroupsInPandas [block" in plan(called) or "block#" in plan(called)
    got = {(r.cell, r.guide): r.posterior for r in called.collect()}
    alone = {}
    for g in range(6):
        for r in assignment.assign_with_covariates(counts.where(F.col("guide") == g), made, 0.0).collect():
            alone[r.cell, r.guide] = r.posterior
    assert got == alone and {g for _, g in got} == set(range(6))


def test_rows_stay_in_place_for_guides(spark):
    """However large the tables are held to be, sizes, guides and links are broadcast: neither cells' guides nor results are shuffled by guide."""
    counts, treated, cells = screen(spark)
    known = spark.createDataFrame([(i, i == 3, f"T{i % 2}", i + 1) for i in range(4)] + [(9, False, "T9", 1), (1, False, "U", 2)], "guide_id long, control boolean, target string, target_gene long")
    links = spark.createDataFrame([("T0", 2), ("U", 4), ("T9", 1)], "target string, gene long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = effects.effects(counts, treated, cells).withColumnRenamed("guide", "guide_id")
        own, score = evaluation.intended(made, known), evaluation.linked(made, known, links)
        assert "BroadcastHashJoin [guide#" in made._jdf.queryExecution().sparkPlan().toString()
        assert all("LeftSemi, BuildRight" in df._jdf.queryExecution().sparkPlan().toString() for df in (own, score))
        assert "SortMergeJoin [gene" not in score._jdf.queryExecution().sparkPlan().toString()
        rows = {(r.guide_id, r.gene): r for r in made.collect()}
        expected = [(g, t, *((rows[g, n].log2_fc, rows[g, n].p_value) if (g, n) in rows else (None, None))) for g, control, t, n in map(tuple, known.collect()) if not control]
        assert sorted(map(str, map(tuple, own.collect()))) == sorted(map(str, expected))
        positive = [(g, n) for g, _, t, _ in map(tuple, known.collect()) for u, n in map(tuple, links.collect()) if t == u and (g, n) in rows]
        got = score.collect()
        assert sorted((r.guide_id, r.gene) for r in got if r.label) == sorted(positive)
        assert sorted((r.guide_id, r.gene) for r in got if not r.label) == sorted((3, n) for n in {n for _, n in positive})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_results_stay_with_their_gene_for_enrichment(spark):
    """Results dealt by gene aren't shuffled by factor and gene to meet the bound genes, nor laid out over the widths; counts are those of a plain join."""
    pairs = [(f, g) for f in ("A", "B", None) for g in [*range(8), None]]
    rows = [(f, g, None if i % 3 == 0 else 0.0001 * i) for i, (f, g) in enumerate(pairs)]
    made = spark.createDataFrame(rows, "factor string, gene long, p_value double").repartition("gene")
    results = made.groupBy("factor", "gene").agg(F.min("p_value").alias("p_value"))
    targets = [("A", 1), ("A", 1), ("A", 6), ("B", 2), (None, 3), ("C", 1)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = genomics.enrichment(results, spark.createDataFrame(targets, "factor string, gene long"), 0.001)
        genes = spark.createDataFrame([(g, "c", 10_000 * g) for g in range(8)], "gene long, chr string, pos long")
        peaks = spark.createDataFrame([(1, "c", 10_700, 10_800, "A"), (2, "c", 9_000, 9_100, "A"), (3, "c", 52_500, 52_600, "B"), (4, "c", 31_000, 31_001, None)], "id long, chr string, start long, stop long, factor string")
        windows = genomics.enrichment_by_window(results, genes, peaks, [500, 1000, 2500, 5000], 0.001)
        for df in (found, windows):
            physical = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin [factor#" not in physical and "SortMergeJoin [width#" not in physical
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def counts(factor, bound):
        own = [(g, p) for f, g, p in rows if f == factor]
        hits = [g for g, p in own if p is not None and p <= 0.001]
        return len(own), len(hits), sum((factor, g) in bound for g, _ in own), sum((factor, g) in bound for g in hits)

    named = {t for t in targets if t[0]}
    assert {tuple(r)[:5] for r in found.collect()} == {(f, *counts(f, named)) for f in ("A", "B", None)}
    reached = {w: {(f, g) for g in range(8) for f, a, b in (("A", 10_700, 10_800), ("A", 9_000, 9_100), ("B", 52_500, 52_600)) if max(0, 10_000 * g - w) < b and a < 10_000 * g + w} for w in (500, 1000, 2500, 5000)}
    assert sorted(map(str, (tuple(r) for r in windows.collect()))) == sorted(str((w, f, *counts(f, reached[w]))) for w in reached for f in ("A", "B", None))


def test_all_pairs_are_dealt_to_tasks(spark):
    """Every pair once, repeated and null keys too; tasks follow the number of pairs, and a task's rows repeat few genes in turn."""
    from screenloom.operators import pairs

    guides, genes = spark.createDataFrame([(i,) for i in range(7)] + [(None,)], "guide_id long"), spark.createDataFrame([(i,) for i in range(40)] + [(None,), (3,)], "gene long").coalesce(1)
    made = pairs.all_pairs(guides, genes, block=5, most=60)
    own = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert own(made.select("guide_id", "gene").collect()) == own((a.guide_id, b.gene) for a in guides.collect() for b in genes.collect())
    assert made.columns == ["guide_id", "gene"] and made.rdd.getNumPartitions() == 6


def test_methods_share_their_sums(spark):
    """Effects and scores side by side come from one row of sums, with the values that a join of the two has, and aren't shuffled by guide and gene."""
    folder = "/root/testdata/sf0.001"
    made = catalog.queries()["methods_side_by_side"](spark, folder)
    text = plan(made)
    assert "LeftOuter" not in text and text.count("RepartitionByExpression [gene") == 1
    first = catalog.queries()["perturbation_effects"](spark, folder).select("guide_id", "gene", "log2_fc", "p_value")
    other = catalog.queries()["glm_score"](spark, folder).withColumnRenamed("guide", "guide_id").where("score_z > 0")
    joined = exports.beside(first, other, ["guide_id", "gene"], ("effects", "score"))
    assert made.columns == joined.columns and sorted(map(str, made.collect())) == sorted(map(str, joined.collect()))


def test_nodes_are_counted_where_edges_lie(spark):
    """Edges dealt by dst aren't shuffled or written to count nodes; repeated edges count once, and a node may be both ends."""
    rows = [(1, 2, 1.5, 0.5), (1, 2, 1.5, 0.5), (1, 2, -3.0, 0.01), (2, 1, 1.0, None), (3, 2, 0.5, 0.001), (None, 2, 2.0, 0.2), (4, None, 2.0, 1e-301)]
    table = spark.createDataFrame(rows, "src long, dst long, weight double, p_value double")
    edges = exports.edge_table(table.repartition(4, "dst"), 1.0)
    found = exports.node_sizes(edges, ("s", "g"))
    assert "hashpartitioning(src#" not in edges._jdf.queryExecution().executedPlan().toString()
    got = {r.node: (r.in_edges, r.min_p, r["size"]) for r in found.collect()}
    assert got == {"g2": (3, 0.01, 200.0), "g1": (1, None, 30000.0), "s1": (0, None, 100.0), "s2": (0, None, 100.0), "s4": (0, None, 100.0), None: (1, 1e-301, 30000.0)}
    both = {r.node: (r.in_edges, r.min_p, r["size"]) for r in exports.node_sizes(edges).collect()}
    assert both == {"2": (3, 0.01, 200.0), "1": (1, None, 30000.0), "4": (0, None, 100.0), None: (1, 1e-301, 30000.0)}
    query = catalog.queries()["network_nodes"](spark, "/root/testdata/sf0.001")
    assert any(f.endswith("lineitem.parquet") for f in query.inputFiles())


def test_pairs_are_laid_out_in_batches(spark, monkeypatch):
    """Lists of genes and of guides are laid out in Arrow batches, not row by row: with several lists of either and batches smaller than a list every pair is there once, keys of other types and empty sides too."""
    from screenloom.operators import pairs

    monkeypatch.setattr(pairs, "GUIDES", 3)
    own = lambda rows: sorted(map(repr, map(tuple, rows)))
    genes = spark.createDataFrame([(f"g{i}",) for i in range(11)] + [(None,)], "gene string")
    guides = spark.range(8).select(F.col("id").alias("guide_id"))
    made = pairs.all_pairs(guides, genes, block=4, most=20)
    assert "explode" not in plan(made) and "InArrow" in plan(made)
    assert own(made.collect()) == own((a.guide_id, b.gene) for a in guides.collect() for b in genes.collect())
    assert pairs.all_pairs(guides, genes.limit(0)).count() == 0 and pairs.all_pairs(guides.limit(0), genes).count() == 0
    import pyarrow as pa

    monkeypatch.setattr(pairs, "BATCH_ROWS", 5)
    rows = [batch.to_pydict() for batch in pairs.laid_out([pa.RecordBatch.from_arrays([pa.array([[1, None, 3, 4], []]), pa.array([[7, 8], [9]])], names=["a", "b"])])]
    assert rows == [{"guide_id": [1, 1, None, None], "gene": [7, 8, 7, 8]}, {"guide_id": [3, 3, 4, 4], "gene": [7, 8, 7, 8]}]


def test_guides_and_targets_are_merged_from_one_shuffle(spark):
    """The effects of guides and of targets in a full join, against Spark's own: counts are dealt by gene once and nothing is written, joined by guide and gene, or grouped by target."""
    counts, treated, cells = screen(spark)
    treated = treated.unionByName(treated.where("cell % 3 = 0").withColumn("guide", F.col("guide") + 4)).unionByName(treated.where("cell % 7 = 0").withColumn("guide", F.lit(9)))
    known = spark.createDataFrame([(0, "T"), (1, "T"), (2, "U"), (3, None), (4, "U"), (5, "T"), (6, "V"), (6, "V"), (7, "V"), (7, "T"), (8, "T"), (11, "W"), (None, "T")], "guide_id long, target string")
    made = effects.by_guide_and_target(counts, treated, cells, known)
    a = effects.effects(counts, treated, cells).withColumnRenamed("guide", "guide_id").select("guide_id", "gene", "log2_fc", "p_value")
    by_target = effects.effects(counts, effects.by_target(treated, known), cells, unit="target")
    wide = by_target.join(known.where("guide_id is not null"), "target").select("guide_id", "gene", "log2_fc", "p_value")
    plain = effects.merged(a, wide, ["guide_id", "gene"])
    assert made.columns == plain.columns and sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
    text = plan(made)
    assert text.count("RepartitionByExpression [gene") == 1 and "FullOuter" not in text
    none = effects.by_guide_and_target(counts, treated, cells, known.where("target = 'none'"))
    assert sorted(map(str, none.collect())) == sorted(map(str, effects.merged(a, wide.limit(0), ["guide_id", "gene"]).collect()))


def test_merged_rows_are_laid_out_in_pieces():
    """However rows are cut into batches, pieces and lines of the answer: each target's genes with each of its guides, beside the guide's own values."""
    import numpy as np
    import pyarrow as pa

    ids, starts, rows = np.array([1, 2, 2, 5, 3, 4]), np.array([0, 4, 6]), [(None, 7, 9, 0.9, None)]
    for t, genes in ((0, [None, *range(11)]), (1, [3, 4])):
        for g in genes:
            rows += [(t, g, None, (g or 0) / 8, None if g == 4 else 0.5), *[(t, g, i, i + (g or 0) / 16, None) for i in sorted(set(ids[starts[t] : starts[t + 1]].tolist())) if ((g or 0) + i) % 3 == 0]]
    own = {(g, i): (f, p) for t, g, i, f, p in rows if i is not None}
    expected = [(9, 7, 0.9, None, None, None)] + [(i, g, *own.get((g, i), (None, None)), f, p) for t, g, k, f, p in rows if k is None for i in ids[starts[t] : starts[t + 1]].tolist()]
    table = pa.table({c: pa.array(list(v), kind) for c, v, kind in zip(("number", "gene", "guide", "log2_fc", "p_value"), zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))})
    for size in (1, 4, 100):
        for block, most in ((1, 1), (3, 5), (4, 1000), (250, 1 << 16)):
            made = [tuple(r.values()) for b in effects.merged_batches(table.to_batches(size), ids, starts, block, most) for r in b.to_pylist()]
            assert sorted(map(str, made)) == sorted(map(str, expected)), (size, block, most)


def test_scores_shuffle_counts_once_with_their_units(spark):
    """A count goes to its gene with its cell's units, and pairs are laid out there; scores are those of plain sums, and a cell without a batch adds to none."""
    counts, treated, cells = screen(spark)
    cells = cells.withColumn("batch", F.when(F.col("cell") != 5, F.col("batch")))
    treated = treated.unionByName(treated.withColumn("guide", F.col("guide") % 2 + 10))
    made = models.stratified_score(counts, treated, cells, [30.0, 50.0])
    text = plan(made)
    assert text.count("Generate inline") == 1 and text.find("Generate inline") < text.find("RepartitionByExpression [gene")
    place = {c: (b, (d >= 30) + (d >= 50)) for c, b, d in map(tuple, cells.collect()) if b is not None}
    depth = {s: [d for c, _, d in map(tuple, cells.collect()) if place.get(c) == s] for s in set(place.values())}
    mean = {s: sum(d) / len(d) for s, d in depth.items()}
    own, guides = {(c, g): n for c, g, n in map(tuple, counts.collect())}, {}
    for c, u in map(tuple, treated.collect()):
        guides.setdefault(u, set()).add(c)
    got = {(r.guide, r.gene): r for r in made.collect()}
    assert set(got) == {(u, g) for u, held in guides.items() for c, g in own if c in held}
    for g in {g for _, g in own}:
        rate = {b: sum(own.get((c, g), 0) for c in place if place[c][0] == b) / sum(sum(d) for s, d in depth.items() if s[0] == b) for b in {s[0] for s in depth}}
        mu = {c: rate[s[0]] * mean[s] for c, s in place.items()}
        spread = max(0.0, sum((own.get((c, g), 0) - mu[c]) ** 2 - mu[c] for c in place) / sum(mu[c] ** 2 for c in place))
        scale = {c: 1 + spread * mu[c] for c in place}
        for u, held in guides.items():
            if (r := got.get((u, g))) is None:
                continue
            held = held & set(place)
            share = {b: sum(mu[c] / scale[c] for c in held if place[c][0] == b) for b in rate}
            whole = {b: sum(mu[c] / scale[c] for c in place if place[c][0] == b) for b in rate}
            info = sum(share[b] - share[b] ** 2 / whole[b] for b in rate if whole[b] > 0)
            score = sum((own.get((c, g), 0) - mu[c]) / scale[c] for c in held)
            assert r.observed == sum(own.get((c, g), 0) for c in held) and abs(r.expected - sum(mu[c] for c in held)) < 1e-5
            assert abs(r.z - score / info**0.5) < 1e-5 if info > 1e-9 else r.z is None


def test_draws_of_pairs_are_made_together(spark):
    """Draws of several pairs at once are those of each alone, however the pairs' rows are cut into batches; a pair's tail isn't a call of its own."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    size = [1, 40, 3, 700, 1, 12]
    pair = np.repeat(np.arange(len(size)), size)
    stratum, cell, e = rng.integers(0, 9, len(pair)), rng.integers(0, 10**6, len(pair)), rng.gamma(1, 1, len(pair))
    order = np.lexsort((cell, stratum, pair))
    stratum, cell, e = stratum[order], cell[order], e[order]
    m, sizes, salt, score = 3.0 + stratum, np.full(len(pair), 900.0), pair * 77 - 5, 1.0 + pair
    got = regression.drawn_together(pair, stratum, cell, e, m, sizes, salt & (2**63 - 1), 50, len(size))
    columns = {"guide": pa.array([f"g{i // 2}" for i in pair]), "gene": pa.array(pair), **{c: pa.array(v) for c, v in zip(("score", "salt", "stratum", "cell", "e", "m", "cells"), (score, salt, stratum, cell, e, m, sizes))}}
    expected = []
    for i in range(len(size)):
        rows = pair == i
        alone = regression.drawn_sums(stratum[rows], cell[rows], e[rows], m[rows], sizes[rows], int(salt[rows][0]) % 2**63, 50)
        assert np.allclose(got[i], alone, rtol=1e-12)
        total = np.zeros(50)  # one entry after the other, as the draws are defined
        for s in np.unique(stratum[rows]):
            left, wanted = 900.0, np.full(50, 3.0 + s)
            for k in np.flatnonzero(rows & (stratum == s)):
                hit = regression.uniforms(cell[k : k + 1], int(salt[k]) % 2**63, 50)[0] * left < wanted
                total, wanted, left = total + hit * e[k], wanted - hit, left - 1
        assert np.allclose(total, alone, rtol=1e-12)
        expected.append((f"g{i // 2}", i, min(1.0, 2 * min((1 + (total >= 1.0 + i - 1e-9).sum()) / 51, (1 + (total <= 1.0 + i + 1e-9).sum()) / 51))))
    for rows in (1, 7, 10_000):
        batches = pa.table(columns).to_batches(rows)
        assert [tuple(r.values()) for b in regression.drawn_tails(batches, "guide", 50) for r in b.to_pylist()] == expected
