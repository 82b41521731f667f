"""Hand-computed cases."""

import random
import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.functions import expressions as ex
from screenloom.operators import effects, guides, models, order, pairs, qc, sequences, statistics
from screenloom.plans import checks, screen
from screenloom.sources import files
from screenloom.streaming import ingest


def test_bh_skips_nulls(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, 0.005, None])], "i int, p double")
    q = [r.q_value for r in statistics.bh(df, "p").orderBy("i").collect()]
    assert q[4] is None and np.allclose(q[:4], [0.02, 0.04, 0.04, 0.02])


def test_rejection_cut(spark):
    """The largest rejected p against adjusted values of sorted rows, with ties, nulls, few bins and none rejected."""
    rng = np.random.default_rng(5)
    for k, (share, digits) in enumerate([(0.3, 6), (0.02, 6), (0.3, 2), (0.0, 6)]):
        p = np.round(np.where(rng.random(3000) < share, rng.random(3000) ** 6 / 50, rng.random(3000)), digits)
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(p)] + [(-1, None)], "i long, p double")
        ordered = np.sort(p)
        adjusted = np.minimum.accumulate((ordered * len(p) / np.searchsorted(ordered, ordered, side="right"))[::-1])[::-1]
        for alpha in (0.05, 0.5):
            hits = ordered[adjusted < alpha]
            wanted = hits.max() if len(hits) else None
            assert statistics.rejection_cut(df, "p", alpha, bins=512 if k % 2 else 7) == wanted, (share, digits, alpha)
    assert statistics.rejection_cut(df.where("p is null"), "p", 0.05) is None


def test_areas(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)], "score double, label int")
    assert statistics.areas(df).first().auroc == 0.75


def test_fisher_and_gini(spark):
    row = spark.createDataFrame([(8, 2, 1, 5), (0, 0, 3, 4)], "a int, b int, c int, d int").select(F.round(statistics.fisher_greater(*map(F.col, "abcd")), 6).alias("p")).collect()
    assert [r.p for r in row] == [0.024476, None]
    import math

    rng = np.random.default_rng(3)
    tables = [tuple(map(int, rng.integers(1, 400, 4))) for _ in range(60)]

    def exact(a, b, c, d):
        row, col, n = a + b, a + c, a + b + c + d
        return sum(math.comb(row, k) * math.comb(n - row, col - k) for k in range(a, min(row, col) + 1)) / math.comb(n, col)

    found = spark.createDataFrame(tables, "a int, b int, c int, d int").select("*", statistics.fisher_greater(*map(F.col, "abcd")).alias("p"), statistics.odds_ratio(*map(F.col, "abcd")).alias("r")).collect()
    assert all(np.isclose(r.p, exact(r.a, r.b, r.c, r.d), rtol=1e-8) and np.isclose(r.r, r.a * r.d / (r.b * r.c)) for r in found)
    values = spark.createDataFrame([("x", i, v) for i, v in enumerate([0, 0, 0, 4])] + [("y", i, 1) for i in range(4)], "g string, i int, v int")
    assert {r.g: r.gini for r in statistics.gini(values, "v", ["g"]).collect()} == {"x": 0.75, "y": 0.0}


def test_expressions(spark):
    df = spark.createDataFrame([("AACGTn", "ACGTTTTT", "TTTTT", 1234567.0, "12.0")], "s string, r string, g string, n double, w string")
    row = df.select(ex.reverse_complement(F.col("s")).alias("rc"), ex.upstream(F.col("r"), F.col("g")).alias("up"), ex.human(F.col("n")).alias("h"), ex.whole(F.col("w")).alias("w")).first()
    assert tuple(row) == ("nACGTT", "---------ACG", "1.23M", 12)
    texts = spark.createDataFrame([(x,) for x in ["True", "TRUE", "1", "t", "yes", "y", None, "x"]], "x string")
    assert [r.b for r in texts.select(ex.is_true(F.col("x")).alias("b")).collect()] == [True, True, True, True, True, False, True, False]


def test_buckets_of_controls(spark):
    rows = [(f"t{t}{i}", f"T{t}", False) for t, n in enumerate((2, 2, 3)) for i in range(n)] + [(f"c{i}", ex.CONTROL, True) for i in range(1, 6)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "guide_id long, target string, control boolean")
    assert [r.target for r in guides.control_buckets(df).orderBy("guide_id").collect()] == [f"non-targeting|{n}" for n in (1, 1, 2, 2, 3)]


def test_running_matches_sorting(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 50, 500).tolist()
    got = order.ranked(spark.createDataFrame(list(enumerate(values)), "i long, v long"), "v", ["i"], descending=True).collect()
    expected = {i: n for n, (i, _) in enumerate(sorted(enumerate(values), key=lambda x: (-x[1], x[0])), 1)}
    assert {r.i: r["rank"] for r in got} == expected


@pytest.mark.parametrize("descending", [False, True])
def test_running_spreads_one_value(spark, descending):
    """A value that most rows have is dealt to several buckets, and the order still holds."""
    rng = np.random.default_rng(1)
    rows = [(i, 7 if i % 3 else int(rng.integers(0, 20))) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, v long")
    buckets = {r["_bucket"]: r["count"] for r in order.dealt(df, "v", ["i"], descending, rows=100).groupBy("_bucket").count().collect()}
    assert len(buckets) >= 20 and max(buckets.values()) <= 300
    got = order.running(df, "v", ["i"], {"rank": ("sum", F.lit(1).cast("long")), "most": ("max", F.col("v"))}, descending, rows=100).collect()
    expected = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda x: (-x[1] if descending else x[1], x[0])), 1)}
    assert {r.i: r["rank"] for r in got} == expected
    assert order.ranked(df.limit(0), "v", ["i"]).count() == 0


def test_bh_of_families(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(i), None if i % 11 == 0 else float(np.round(p, 2))) for i, (g, p) in enumerate(zip(rng.integers(0, 3, 300), rng.random(300) ** 3))]
    df = spark.createDataFrame(rows, "g int, i int, p double")

    def adjusted(values):
        order_of = np.argsort(values, kind="stable")
        q = np.minimum.accumulate((values[order_of] * len(values) / np.arange(1, len(values) + 1))[::-1])[::-1]
        out = np.empty(len(values))
        out[order_of] = np.minimum(q, 1)
        return out

    whole = {i: p for _, i, p in rows if p is not None}
    expected = dict(zip(whole, adjusted(np.array(list(whole.values())))))
    got = {r.i: r.q_value for r in statistics.bh(df, "p").collect()}
    assert set(got) == {r[1] for r in rows} and all(got[i] is None if p is None else np.isclose(got[i], expected[i]) for _, i, p in rows)
    by = {r.i: r.q_value for r in statistics.bh(df, "p", by=["g"]).collect()}
    for g in range(3):
        part = {i: p for f, i, p in rows if f == g and p is not None}
        assert np.allclose([by[i] for i in part], adjusted(np.array(list(part.values()))))
    assert statistics.bh(df.limit(0), "p").count() == 0


def test_distance_is_inclusive(spark):
    g = spark.createDataFrame([(1, "c", 100)], "guide_id long, chr string, pos long")
    genes = spark.createDataFrame([(1, "c", 100), (2, "c", 1100), (3, "c", 1101), (4, "d", 100)], "gene long, chr string, pos long")
    assert sorted(r.gene for r in pairs.within_distance(g, genes, 1000).collect()) == [1, 2]


def test_null_safe_merge(spark):
    a = spark.createDataFrame([("g", None, 1.0)], "t string, s long, v double")
    assert effects.merged(a, a, ["t", "s"], null_safe=True).count() == 1
    assert effects.merged(a, a, ["t", "s"]).count() == 2


def test_clr_and_models(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1)], "cell long, feature string, n long")
    got = {r.feature: r.clr for r in qc.centred_log_ratio(df, 2).collect()}
    mean = (np.log1p(3) + np.log1p(1)) / 2
    assert np.isclose(got["a"], np.log1p(3 / np.exp(mean)), atol=1e-6)
    posterior = models.poisson_mixture(np.array([0.0] * 80 + [1.0] * 10 + [30.0] * 10))
    assert (posterior[:90] < 0.2).all() and (posterior[90:] > 0.8).all()


def test_mixture_weights(spark):
    """Counts of more than 10,000 cells have their whole weight: as from each count by itself."""
    counts = np.repeat([0.0, 3.0, 6.0, 9.0], [60_000, 12_000, 4_000, 2_000])
    levels, at, weights = np.unique(counts, return_index=True, return_counts=True)
    whole = models.poisson_mixture(counts)
    assert np.allclose(models.poisson_mixture(levels, weights=weights.astype(float)), whole[at], atol=1e-6)
    cells = spark.createDataFrame([(int(n), int(w)) for n, w in zip(levels, weights)], "n long, w int").selectExpr("'b' as batch", "1L as guide", "n", "explode(sequence(1, w)) as cell")
    got = {r.n: r.posterior for r in models.assign_mixture(cells.selectExpr("batch", "n * 100000L + cell as cell", "guide", "n"), 0.0).selectExpr("cell div 100000 as n", "posterior").distinct().collect()}
    assert got == {int(n): round(float(p), 6) for n, p in zip(levels, whole[at])}


def test_hashing_weights(spark):
    """A value that most cells have counts as often: the cut lies by the Gaussians of all cells, not of the distinct values."""
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(3000, 0.0), rng.normal(0, 0.3, 3000), rng.normal(3, 0.3, 150), [1.2, 9.0, 9.5, 10.0]])
    df = spark.createDataFrame([("b", i, "t", float(v)) for i, v in enumerate(values)], "batch string, cell long, tag string, value double")
    got = {r.cell for r in models.hashing_tags(df).where("tags = 't'").collect()}
    m, v, share = [values[values <= values.mean()].mean(), values[values > values.mean()].mean()], [values[values <= values.mean()].var(), values[values > values.mean()].var()], (values > values.mean()).mean()
    for k in range(51):
        a, b = [np.log(s) - np.log(v[j]) / 2 - (values - m[j]) ** 2 / (2 * v[j]) for j, s in enumerate((1 - share, share))]
        post = 1 / (1 + np.exp(np.clip(a - b, -700, 700)))
        if k == 50:
            break
        share = post.mean()
        m = [np.average(values, weights=p) for p in (1 - post, post)]
        v = [max(np.average((values - mm) ** 2, weights=p), values.var() / 1000) for p, mm in zip((1 - post, post), m)]
    assert got == set(np.flatnonzero((values > m[0]) & ((values >= m[1]) | (post > 0.5))).tolist())


def test_guide_search(spark):
    """Whole reads and guides of several lengths against searching each read for each guide."""
    import random

    rng = random.Random(4)
    guides_ = ["".join(rng.choices("ACGTé", k=rng.randint(5, 40))) for _ in range(12)] + ["ACGTA"]
    reads = []
    for i in range(80):
        body = "".join(rng.choices("ACGTé ", k=rng.randint(0, 400)))
        for g in rng.sample(guides_, rng.randint(0, 3)):
            at = rng.randint(0, len(body))
            body = body[:at] + g + body[at:]
        reads.append((i, body))
    r, g = spark.createDataFrame(reads + [(99, None)], "read_id long, seq string"), spark.createDataFrame(list(enumerate(guides_)), "guide_order long, spacer string")
    expected = {}
    for i, body in reads:
        if hit := next((k for k, x in enumerate(guides_) if x in body), None) is not None:
            k = next(k for k, x in enumerate(guides_) if x in body)
            expected[i] = (k, body.index(guides_[k]))
    for block in (200_000, 5):
        assert {x.read_id: (x.guide_order, x.position) for x in sequences.guide_hits(r, g, block=block).collect()} == expected and hit is not None
    assert sequences.guide_hits(r, g.limit(0)).count() == 0 and sequences.guide_hits(r.limit(0), g).count() == 0


def test_base_frequencies(spark):
    df = spark.createDataFrame([("ACg",), ("A",), ("N",), ("",)], "seq string")
    got = {(r.position, r.base): r.share for r in sequences.base_frequencies(df).collect()}
    assert got == {(0, "A"): 0.5, (0, "N"): 0.5, (1, "C"): 0.25, (1, "N"): 0.75, (2, "g"): 0.25, (2, "N"): 0.75}


def reference_bend(x, y):
    """The bent segment and farthest point by a cubic fit over all ranks, laid out in full."""
    fit = np.polyfit((x - 1) / (x[-1] - 1), y, 3)
    bend = np.polyval(np.polyder(fit, 2), (x - 1) / (x[-1] - 1))
    tenth = max(1, round(len(x) * 0.1))
    middle = bend[tenth:-tenth] if len(x) > 2 * tenth else bend
    lo, hi = 0, len(x) - 1
    if (middle < 0).any() and (middle > 0).any():
        least = int(bend.argmin())
        left, right = np.flatnonzero(bend[: least + 1] >= 0), np.flatnonzero(bend[least:] >= 0)
        if len(left) and len(right):
            lo, hi = left[-1], least + right[0]
    x, y = x[lo : hi + 1], y[lo : hi + 1]
    away = np.abs((y[-1] - y[0]) * (x - x[0]) - (x[-1] - x[0]) * (y - y[0]))
    return int(x[np.round(away, 6).argmax()])


def test_second_knee(spark):
    for n, curve in ((5000, lambda t: 8 - 2 * t - 3 * t**6), (9000, lambda t: 6 - 4 * np.sqrt(t)), (50, lambda t: 3 - t**3), (6000, lambda t: 5 - np.tanh(8 * (t - 0.6)))):
        x = np.arange(1, n + 1)
        y = np.round(curve(x / n), 6)
        df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "rank long, log_total double")
        assert models.second_knee(df, n).first()["rank"] == reference_bend(x.astype(float), y)
    assert models.second_knee(df, 3).count() == 0


def test_doublets(spark):
    """Made pairs score above single cells; neighbours found in leaves against all points."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 6, (5, 12))
    single = np.concatenate([c + rng.normal(0, 1, (240, 12)) for c in centres])
    double = np.array([(single[rng.integers(0, 240)] + single[rng.integers(480, 720)]) / 2 for _ in range(60)])
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([single, double]))]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    scores = {r.id: r.score for r in models.doublet_scores(df, leaf=400).collect()}
    assert len(scores) == len(rows)
    made, plain = [scores[i] for i in range(len(single), len(rows))], [scores[i] for i in range(len(single))]
    assert np.mean(made) > np.mean(plain) + 0.15
    whole = {r.id: r.score for r in models.doublet_scores(df, leaf=10**6).collect()}
    close = np.mean([abs(scores[i] - whole[i]) <= 0.1 for i in scores])
    assert close >= 0.9 and models.doublet_scores(df.limit(0)).count() == 0
    assert models.doublet_calls(models.doublet_scores(df)).where("is_doublet").count() < len(rows) / 2
    assert models.principal_components(df.limit(0)).count() == 0


def test_components(spark):
    """Components of a batch are those of the batch alone; their variances are the correlation matrix's largest eigenvalues."""
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (300, 6)) @ rng.normal(0, 1, (6, 6))
    df = spark.createDataFrame([("ab"[i % 2], i, v.tolist()) for i, v in enumerate(x)], "batch string, id long, features array<double>")
    got = models.components_by_batch(df, 3).collect()
    assert len(got) == 300
    for b in "ab":
        own = np.array([r.pc for r in sorted((r for r in got if r.batch == b), key=lambda r: r.id)])
        part = x["ab".index(b) :: 2]
        values = np.sort(np.linalg.eigvalsh(np.corrcoef(part.T)))[::-1][:3]
        assert np.allclose(own.var(axis=0), values, rtol=1e-4) and np.allclose(own.mean(axis=0), 0, atol=1e-5)
    assert models.components_by_batch(df.limit(0)).count() == 0


def test_stratified_score(spark):
    """A planted effect is seen, and a gene that follows depth and batch alone isn't."""
    rng = np.random.default_rng(6)
    cells = [(i, "ab"[i % 2], float(rng.integers(50, 400))) for i in range(2000)]
    counts, treated = [], [(i, 1) for i in range(0, 2000, 2) if i % 20] + [(i, 3) for i in range(0, 2000, 2)] + [(i, 2) for i in range(0, 2000, 5)]
    for i, b, depth in cells:
        for gene, rate in ((1, 0.01 * (3 if b == "a" else 1)), (2, 0.02 * (0.4 if i % 5 == 0 else 1))):
            n = int(rng.poisson(rate * depth))
            if n:
                counts.append((i, gene, n))
    got = {(r.guide, r.gene): r for r in models.stratified_score(
        spark.createDataFrame(counts, "cell long, gene long, n long"), spark.createDataFrame(treated, "cell long, guide long"), spark.createDataFrame(cells, "cell long, batch string, depth double"), [100.0, 200.0, 300.0]).collect()}
    # guide 1 marks most of batch a: gene 1 differs by batch, which the rates of batches take up; guide 3 marks all of it and can't be told from it
    assert got[1, 3].z is None if (1, 3) in got else got[3, 1].z is None
    assert abs(got[1, 1].z) < 4 and abs(got[2, 1].z) < 4 and got[2, 2].z < -15 and got[2, 2].log2_fc < -0.8


def test_preparation(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0, 4.0, "x"), (2, "b", None, 3.0, 6.0, "y"), (3, "a", None, 5.0, 10.0, "x"), (4, "b", None, 9.0, 18.0, "y")], "i int, batch string, none string, depth double, twice double, copy string")
    from screenloom.operators import concat, preparation

    assert preparation.varying(df, ["batch", "none", "depth"]) == ["batch", "depth"]
    assert preparation.independent(df, ["depth", "none", "twice", "batch", "copy"]) == ["depth", "batch"]
    assert preparation.formula(df, ["none", "batch"]) == "batch"
    kept, gone = preparation.dropped_without(spark.createDataFrame([(1, "s"), (None, "t"), (2, None)], "guide_id int, spacer string"), "guide_id", "spacer")
    assert kept.count() == 1 and gone == 2
    frames = [spark.createDataFrame([(1, 5)], "cell long, n int"), spark.createDataFrame([(1, 6)], "cell long, m int")]
    assert sorted(map(tuple, concat.with_batches(frames).select("cell", "n", "m").collect()), key=str) == [("1_0", 5, None), ("1_1", None, 6)]
    assert concat.missing_columns(df, ["i", "z"]) == ["z"]
    with pytest.raises(checks.CheckError):
        pairs.present(spark.createDataFrame([(1, 2)], "guide_id int, gene int"), spark.createDataFrame([(3,)], "gene int"), spark.createDataFrame([(1,)], "guide_id int"), needed=True)
    with pytest.raises(ValueError):
        preparation.control_elements(df, "other")


def test_mismatches(spark):
    df = spark.createDataFrame([(0, "ACG")], "guide_order int, spacer string")
    assert sequences.mismatches(df).count() == 10


def test_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for name, text in {"matrix.mtx.gz": "%%MatrixMarket\n2 2 2\n1 1 5\n2 2 7\n", "features.tsv.gz": "f1\nf2\n", "barcodes.tsv.gz": "b1\nb2\n"}.items():
        with gzip.open(tmp_path / "m" / name, "wt") as f:
            f.write(text)
    assert sorted(map(tuple, files.read_matrix(spark, str(tmp_path / "m")).collect())) == [("b1", "f1", 5), ("b2", "f2", 7)]
    (tmp_path / "a.gtf").write_text('#x\nchr1\ts\tgene\t1\t9\t.\t+\t.\tgene_id "E1.2"; gene_name "N";\n')
    assert files.read_gtf(spark, str(tmp_path / "a.gtf")).first().gene == "E1"
    (tmp_path / "r.fastq").write_text("".join(f"@{i}\n{'ACGT'[i] * 4}\n+\nIIII\n" for i in range(4)))
    assert [r.seq for r in files.read_fastq(spark, str(tmp_path / "r.fastq"), 2).orderBy("read_id").collect()] == ["AAAA", "CCCC"]
    (tmp_path / "s.csv").write_text("R1_path,R2_path,file_modality,measurement_sets,sequencing_run,lane\n a1 ,a2,scRNA,m1,1,1\nb1,b2,scRNA,m1,1,2\n")
    row = files.samples(files.read_sheet(spark, str(tmp_path / "s.csv"))).first()
    assert (row.id, row.modality, row.files) == ("sample_scRNA_m1", "scrna", ["a1", "a2", "b1", "b2"])
    (tmp_path / "i.json").write_text('{"n": 3, "p": 1.5}')
    (tmp_path / "r.fa").write_text(">one x\nACGT\nAC\n>two\n\nGG\n")
    assert [tuple(r) for r in files.read_fasta(spark, str(tmp_path / "r.fa")).orderBy("read_id").collect()] == [(0, "one x", "ACGTAC"), (1, "two", "GG")]
    assert [r.seq for r in files.read_reads(spark, str(tmp_path / "r.fa"), 1).collect()] == ["ACGTAC"] and files.read_reads(spark, str(tmp_path / "r.fastq")).count() == 4
    (tmp_path / "p.tsv").write_text("#c\nchrom\tstart\tend\tscore\nchr1\t5\t9\t2.5\n")
    assert tuple(files.read_peaks(spark, str(tmp_path / "p.tsv")).first()) == ("chr1", 5, 9, 2.5)
    (tmp_path / "b.bed").write_text("chr1\t5\t9\tn\t2.5\n")
    assert tuple(files.read_bed(spark, str(tmp_path / "b.bed")).first()) == ("chr1", 5, 9, "n", 2.5)
    (tmp_path / "t" / "u").mkdir(parents=True)
    (tmp_path / "t" / "x.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "t" / "u" / "y.csv").write_text("b,a\n4,3\n")
    for paths in (str(tmp_path / "t"), [str(tmp_path / "t"), str(tmp_path / "t" / "x.tsv")]):
        assert sorted((r.a, r.b) for r in files.read_table(spark, paths, required=["a"]).collect()) == [("1", "2"), ("3", "4")]
    with pytest.raises(checks.CheckError):
        files.read_table(spark, str(tmp_path / "t"), required=["z"])
    files.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "w.tsv"))
    assert [tuple(r) for r in files.read_table(spark, str(tmp_path / "w.tsv")).collect()] == [("1", "x")] if any(f.name.endswith(".tsv.gz") for f in (tmp_path / "w.tsv").iterdir()) else True
    counts = spark.createDataFrame([(f"b{i % 7}", f"f{i % 11}", i + 1) for i in range(60)], "cell string, feature string, n long")
    files.write_matrix(counts, str(tmp_path / "mm"))
    assert sorted(map(tuple, files.read_matrix(spark, str(tmp_path / "mm")).collect())) == sorted(map(tuple, counts.collect()))
    import hashlib

    sums = spark.createDataFrame([(str(tmp_path / "r.fa"), hashlib.md5((tmp_path / "r.fa").read_bytes()).hexdigest()), (str(tmp_path / "p.tsv"), "0" * 32)], "path string, md5 string")
    assert {r.path.rsplit("/", 1)[1]: r.matches for r in files.verified(sums).collect()} == {"r.fa": True, "p.tsv": False}
    assert {tuple(r) for r in files.read_run_info(spark, str(tmp_path / "i.json")).collect()} == {("n", "3"), ("p", "1.5")}


def test_windowed_totals(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "f"), ("2024-01-01 00:50:00", "f"), ("2024-01-01 01:10:00", "g"), ("2024-01-01 09:00:00", "g")]
    spark.createDataFrame(rows, "ts string, feature string").selectExpr("cast(ts as timestamp) ts", "feature").write.parquet(str(tmp_path / "in"))
    stream = ingest.windowed_totals(spark.readStream.schema("ts timestamp, feature string").parquet(str(tmp_path / "in")))
    ingest.append_counts(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert {(r.feature, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("f", 2), ("g", 1)}


def test_split_by_batch(spark, tmp_path):
    from screenloom.operators import preparation

    preparation.split_by_batch(spark.createDataFrame([(1, "a b"), (2, "c")], "cell long, batch string"), str(tmp_path / "s"))
    assert sorted(f.name for f in (tmp_path / "s").iterdir() if f.is_dir()) == ["batch=a_b", "batch=c"]


def test_stream_drops_repeats(spark, tmp_path):
    schema = "ts timestamp, cell long, feature string, umi string"
    rows = [("2024-01-01 00:00:00", 1, "f", "u"), ("2024-01-01 00:00:01", 1, "f", "u"), ("2024-01-01 00:00:02", 1, "f", "v")]
    spark.createDataFrame(rows, "ts string, cell long, feature string, umi string").selectExpr("cast(ts as timestamp) ts", "cell", "feature", "umi").write.parquet(str(tmp_path / "in"))
    ingest.append_counts(ingest.distinct_molecules(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_checks_and_plan(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(checks.CheckError):
        checks.require_unique(df, "k")
    with pytest.raises(checks.CheckError):
        checks.require_columns(df, "x")
    from screenloom.catalog import Screen

    s = Screen(spark, "/root/testdata/sf0.001")
    out = screen.analyse(screen.Screen(s.counts, s.assigned, s.cells, s.genes, s.guides).checked(), mito_below=50.0, limit=None)
    assert out["per_guide"].count() > 0


def test_flanks_are_taken_where_the_read_is(spark):
    """Hits come with the letters before them, as with_flank has them, and without a join by read; anchors are found across batches, spans and letters of several bytes."""
    rng = random.Random(8)
    guides = ["".join(rng.choice("abcdé") for _ in range(n)) for n in (18, 25, 40, 17)]
    reads = [(i, "".join(rng.choice("abcdé") for _ in range(rng.randrange(60))) + (guides[i % 4] if i % 3 else "") + "z" * (i % 5)) for i in range(200)] + [(900, None), (901, ""), (902, guides[2] + guides[0] + guides[2])]
    r, g = spark.createDataFrame(reads, "read_id long, seq string"), spark.createDataFrame(list(enumerate(guides)), "guide_order long, spacer string")
    made = sequences.guide_hits(r, g, flank=12)
    assert "Join [read_id" not in made._jdf.queryExecution().executedPlan().toString() and "Inner, (read_id" not in made._jdf.queryExecution().optimizedPlan().toString()
    expected = sorted(map(tuple, sequences.with_flank(sequences.guide_hits(r, g), r, g).collect()))
    assert sorted(map(tuple, made.collect())) == expected and len(expected) > 130
    plain = sorted((i, *min((k, t.index(s)) for k, s in enumerate(guides) if s in t)) for i, t in reads if t and any(s in t for s in guides))
    assert [(a, b, c) for a, b, c, _ in expected] == plain
    binary = [t.encode() for _, t in reads if t]
    run = sequences._anchored([guides[0].encode()[3:12]], 9, span=7)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(binary))), pa.array(binary, pa.binary())], names=["read_id", "read"]).slice(5)
    got = {row["read_id"]: row["places"] for out in run([batch]) for row in out.to_pylist()}
    assert got == {i: p for i, t in enumerate(binary) if i >= 5 and (p := [k + 1 for k in range(len(t)) if t[k : k + 9] == guides[0].encode()[3:12]])}
