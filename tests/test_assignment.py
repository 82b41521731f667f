"""The mixture with covariates against plain EM over single cells, and on planted cells."""

import numpy as np
import pytest

from screenloom.operators import assignment, regression


@pytest.fixture(scope="module")
def planted(spark):
    """2,000 cells of two batches whose depths differ widely; five guides with ambient counts that follow depth and batch, 6 % of the cells with 15 times as many."""
    rng = np.random.default_rng(5)
    n = 2000
    batch, depth = rng.integers(0, 2, n), np.round(rng.normal(0, 1.0, n) * 16) / 16
    ambient = np.exp(-1.2 + 1.0 * depth + 0.8 * batch)
    truth = rng.random((5, n)) < 0.06
    counts = rng.poisson(ambient * np.where(truth, 15.0, 1.0))
    cells = spark.createDataFrame([(i, "ab"[b], float(d)) for i, (b, d) in enumerate(zip(batch, depth))], "cell long, batch string, depth double")
    rows = spark.createDataFrame([(int(c), int(g), int(counts[g, c])) for g, c in zip(*np.nonzero(counts))], "cell long, guide long, n long")
    return batch, depth, truth, counts, cells, rows


def plain_em(x, y, start):
    """Posterior of each cell, and the log ratio: EM over single cells, every M step solved to the end."""
    n, width = x.shape
    ridge = np.diag([0.0] + [regression.RIDGE] * (width - 1) + [0.0])
    theta = np.zeros(width + 1)
    theta[0] = np.log(y.mean())
    long_x = np.vstack([np.hstack([x, np.zeros((n, 1))]), np.hstack([x, np.ones((n, 1))])])
    long_y = np.concatenate([y, y])

    def solve(theta, w, free):
        for _ in range(60):
            mean = np.exp(long_x @ theta)
            h = (long_x * (w * mean)[:, None]).T @ long_x + ridge
            g = long_x.T @ (w * (long_y - mean)) - ridge @ theta
            step = np.zeros(width + 1)
            step[:free] = np.linalg.solve(h[:free, :free], g[:free])
            theta = theta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-11:
                break
        return theta

    theta = solve(theta, np.concatenate([np.ones(n), np.zeros(n)]), width)
    theta[width], share = np.log(start), 0.05
    for _ in range(500):
        low = x @ theta[:width]
        odds = np.log(share / (1 - share)) + y * theta[width] - np.exp(low) * np.expm1(theta[width])
        post = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        share = post.mean()
        theta = solve(theta, np.concatenate([1 - post, post]), width + 1)
    return post, theta, share


def test_against_plain_em(planted):
    batch, depth, _, counts, cells, rows = planted
    made = regression.design(cells, ["batch"], ["depth"], None)
    got = {(r.cell, r.guide): r.posterior for r in assignment.assign_with_covariates(rows, made, 0.0, starts=(5.0,), rounds=500).collect()}
    assert len(got) == np.count_nonzero(counts)
    x = np.stack([np.ones(len(batch)), batch == 1, depth], axis=1).astype(float)
    for guide in range(5):
        post, theta, _ = plain_em(x, counts[guide].astype(float), 5.0)
        assert theta[-1] == pytest.approx(np.log(15), abs=0.2)
        for cell in np.flatnonzero(counts[guide]):
            assert got[cell, guide] == pytest.approx(post[cell], abs=2e-4)


def test_planted_cells(planted):
    """Deep cells without the guide aren't called: constant rates call more of them."""
    from screenloom.operators import models

    batch, depth, truth, counts, cells, rows = planted
    made = regression.design(cells, ["batch"], ["depth"], 1 / 16)
    called = {(r.guide, r.cell) for r in assignment.assign_with_covariates(rows, made).collect()}
    plain = {(r.guide, r.cell) for r in models.assign_mixture(rows.join(cells.select("cell", "batch"), "cell")).collect()}
    wrong, plain_wrong = ({k for k in found if not truth[k]} for found in (called, plain))
    # what the true rates themselves would call at 0.8: no fit can find more
    ambient = np.exp(-1.2 + depth + 0.8 * batch)
    odds = np.log(0.06 / 0.94) + counts * np.log(15) - ambient * 14
    best = {(g, c) for g, c in zip(*np.nonzero((odds >= np.log(4)) & (counts > 0)))}
    assert 2 * len(wrong) < len(plain_wrong)
    assert len(called & best) >= 0.97 * len(best) and len(called - best) <= 0.03 * len(best)


def test_odd_guides(spark, planted):
    """No counts, nulls, zeros, unknown cells, a guide with one constant count in all cells, and one with a single cell."""
    cells = planted[4]
    made = regression.design(cells, ["batch"], ["depth"], 1 / 16)
    kind = "cell long, guide long, n long"
    assert assignment.assign_with_covariates(spark.createDataFrame([], kind), made).count() == 0
    rows = [(c, 1, 3) for c in range(2000)] + [(7, 2, 50), (8, 3, 0), (9, 3, None), (99999, 4, 9), (3, None, 5)]
    got = assignment.assign_with_covariates(spark.createDataFrame(rows, kind), made).collect()
    assert {(r.cell, r.guide) for r in got} == {(7, 2)}


def test_tag_sets(spark):
    """The best and the next best set, and that all sets add up to 1, by laying out every set of three tags; a cell without a tag's row; clusters."""
    from itertools import product

    from screenloom.operators import models

    rng = np.random.default_rng(8)
    truth = rng.random((600, 3)) < 0.3
    values = np.where(truth, rng.normal(2.0, 0.7, truth.shape), rng.normal(0.0, 0.7, truth.shape))
    rows = [("b", c, "xyz"[t], float(values[c, t])) for c in range(600) for t in range(3)] + [("b", 600, "x", 2.5)]
    df = spark.createDataFrame(rows, "batch string, cell long, tag string, value double")
    got = {r.cell: r for r in models.tag_sets(df, 9).collect()}
    model = {r.tag: r for r in models.normal_mixture(df.groupBy("batch", "tag", "value").count().withColumnRenamed("count", "weight")).collect()}

    def posterior(tag, x):
        m = model[tag]
        density = lambda v: [s * np.exp(-((v - a) ** 2) / (2 * b)) / np.sqrt(b) for s, a, b in ((1 - m.share, m.m0, m.v0), (m.share, m.m1, m.v1))]
        at = lambda v: density(v)[1] / sum(density(v))
        return 0.0 if x <= m.m0 else max(at(x), at(m.m1)) if x >= m.m1 else at(x)

    assert len(got) == 601 and got[600].tags == "x"
    for c in range(600):
        p = [posterior(t, values[c, i]) for i, t in enumerate("xyz")]
        sets = sorted(((np.prod([q if k else 1 - q for q, k in zip(p, kept)]), kept) for kept in product((0, 1), repeat=3)), reverse=True)
        assert sum(s for s, _ in sets) == pytest.approx(1)
        assert got[c].posterior == pytest.approx(sets[0][0], abs=1e-8) and got[c].second_posterior == pytest.approx(sets[1][0], abs=1e-8)
        assert got[c].tags == ("-".join(t for t, k in zip("xyz", sets[0][1]) if k) or "negative") and got[c].n_tags == sum(sets[0][1])
    assert np.mean([got[c].n_tags == truth[c].sum() for c in range(600)]) > 0.7
    clusters = models.tag_clusters(models.tag_sets(df, 9)).collect()
    assert [r.cluster for r in clusters] == list(range(len(clusters))) and clusters[0].tags == "negative"
    assert sum(r.cells for r in clusters) == 601 and sum(r.sure for r in clusters) == sum(r.posterior >= 0.8 for r in got.values())
    assert models.tag_sets(df.limit(0)).count() == 0


def test_valley():
    from screenloom.operators import models

    rng = np.random.default_rng(4)
    two = np.histogram(np.concatenate([rng.normal(0.25, 0.06, 4000), rng.normal(0.8, 0.05, 1500)]), 256, (0, 1))[0]
    assert 0.4 < (models.valley(two) + 0.5) / 256 < 0.68
    assert models.valley(np.exp(-((np.arange(256) - 90) ** 2) / 400)) is None
    assert models.valley(np.zeros(256)) is None and models.valley(np.ones(8)) is None
    assert models.valley(np.array([0, 5, 0, 0, 0, 9, 0])) in (2, 3)


def test_doublet_threshold(spark):
    """Cells of five kinds and pairs of unlike ones, drawn from all cells as doublets come about: the threshold from simulated scores lies between them; scores without two peaks have the one given."""
    from screenloom.operators import models

    rng = np.random.default_rng(6)
    centres = rng.normal(0, 6, (5, 12))
    single = np.concatenate([c + rng.normal(0, 1, (240, 12)) for c in centres])
    pairs = [(i, j) for i, j in rng.integers(0, 1200, (200, 2)) if i // 240 != j // 240][:60]
    double = np.array([(single[i] + single[j]) / 2 for i, j in pairs])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([single, double]))], "id long, features array<double>")
    rows = models.called_doublets(df).collect()
    assert len(rows) == 1260 and len({r.threshold for r in rows}) == 1
    called = {r.id for r in rows if r.is_doublet}
    assert len([i for i in called if i >= 1200]) >= 0.8 * 60 and len([i for i in called if i < 1200]) <= 0.1 * 1200
    kind = "score double"
    assert models.doublet_threshold(spark.createDataFrame([], kind), 0.3) == 0.3
    assert models.doublet_threshold(spark.createDataFrame([(0.5,)] * 3, kind), 0.3) == 0.3
    assert models.called_doublets(df.limit(0)).count() == 0


def test_planned_chunks(spark):
    from screenloom.operators import evaluation, guides
    from screenloom.plans.checks import CheckError

    genes = spark.range(10).selectExpr("id as gene")
    many = lambda *a: sorted((r["first"], r["last"]) for r in guides.planned_chunks(genes, 100, *a).collect())
    assert many(4) == [(1, 10)] and many(4, "auto", 999) == [(1, 4), (5, 8), (9, 10)] == many(4, "force")
    assert many(4, "auto", 1000) == [(1, 10)] == many(4, "off", 1) == many(10, "force")
    assert guides.planned_chunks(genes.limit(0), 100, 4).count() == 0
    for bad in ((4, "some"), (0, "auto")):
        with pytest.raises(CheckError):
            guides.planned_chunks(genes, 100, *bad)
    table = spark.createDataFrame([(1,), (0,), (0,)], "label int")
    assert evaluation.require_controls(table) is table
    for bad in (table.where("label = 0"), table.where("label = 1"), table.limit(0)):
        with pytest.raises(CheckError):
            evaluation.require_controls(bad)
