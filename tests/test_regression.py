"""Negative-binomial regression and resampled p-values against plain numpy over single cells."""

import numpy as np
import pytest

from screenloom.operators import regression
from screenloom.plans.checks import CheckError


@pytest.fixture(scope="module")
def screen(spark):
    """1,500 cells of three batches with depths, 60 genes without any effect of the ten guides."""
    rng = np.random.default_rng(11)
    n, genes = 1500, 60
    batch, depth = rng.integers(0, 3, n), rng.lognormal(5, 0.5, n)
    rate = np.exp(rng.normal(-5.5, 1.0, genes))
    mean = rate[None, :] * depth[:, None] * np.array([1.0, 1.6, 0.7])[batch][:, None]
    counts = rng.poisson(mean * rng.gamma(2.0, 0.5, mean.shape))
    treated = [(int(c), g) for g in range(10) for c in rng.choice(n, 60, replace=False)]
    cells = spark.createDataFrame([(i, None if b == 2 else "ab"[b], float(np.log(d))) for i, (b, d) in enumerate(zip(batch, depth))], "cell long, batch string, log_depth double")
    rows = spark.createDataFrame([(int(c), int(g), int(counts[c, g])) for c, g in zip(*np.nonzero(counts))], "cell long, gene long, n long")
    return batch, np.log(depth), counts, treated, cells, rows, spark.createDataFrame(treated, "cell long, guide long")


def plain_fit(x, y):
    """Coefficients and overdispersion of one gene over single cells."""
    beta, spread = np.zeros(x.shape[1]), 0.0
    beta[0] = np.log(max(y.mean(), 0.5 / len(y)))
    ridge = np.diag([0.0] + [regression.RIDGE] * (x.shape[1] - 1))
    for _ in range(400):
        mean = np.exp(x @ beta)
        scale = 1 + spread * mean
        step = np.linalg.solve(x.T @ (x * (mean / scale)[:, None]) + ridge, x.T @ ((y - mean) / scale) - ridge @ beta)
        beta = beta + np.clip(step, -3, 3)
        mean = np.exp(x @ beta)
        spread = max(((y - mean) ** 2 - mean).sum() / (mean**2).sum(), 0.0)
    return beta, spread


@pytest.mark.parametrize("step,close", [(None, 1e-4), (1 / 64, 0.05)])
def test_regression(screen, step, close):
    batch, depth, counts, _, cells, rows, _ = screen
    made = regression.design(cells, ["batch"], ["log_depth"], step)
    assert made.names == ["intercept", "batch=a", "batch=b", "log_depth"] and made.sizes.sum() == len(batch)
    got = {r.gene: r for r in regression.nb_regression(rows, made).collect()}
    x = np.stack([np.ones(len(batch)), batch == 0, batch == 1, depth], axis=1).astype(float)
    assert sum(r.converged for r in got.values()) >= 0.95 * len(got)
    for gene in range(0, 60, 6):
        beta, spread = plain_fit(x, counts[:, gene].astype(float))
        assert np.allclose(got[gene].beta, beta, atol=close * 10 if step else close), gene
        assert got[gene].spread == pytest.approx(spread, abs=close)
    rounded = regression.coefficients(regression.nb_regression(rows, made), made.names).where("gene = 0").collect()
    assert [r.covariate for r in rounded] == made.names and all(r.se > 0 for r in rounded)


def test_too_many_strata(screen):
    with pytest.raises(CheckError):
        regression.design(screen[4], ["batch"], ["log_depth"], None, most=100)


def test_regression_of_nothing(spark, screen):
    made = regression.design(screen[4], ["batch"], ["log_depth"])
    assert regression.nb_regression(screen[5].limit(0), made).collect() == []
    none = regression.design(screen[4].limit(0), ["batch"], ["log_depth"])
    assert none.names == ["intercept", "log_depth"] and len(none.x) == 0


def test_skew_upper():
    """Against sums of exponential variables' moments: a normal one, and numerical integration of the density."""
    grid = np.linspace(-12, 12, 200_001)
    for skew in (-0.8, 0.0, 0.3, 0.9):
        third = abs(skew) ** (2 / 3)
        delta = np.sign(skew) * np.sqrt(np.pi / 2 * third / (third + ((4 - np.pi) / 2) ** (2 / 3)))
        shape, width = delta / np.sqrt(1 - delta**2), 1 / np.sqrt(1 - 2 * delta**2 / np.pi)
        h = (grid + width * delta * np.sqrt(2 / np.pi)) / width
        density = 2 / width * np.exp(-h * h / 2) / np.sqrt(2 * np.pi) * (1 - regression.normal_upper(shape * h))
        for z in (-1.5, 0.0, 1.0, 2.5):
            assert regression.skew_upper(np.array([z]), np.array([skew]))[0] == pytest.approx(np.trapezoid(density[grid >= z], grid[grid >= z]), abs=2e-4)


def test_drawn_sums():
    """Draws without replacement have the mean and variance that such draws have, and repeat."""
    rng = np.random.default_rng(2)
    stratum, cell, e = np.repeat([3, 9], [40, 25]), np.arange(65), rng.gamma(1, 1, 65)
    m, sizes = np.repeat([10.0, 25.0], [40, 25]), np.repeat([100.0, 25.0], [40, 25])
    got = regression.drawn_sums(stratum, cell, e, m, sizes, 7, 20_000)
    first = np.concatenate([e[:40], np.zeros(60)])
    assert got.mean() == pytest.approx(10 * first.mean() + e[40:].sum(), rel=0.01)
    assert got.var() == pytest.approx(10 * 90 / 99 * first.var(), rel=0.05)
    assert (got == regression.drawn_sums(stratum[::-1], cell[::-1], e[::-1], m[::-1], sizes[::-1], 7, 20_000)).mean() > 0.99


@pytest.mark.parametrize("limit", [0.9, -1.0])
def test_resampled(spark, screen, limit):
    """Uniform under the null, and close to 4,000 plain permutations within strata for 20 pairs; by the fit and by draws alone."""
    batch, depth, counts, treated, cells, rows, guides = screen
    made = regression.design(cells, ["batch"], ["log_depth"], 0.5)
    fits = regression.nb_regression(rows, made)
    pairs = spark.createDataFrame([(g, i) for g in range(10) for i in range(61)], "guide long, gene long")
    got = {(r.guide, r.gene): r for r in regression.resampled_p(rows, guides, made, fits, pairs, limit=limit, draws=499).collect()}
    assert len(got) == 610 and got[0, 60].p_value is None
    assert {r.by for r in got.values() if r.gene < 60} <= ({"draws", "fit"} if limit > 0 else {"draws"})
    values = np.sort([r.p_value for r in got.values() if r.gene < 60])
    far = np.abs(values - (np.arange(len(values)) + 0.5) / len(values)).max()
    assert far < 0.09, far
    strata = {r.cell: r.stratum for r in made.placed.collect()}
    code = np.array([strata[i] for i in range(len(batch))])
    model = {r.gene: (np.array(r.beta), r.spread) for r in fits.collect()}
    rng = np.random.default_rng(4)
    for k in range(20):
        guide, gene = k % 10, (7 * k) % 60
        beta, spread = model[gene]
        e = counts[:, gene] / (1 + spread * np.exp(made.x @ beta))[code]
        mine = np.array([c for c, g in treated if g == guide])
        null = np.zeros(4000)
        for s in np.unique(code[mine]):
            own, m = np.flatnonzero(code == s), int((code[mine] == s).sum())
            null += np.stack([e[rng.choice(own, m, replace=False)].sum() for _ in range(4000)])
        score = e[mine].sum()
        p = min(1, 2 * min((1 + (null >= score - 1e-9).sum()) / 4001, (1 + (null <= score + 1e-9).sum()) / 4001))
        assert got[guide, gene].score == pytest.approx(score, abs=1e-5)
        assert got[guide, gene].z == pytest.approx((score - null.mean()) / null.std(), abs=0.1)
        assert got[guide, gene].p_value == pytest.approx(p, abs=0.09), (guide, gene)
