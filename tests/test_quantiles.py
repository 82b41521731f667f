"""Exact quantiles by counting against numpy, and pairs of crowded bins against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.operators import order, pairs, qc, quantiles

SHARES = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("bins,few", [(4, 100_000), (1024, 0)])
def test_exact_quantiles(spark, bins, few):
    """A group of two thirds of the rows, ties, a null key, nulls and NaN, values of very unequal size, one row, all null; by broadcast and by shuffle."""
    rng = np.random.default_rng(3)
    rows = [("big", float(v), int(n)) for v, n in zip(rng.lognormal(0, 3, 4000), rng.integers(0, 5, 4000))]
    rows += [("far", v, 1) for v in (-1e300, -5.0, 0.0, 1e-300, 2.0, 1e300)] + [("one", 7.5, 3), (None, 1.0, 1), (None, 4.0, None), ("none", None, 2), ("nan", float("nan"), 1), ("nan", 3.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r.g, r.column, r.share): r.value for r in quantiles.exact_quantiles(df, ["g"], ["v", "n"], SHARES, bins, few).collect()}
    wanted = {}
    for g in {r[0] for r in rows}:
        for c, name in ((1, "v"), (2, "n")):
            x = [r[c] for r in rows if r[0] == g and r[c] is not None and r[c] == r[c]]
            wanted |= {(g, name, s): float(np.quantile(x, s)) for s in SHARES if x}
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(wanted[k], rel=1e-12, abs=0) for k in wanted)


def test_quantiles_without_keys(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, inf, -inf, 9e307)], "v double")
    got = {r.share: r.value for r in quantiles.exact_quantiles(df, [], ["v"], [0.0, 0.25, 0.5, 0.75, 1.0], 4).collect()}
    assert got == {0.0: -inf, 0.25: 1.0, 0.5: 2.0, 0.75: 9e307, 1.0: inf}
    assert quantiles.exact_quantiles(df.where("v is null"), [], ["v"], [0.5]).count() == 0


@pytest.mark.parametrize("size", [3, 1000])
def test_crowded_bins(spark, size):
    """Half of all positions in one bin, many on one position, nulls: the pairs are those of a plain comparison, each once."""
    rng = np.random.default_rng(2)
    pos = [int(v) for v in np.concatenate([rng.integers(0, 3000, 60), rng.integers(1000, 1100, 40), np.full(20, 1050)])]
    guides = [(i, "ab"[i % 2], p) for i, p in enumerate(pos)] + [(900, None, 5), (901, "a", None)]
    genes = [(i, "ab"[i % 3 % 2], p + 30) for i, p in enumerate(reversed(pos))] + [(900, None, 5), (901, "a", None)]
    a, b = spark.createDataFrame(guides, "guide_id long, chr string, pos long"), spark.createDataFrame(genes, "gene long, chr string, pos long")
    got = sorted((r.guide_id, r.gene, r.chr, r.distance) for r in pairs.within_distance(a, b, 100, size).collect())
    assert got == sorted((g, h, c, abs(p - q)) for g, c, p in guides for h, d, q in genes if c and c == d and p is not None and q is not None and abs(p - q) <= 100)

    left = [(i, c, p, p + int(w)) for (i, c, p), w in zip(guides[:120], rng.integers(1, 300, 120))]
    right = [(i, c, p, p + int(w)) for (i, c, p), w in zip(genes[:120], rng.integers(1, 300, 120))]
    kind = "id long, chr string, start long, stop long"
    met = pairs.overlapping(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), 150, size).collect()
    assert sorted((r.a_id, r.b_id, r.chr, r.overlap) for r in met) == sorted((i, j, c, min(t, v) - max(s, u)) for i, c, s, t in left for j, d, u, v in right if c == d and s < v and u < t)


def test_one_name_of_half_the_rows(spark):
    """Repeats, the first of each key and numbered names, where half of the rows have one name; null names too."""
    rows = [(i, None if i % 10 == 9 else "hot" if i % 2 else f"n{i % 300}", i % 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, name string, kind int")
    count = {}
    for _, name, kind in rows:
        count[name, kind] = count.get((name, kind), 0) + 1
    repeated = order.repeated_keys(df, ["name", "kind"])
    assert repeated.columns == df.columns
    assert sorted(r.id for r in repeated.collect()) == [i for i, name, kind in rows if count[name, kind] > 1]
    first, last = {}, {}
    for row in rows:
        first.setdefault(row[1], row)
        last[row[1]] = row
    assert {tuple(r) for r in order.first_per_key(df, ["name"], ["id"]).collect()} == set(first.values())
    assert {tuple(r) for r in order.first_per_key(df, ["name"], [F.desc("id")]).collect()} == set(last.values())
    seen, wanted = {}, {}
    for i, name, _ in rows:
        n = seen.get(name, 0)
        seen[name] = n + 1
        wanted[i] = name if n == 0 or name is None else f"{name}-{n}"
    assert {r.id: r.unique_name for r in order.unique_names(df, "name", "id").collect()} == wanted


def test_summaries(spark):
    """A batch without a name is called as all cells are, but has its own quantiles; no cells don't crash."""
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 20), (None, 8, 30), ("b", None, 5)], "batch string, x int, y int")
    got = sorted((r.batch, r.n_cells, r.x_median, r.x_q75, r.y_median) for r in qc.summaries(df, ["x", "y"]).collect() if r.batch != "b")
    assert got == [("a", 2, 2.0, 2.5, 15.0), ("all", 1, 8.0, 8.0, 30.0), ("all", 4, 3.0, 5.5, 15.0)]
    [b] = qc.summaries(df, ["x", "y"]).where("batch = 'b'").collect()
    assert (b.n_cells, b.x_median, b.x_max, b.y_median) == (1, None, None, 5.0)
    assert all(r.x_median is None for r in qc.summaries(df.limit(0), ["x", "y"]).collect())
