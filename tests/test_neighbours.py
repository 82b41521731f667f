"""Neighbour descent against all pairs."""

import numpy as np

from screenloom.operators import models, neighbours


def frame(spark, x, batch):
    return spark.createDataFrame([(b, i, [float(v) for v in row]) for i, (row, b) in enumerate(zip(x, batch))], "batch string, id long, pc array<double>").repartition(5)


def recall(got, x, batch, k):
    """The share of each point's k nearest of its batch, by distance, that the graph has."""
    hits = wanted = 0
    for b in set(batch):
        own = np.array([i for i, value in enumerate(batch) if value == b])
        away = np.sqrt(((x[own][:, None] - x[own][None]) ** 2).sum(axis=2))
        np.fill_diagonal(away, np.inf)
        for i, row in zip(own, away):
            size = min(k, len(own) - 1)
            wanted += size
            limit = np.sort(row)[size - 1] if size else 0
            hits += sum(r.distance <= limit + 1e-5 for r in got.get((b, int(i)), []))
    return hits / wanted


def by_point(rows):
    out = {}
    for r in rows:
        out.setdefault((r.batch, r.id), []).append(r)
    return out


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(1500, 8)), rng.normal(size=(900, 8)) * 0.3 + 4, rng.normal(size=(12, 8))])
    batch = ["a" if i % 3 else None for i in range(2400)] + ["few"] * 12
    got = by_point(neighbours.neighbour_graph(frame(spark, x, batch), k=15).collect())
    assert recall(got, x, batch, 15) >= 0.9
    for (b, i), rows in got.items():
        rows.sort(key=lambda r: r.rank)
        assert [r["rank"] for r in rows] == list(range(1, 1 + (11 if b == "few" else 15)))
        assert len({r.neighbour for r in rows}) == len(rows) and i not in {r.neighbour for r in rows}
        assert [r.distance for r in rows] == sorted(r.distance for r in rows)
        assert all(batch[r.neighbour] == b and abs(r.distance - np.sqrt(((x[i] - x[r.neighbour]) ** 2).sum())) < 1e-5 for r in rows)


def test_descent_beats_its_start(spark):
    """The start alone, one round of hashed groups, has a low recall in a batch of many groups."""
    rng = np.random.default_rng(4)
    x, batch = rng.normal(size=(3000, 6)), ["a"] * 3000
    points = frame(spark, x, batch)
    start = recall(by_point(neighbours.neighbour_graph(points, k=10, group=60, rounds=0).collect()), x, batch, 10)
    assert start < 0.3
    assert recall(by_point(neighbours.neighbour_graph(points, k=10, group=60).collect()), x, batch, 10) >= 0.9


def test_equal_points_spread(spark):
    """A third of all points are equal: they link to one another, not all to the same few."""
    rng = np.random.default_rng(5)
    x = np.concatenate([np.zeros((500, 4)), rng.normal(size=(1000, 4)) + 3])
    got = neighbours.neighbour_graph(frame(spark, x, ["a"] * 1500), k=8).collect()
    equal = [r for r in got if r.id < 500]
    assert len(equal) == 500 * 8 and all(r.distance == 0 and r.neighbour < 500 for r in equal)
    assert np.bincount([r.neighbour for r in equal]).max() < 100


def test_small_tables(spark):
    one = frame(spark, np.zeros((1, 2)), ["a"])
    assert neighbours.neighbour_graph(one).count() == 0 and neighbours.neighbour_graph(one.limit(0)).count() == 0
    some = spark.createDataFrame([("a", 1, [0.0]), ("a", 2, [3.0]), ("a", None, [1.0]), ("a", 4, None)], "batch string, id long, pc array<double>")
    assert {(r.id, r.neighbour, r.distance) for r in neighbours.neighbour_graph(some).collect()} == {(1, 2, 3.0), (2, 1, 3.0)}


def test_components_of_null_and_single_batches(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 4))
    rows = [(None if i < 40 else 7 if i < 59 else 8, i, x[i].tolist()) for i in range(60)]
    got = {r.id: r for r in models.components_by_batch(spark.createDataFrame(rows, "batch int, id long, features array<double>"), 2).collect()}
    assert len(got) == 60 and got[0].batch is None and got[50].batch == 7 and got[59].pc == [0.0, 0.0]
    own = np.array([got[i].pc for i in range(40)])
    assert np.allclose(own.var(axis=0), np.sort(np.linalg.eigvalsh(np.corrcoef(x[:40].T)))[::-1][:2], rtol=1e-4)
