"""Models that iterate: each group's small table is fitted in numpy, groups in parallel."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import two_sided_p
from ..plans.store import dealt, written
from .effects import by_gene, listed
from .order import ranked


def poisson_mixture(values: np.ndarray, restarts: int = 5, rounds: int = 100, weights: np.ndarray | None = None) -> np.ndarray:
    """Posterior of the larger of two Poisson rates for each count; the best of several deterministic starts.

    A count of weight w is fitted as w equal counts.
    """
    w = np.ones(len(values)) if weights is None else weights
    n, mean = max(w.sum(), 1e-9), (w * values).sum() / max(w.sum(), 1e-9)
    best, answer = -np.inf, np.zeros(len(values))
    top = max(float(values.max(initial=1)), 1.0)
    for r in range(restarts):
        low, high, share = 0.1 + mean * 0.2, mean + top * (r + 1) / restarts, 0.1
        post = np.zeros(len(values))
        for _ in range(rounds):
            a = math.log(share) + values * math.log(high) - high
            b = math.log(1 - share) + values * math.log(low) - low
            post = 1 / (1 + np.exp(np.clip(b - a, -700, 700)))
            share = min(max((w * post).sum() / n, 1e-6), 1 - 1e-6)
            high = max((w * post * values).sum() / max((w * post).sum(), 1e-9), 1e-6)
            low = max((w * (1 - post) * values).sum() / max((w * (1 - post)).sum(), 1e-9), 1e-6)
        fit = (w * np.logaddexp(a, b)).sum()
        if fit > best:
            best, answer = fit, post if high >= low else 1 - post
    return answer


def assign_mixture(guide_counts: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(cell, guide, posterior) of the counts (batch, cell, guide, n) that belong to the upper component of their batch and guide.

    Equal counts are fitted as one with its weight, so a group is as many rows as it has different counts.
    """
    levels = guide_counts.groupBy("batch", "guide", "n").agg(F.count("*").alias("weight"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        post = poisson_mixture(pdf["n"].to_numpy(float), weights=pdf["weight"].to_numpy(float))
        return pdf[["batch", "guide", "n"]].assign(posterior=np.round(post, 6))

    fitted = levels.groupBy("batch", "guide").applyInPandas(fit, "batch string, guide long, n long, posterior double")
    return guide_counts.join(fitted, ["batch", "guide", "n"]).where(F.col("posterior") >= threshold).select("cell", "guide", "posterior")


def moments() -> list[Column]:
    """The moments that glm_score() takes, of a row of effects.sums()."""
    return [F.col("cells").alias("m"), (F.col("all_cells") - F.col("cells")).alias("rest"), F.col("s1"), F.col("q1"), (F.col("s") - F.col("s1")).alias("s0"), (F.col("q") - F.col("q1")).alias("q0")]


def glm_score(moments: DataFrame) -> DataFrame:
    """(..., score_z): score test of a log-linear count model with overdispersion, from the moments (m, rest, s1, q1, s0, q0) of two groups; other columns stay."""
    n, both = F.col("m") + F.col("rest"), F.col("s1") + F.col("s0")
    mean = both / n
    spread = F.greatest(((F.col("q1") + F.col("q0")) / n - mean * mean - mean) / F.greatest(mean * mean, F.lit(1e-12)), F.lit(0.0))
    info = F.col("m") * F.col("rest") / n * (mean + spread * mean * mean)
    kept = [c for c in moments.columns if c not in ("m", "rest", "s1", "q1", "s0", "q0")]
    return moments.select(*kept, F.round((F.col("s1") - F.col("m") * mean) / F.sqrt(F.greatest(info, F.lit(1e-12))), 6).alias("score_z"))


def strata(cells: DataFrame, depths: list[float]) -> DataFrame:
    """cells (cell, batch, depth) with stratum: its batch and how many of the ascending `depths` its depth reaches."""
    level = sum(((F.col("depth") >= d).cast("int") for d in depths), F.lit(0))
    return cells.withColumn("stratum", F.concat_ws(":", F.col("batch"), level.cast("string")))


def stratified_score(counts: DataFrame, treated: DataFrame, cells: DataFrame, depths: list[float], unit: str = "guide", digits: int = 6, parts: int = 0) -> DataFrame:
    """(unit, gene, observed, expected, log2_fc, z, p_value) of every pair with a count in a treated cell: negative-binomial score test with covariates.

    counts (cell, gene, n), treated (cell, unit), cells (cell, batch, depth). Under the null model a gene's mean in a cell is a rate of its batch
    times the cell's depth, which is taken at the mean of its stratum (batch and level of depth); its overdispersion is fitted by moments over
    all cells. The score of the treated cells against all of them has the variance that is left after the batches' rates are fitted.
    Cells without a count enter through the strata's sizes, so no zeros are laid out. Expected counts and variances are products of a gene's and
    a unit's vector over strata. A count goes to its gene with its stratum and the list of its cell's units, the one time that it is shuffled; the
    genes' vectors are worked out and meet the pairs there, the units' are broadcast.
    """
    placed = written(strata(cells, depths).select("cell", "batch", "stratum", F.col("depth").cast("double").alias("depth")), "placed")
    sizes = placed.where("batch is not null").groupBy("batch", "stratum").agg(F.count("*").alias("cells"), F.avg("depth").alias("depth"))
    rows = sorted(sizes.collect())  # a row for each batch and level of depth
    number = F.broadcast(counts.sparkSession.createDataFrame([(r.batch, r.stratum, i) for i, r in enumerate(rows)], "batch string, stratum string, place int"))
    batches = {b: [i for i, r in enumerate(rows) if r.batch == b] for b in dict.fromkeys(r.batch for r in rows)}
    placed = placed.join(number, ["batch", "stratum"], "left").select("cell", "place")

    def total(parts: list[Column]) -> Column:
        return reduce(lambda x, y: x + y, parts, F.lit(0.0))

    def vector(value: Column) -> Column:
        """The sums in all strata by their places, 0 where there is none."""
        return F.array(*[F.coalesce(F.sum(F.when(F.col("place") == i, value)), F.lit(0.0)) for i in range(len(rows))])

    def at(name: str, i: int) -> Column:
        return F.get(name, F.lit(i))

    n = F.col("n").cast("double")
    own = dealt(counts.join(placed.where("place is not null"), "cell").select("gene", "n", "place"), "gene", parts).groupBy("gene").agg(vector(n).alias("y"), vector(n * n).alias("q"))
    depth = {b: sum(rows[i].cells * rows[i].depth for i in held) for b, held in batches.items()}
    # the mean of a gene in every stratum of a batch where it has a count
    means = [F.when(y != 0, y / F.lit(depth[r.batch]) * F.lit(r.depth)).otherwise(0.0) for r in rows for y in [total([at("y", i) for i in batches[r.batch]])]]
    model = own.withColumn("means", F.array(*means))
    square = total([float(r.cells) * at("means", i) * at("means", i) for i, r in enumerate(rows)])
    left = total([at("q", i) - 2 * at("y", i) * at("means", i) for i in range(len(rows))]) + square
    model = model.select("gene", "means", F.greatest(F.lit(0.0), (left - total([float(r.cells) * at("means", i) for i, r in enumerate(rows)])) / square).alias("spread"))
    model = model.withColumn("scales", F.array(*[1 + F.col("spread") * at("means", i) for i in range(len(rows))]))
    vectors = model.select("gene", "means", F.array(*[at("means", i) / at("scales", i) for i in range(len(rows))]).alias("shares"))
    whole = [total([at("shares", i) * float(rows[i].cells) for i in held]) for held in batches.values()]
    vectors = vectors.select("*", F.array(*whole).alias("whole"))
    held = treated.join(placed.where("place is not null"), "cell").groupBy(unit, "place").agg(F.count("*").cast("double").alias("m")).groupBy(unit).agg(vector(F.col("m")).alias("held"))
    met = by_gene(counts.join(placed, "cell").join(listed(treated.select("cell", unit)), "cell").select("gene", "n", "place", "_of"), parts)
    inside = F.col("place").isNotNull()
    met = met.join(model.select("gene", "scales").hint("shuffle_hash"), "gene").select(F.inline("_of"), "gene", F.when(inside, F.col("n")).otherwise(0).alias("n"), F.when(inside, F.col("n") / F.get("scales", "place")).otherwise(0.0).alias("part"))
    pairs = met.groupBy(unit, "gene").agg(F.sum("n").cast("double").alias("observed"), F.sum("part").alias("part"))
    joined = pairs.join(vectors.hint("shuffle_hash"), "gene").join(F.broadcast(held), unit)  # a row of as many numbers as there are strata for each unit
    some = [total([at("shares", i) * at("held", i) for i in of]) for of in batches.values()]
    joined = joined.select(unit, "gene", "observed", "part", total([at("means", i) * at("held", i) for i in range(len(rows))]).alias("expected"), F.array(*some).alias("some"), "whole")
    info = total([at("some", b) - at("some", b) * at("some", b) / F.when(at("whole", b) > 0, at("whole", b)).otherwise(1.0) for b in range(len(batches))])
    joined = joined.select(unit, "gene", "observed", "expected", (F.col("part") - total([at("some", b) for b in range(len(batches))])).alias("score"), info.alias("info"))
    z = F.when(F.col("info") > 1e-9, F.col("score") / F.sqrt("info"))
    made = joined.select(unit, "gene", "observed", "expected", F.log2((F.col("observed") + 0.01) / (F.col("expected") + 0.01)).alias("log2_fc"), z.alias("z"))
    return made.select(unit, "gene", F.col("observed").cast("long").alias("observed"), *[F.round(c, digits).alias(c) for c in ("expected", "log2_fc", "z")], F.round(two_sided_p(F.col("z")), digits).alias("p_value"))


def normal_mixture(levels: DataFrame, rounds: int = 50) -> DataFrame:
    """(batch, tag, m0, v0, m1, v1, share) of (batch, tag, value, weight): two Gaussians by EM, the second with the larger mean.

    Starts from the halves at each group's mean. Spark sums each round's (n, sum, sum of squares) of both components for
    all groups at once; the driver holds a row for each group. Variances are at least a thousandth of the group's.
    """
    spark, schema = levels.sparkSession, "batch string, tag string, m0 double, v0 double, m1 double, v1 double, share double"
    levels = written(levels, "levels")
    w, x = F.col("weight").cast("double"), F.col("value")

    def sums(df: DataFrame, upper: Column) -> list:
        parts = [F.sum(c).alias(k) for k, c in {"n": w, "s": w * x, "q": w * x * x, "n1": w * upper, "s1": w * upper * x, "q1": w * upper * x * x}.items()]
        return df.groupBy("batch", "tag").agg(*parts).collect()

    whole = {(r.batch, r.tag): (r.s / r.n, max(r.q / r.n - (r.s / r.n) ** 2, 1e-12)) for r in sums(levels, F.lit(0.0))}
    centre = spark.createDataFrame([(*k, m) for k, (m, _) in whole.items()], "batch string, tag string, mean double")

    def fitted(rows: list) -> list:
        out = []
        for r in rows:
            least = whole[r.batch, r.tag][1] / 1000
            parts = []
            for n, s, q in ((r.n - r.n1, r.s - r.s1, r.q - r.q1), (r.n1, r.s1, r.q1)):
                m = s / n if n > 1e-9 else whole[r.batch, r.tag][0]
                parts += [m, max(q / n - m * m, least) if n > 1e-9 else least]
            out.append((r.batch, r.tag, *parts, min(max(r.n1 / r.n, 1e-9), 1 - 1e-9)))
        return sorted(out)

    now = fitted(sums(levels.join(F.broadcast(centre), ["batch", "tag"]), (x > F.col("mean")).cast("double")))
    for _ in range(rounds):
        model = F.broadcast(spark.createDataFrame(now, schema))
        before, now = now, fitted(sums(levels.join(model, ["batch", "tag"]), upper_share(x)))
        if all(abs(a - b) <= 1e-9 * (1 + abs(a)) for p, q in zip(before, now) for a, b in zip(p[2:], q[2:])):
            break
    return spark.createDataFrame([r if r[2] <= r[4] else (*r[:2], *r[4:6], *r[2:4], 1 - r[6]) for r in now], schema)


def upper_share(x: Column) -> Column:
    """Posterior of the second Gaussian (m1, v1, share) against the first (m0, v0) at x."""
    lower = F.log(1 - F.col("share")) - F.log("v0") / 2 - (x - F.col("m0")) ** 2 / (2 * F.col("v0"))
    upper = F.log("share") - F.log("v1") / 2 - (x - F.col("m1")) ** 2 / (2 * F.col("v1"))
    return 1 / (1 + F.exp(F.least(F.greatest(lower - upper, F.lit(-700.0)), F.lit(700.0))))


def hashing_tags(tag_counts: DataFrame) -> DataFrame:
    """(cell, tags) from (batch, cell, tag, value): tags more likely of the upper of two Gaussians of their batch and tag, joined by '-'; none: negative.

    Every cell counts in the fit. A value below the lower mean is never of the upper Gaussian, one above the upper mean always is; a
    group with one value has no tag.
    """
    levels = tag_counts.groupBy("batch", "tag", "value").agg(F.count("*").alias("weight"))
    model = F.broadcast(normal_mixture(levels))
    x = F.col("value")
    positive = (F.col("m1") > F.col("m0")) & (x > F.col("m0")) & ((x >= F.col("m1")) | (upper_share(x) > 0.5))
    marked = tag_counts.join(model, ["batch", "tag"]).groupBy("batch", "cell").agg(F.array_join(F.array_sort(F.collect_list(F.when(positive, F.col("tag")))), "-").alias("tags"))
    return marked.select("cell", F.when(F.col("tags") == "", "negative").otherwise(F.col("tags")).alias("tags"))


def tag_sets(tag_counts: DataFrame, digits: int = 6) -> DataFrame:
    """(batch, cell, tags, n_tags, posterior, second_posterior) from (batch, cell, tag, value): each cell's most likely set of tags among all sets.

    A set's probability is the product of its tags' posteriors of the upper Gaussian and of the other tags' of the lower one; over all sets they add up to
    1. So the best set has each tag on its likelier side, the next best differs in the tag whose sides are closest, and no other set
    has to be laid out. A posterior never falls as the value rises: it is 0 up to the lower mean, and beyond the upper one at least what it is there. A tag without a row is
    absent. Tags are joined by '-'; none: negative. A tie goes to the set without the tag.
    """
    levels = tag_counts.groupBy("batch", "tag", "value").agg(F.count("*").alias("weight"))
    x = F.col("value")
    share = F.when((F.col("m1") <= F.col("m0")) | (x <= F.col("m0")), 0.0).when(x >= F.col("m1"), F.greatest(upper_share(x), upper_share(F.col("m1")))).otherwise(upper_share(x))
    placed = tag_counts.join(F.broadcast(normal_mixture(levels)), ["batch", "tag"]).withColumn("p", share)
    likelier, other = F.greatest("p", 1 - F.col("p")), F.least("p", 1 - F.col("p"))
    tags = F.array_sort(F.collect_list(F.when(F.col("p") > 0.5, F.col("tag"))))
    found = placed.groupBy("batch", "cell").agg(tags.alias("found"), F.exp(F.sum(F.log(likelier))).alias("posterior"), F.max(other / likelier).alias("odds"))
    name = F.when(F.size("found") == 0, "negative").otherwise(F.array_join("found", "-"))
    return found.select("batch", "cell", name.alias("tags"), F.size("found").alias("n_tags"), F.round("posterior", digits).alias("posterior"), F.round(F.col("posterior") * F.col("odds"), digits).alias("second_posterior"))


def tag_clusters(sets: DataFrame, least: float = 0.8, digits: int = 6) -> DataFrame:
    """(cluster, tags, n_tags, cells, sure, mean_posterior) of tag_sets(): clusters are numbered from 0 by the number of tags, then their names; sure cells have a posterior of `least` or more."""
    groups = sets.groupBy("n_tags", "tags").agg(F.count("*").alias("cells"), F.count_if(F.col("posterior") >= least).alias("sure"), F.round(F.avg("posterior"), digits).alias("mean_posterior"))
    number = F.row_number().over(W.orderBy("n_tags", "tags")) - 1  # a row for each set that occurs
    return groups.select(number.alias("cluster"), "tags", "n_tags", "cells", "sure", "mean_posterior")


def local_basis(lo: float, hi: float, knots: np.ndarray) -> np.ndarray:
    """The spline's functions 1, x, x^2, x^3 and (x - k)^3 beyond each knot as cubics of u = (x - lo) / (hi - lo), one a column, between neighbouring knots lo and hi."""
    h = hi - lo
    power = [[math.comb(p, q) * lo ** (p - q) * h**q if q <= p else 0.0 for q in range(4)] for p in range(4)]
    beyond = [[math.comb(3, q) * (lo - k) ** (3 - q) * h**q for q in range(4)] if k <= lo else [0.0] * 4 for k in knots]
    return np.array(power + beyond).T


def spline_sums(points: DataFrame, x: Column, y: Column, knots: np.ndarray) -> dict[int, tuple]:
    """For each interval between knots that has points: their number, the sum of y^2, of u^p (p to 6) and of y u^p (p to 3). All that a fit asks of them."""
    bounds = [0.0, *knots.tolist(), 1.0]
    t = points.select(x.alias("t"), y.alias("y"))
    t = t.withColumn("i", F.size(F.filter(F.lit(knots.tolist()), lambda k: k <= F.col("t"))) if len(knots) else F.lit(0))
    lo, hi = (F.element_at(F.lit(bounds), F.col("i") + n) for n in (1, 2))
    u = (F.col("t") - lo) / (hi - lo)
    powers = [F.sum(F.pow("u", F.lit(p))).alias(f"u{p}") for p in range(7)] + [F.sum(F.col("y") * F.pow("u", F.lit(p))).alias(f"y{p}") for p in range(4)]
    rows = t.withColumn("u", u).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("y") ** 2).alias("square"), *powers).collect()  # a row an interval
    return {r.i: (r.n, r.square, np.array([r[f"u{p}"] for p in range(7)]), np.array([r[f"y{p}"] for p in range(4)])) for r in rows}


def smoothing_spline(points: DataFrame, x: str, y: str, last: int, most_knots: int = 63, fewest: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(knots, coefficients) of a cubic smoothing spline of points whose squared residuals add up to their number, or to less if a plain cubic's do.

    x runs from 1 to last and is scaled to 0 .. 1. Knots are put into the middle of the intervals with the greatest residuals, one first and then as many as there are,
    until the least-squares spline's residuals are within the points' number, most_knots are reached or no interval with residuals has `fewest` points
    for each half. Of the splines with these knots the one with the least jumps of its third derivative is taken whose residuals are that
    number. Each round is one aggregation with eleven sums an interval.
    """
    t = (F.col(x).cast("double") - 1) / max(1, last - 1)
    knots = np.empty(0)
    while True:
        held = spline_sums(points, t, F.col(y).cast("double"), knots)
        bounds, size = [0.0, *knots, 1.0], 4 + len(knots)
        parts = {i: (local_basis(bounds[i], bounds[i + 1], knots), *sums) for i, sums in held.items()}
        outer, cross, n = np.zeros((size, size)), np.zeros(size), 0
        for basis, count, _, u, v in parts.values():
            outer, cross, n = outer + basis.T @ u[np.add.outer(range(4), range(4))] @ basis, cross + basis.T @ v, n + count

        def residuals(made: np.ndarray, parts=parts) -> dict[int, float]:
            local = {i: (basis @ made, square, u, v) for i, (basis, _, square, u, v) in parts.items()}
            return {i: square - 2 * c @ v + c @ u[np.add.outer(range(4), range(4))] @ c for i, (c, square, u, v) in local.items()}

        made = np.linalg.lstsq(outer, cross, rcond=1e-13)[0]
        left = residuals(made)
        wide = [i for i in sorted(left, key=left.get, reverse=True) if left[i] > 0 and parts[i][1] >= 2 * fewest][: min(max(1, len(knots)), most_knots - len(knots))]
        if sum(left.values()) <= n or not wide:
            break
        knots = np.sort(np.concatenate([knots, [(bounds[i] + bounds[i + 1]) / 2 for i in wide]]))
    if len(knots) and sum(left.values()) < n:
        jumps = np.diag(np.r_[np.zeros(4), np.ones(len(knots))])
        low, high = -40.0, 40.0
        for _ in range(80):
            middle = (low + high) / 2
            made = np.linalg.lstsq(outer + np.exp(middle) * jumps, cross, rcond=1e-13)[0]
            low, high = (middle, high) if sum(residuals(made).values()) < n else (low, middle)
    return knots, made


def second_knee(ranks: DataFrame, first: int) -> DataFrame:
    """(rank) of the point farthest from the chord of the bent segment of the curve (rank, log_total) up to the first knee; no row with fewer than four ranks.

    The segment lies around the rank where the smoothing spline's second derivative is least, between the nearest ranks on either
    side where it isn't negative; it is the whole curve if there are none, or if the derivative has one sign over the middle four fifths. All ranks
    are used: the derivative is linear between knots, and so are the ranks of its sign and its least value found without laying them out.
    """
    points = ranks.where(F.col("rank") <= first).select("rank", "log_total")
    if first < 4:
        return points.select("rank").limit(0)
    knots, made = smoothing_spline(points, "rank", "log_total", first)

    def bend(rank: np.ndarray) -> np.ndarray:
        t = (rank - 1) / max(1, first - 1)
        return 2 * made[2] + 6 * made[3] * t + sum((6 * c * np.maximum(t - k, 0) for c, k in zip(made[4:], knots)), np.zeros_like(t))

    # between these ranks the derivative is linear: knots, ends and zeros, each with its neighbours
    marks = np.array([1.0, first, *(1 + k * (first - 1) for k in knots)])
    order = np.sort(marks)
    values = bend(order)
    zeros = [a + (b - a) * va / (va - vb) for a, b, va, vb in zip(order, order[1:], values, values[1:]) if va * vb < 0]
    tenth = max(1, round(first * 0.1))
    middle = (tenth + 1, first - tenth) if first > 2 * tenth else (1, first)
    near = np.unique(np.clip([np.floor(m) + d for m in [*marks, *zeros, *middle] for d in (-1, 0, 1, 2)], 1, first))
    at = bend(near)
    inner = at[(near >= middle[0]) & (near <= middle[1])]
    low, high = 1, first
    if (inner < 0).any() and (inner > 0).any():
        least = int(near[at.argmin()])
        before, after = near[(at >= 0) & (near <= least)], near[(at >= 0) & (near >= least)]
        if len(before) and len(after) and before[-1] < after[0]:
            low, high = int(before[-1]), int(after[0])
    segment = points.where(F.col("rank").between(low, high))
    ends = segment.agg(F.min_by("log_total", "rank").alias("y0"), F.max_by("log_total", "rank").alias("y1"))
    away = F.round(F.abs((F.col("y1") - F.col("y0")) * (F.col("rank") - low) - (high - low) * (F.col("log_total") - F.col("y0"))), 6)
    return segment.crossJoin(F.broadcast(ends)).agg(F.max_by("rank", F.struct(away, -F.col("rank"))).alias("rank")).where("rank is not null")


def reducer(vectors: DataFrame, k: int):
    """A function from (id, features) to (id, pc): the first k principal components of vectors, scaled by population deviations.

    The covariance is gathered as sums of outer products, a row of width squared numbers for each partition.
    """
    width = vectors.agg(F.max(F.size("features")).alias("n")).first().n or 0

    def sums(batches):
        total, outer, n = np.zeros(width), np.zeros((width, width)), 0
        for p in batches:
            if len(p):
                x = np.stack(p["features"].to_numpy())
                total, outer, n = total + x.sum(axis=0), outer + x.T @ x, n + len(x)
        yield pd.DataFrame({"n": [n], "total": [total.tolist()], "outer": [outer.ravel().tolist()]})

    rows = vectors.select("features").mapInPandas(sums, "n long, total array<double>, outer array<double>").where("n > 0").collect()
    n = sum(r.n for r in rows)
    mean = np.sum([r.total for r in rows], axis=0) / n if n else np.zeros(width)
    cov = np.sum([r.outer for r in rows], axis=0).reshape(width, width) / n - np.outer(mean, mean) if n else np.eye(width)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    _, vec = np.linalg.eigh(cov / np.outer(scale, scale))
    axes = vec[:, ::-1][:, :k]
    if width:
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])

    def place(batches):
        for p in batches:
            if len(p):
                x = (np.stack(p["features"].to_numpy()) - mean) / scale
                yield pd.DataFrame({"id": p["id"], "pc": [np.round(r, 6).tolist() for r in x @ axes]})

    return lambda df: df.select("id", "features").mapInPandas(place, "id long, pc array<double>")


def principal_components(vectors: DataFrame, k: int = 2) -> DataFrame:
    """(id, pc array) of (id, features array), without rows for an empty table."""
    return reducer(vectors, k)(vectors)


def components_by_batch(vectors: DataFrame, k: int = 10) -> DataFrame:
    """(batch, id, pc array) of (batch, id, features array): principal components of each batch by itself, scaled by its own deviations.

    All batches take one pass for the sums, which tasks make for the batches they see and Spark adds up, and one for the result. The driver
    gets k axes of a batch, the batches are those of a sample sheet; each batch's eigenvectors are worked out in a task. A batch without rows has none.
    """
    width = vectors.agg(F.max(F.size("features")).alias("n")).first().n or 0
    keyed = vectors.select("batch", F.col("batch").cast("string").alias("key"), "id", "features")

    def sums(batches):
        held: dict = {}
        for p in batches:
            x = np.stack(p["features"].to_numpy()) if len(p) else np.empty((0, width))
            for key in set(p["key"]):
                own = x[[value == key for value in p["key"]]]
                flat = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                held[key] = held.get(key, 0) + flat
        for key, flat in held.items():
            yield pd.DataFrame({"key": [key] * len(flat), "at": np.arange(len(flat)), "value": flat})

    def axes(p: pd.DataFrame) -> pd.DataFrame:
        flat = p.sort_values("at")["value"].to_numpy()
        mean = flat[1 : 1 + width] / flat[0]
        cov = flat[1 + width :].reshape(width, width) / flat[0] - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        vec = np.linalg.eigh(cov / np.outer(scale, scale))[1][:, ::-1][:, :k]
        vec = vec * np.sign(vec[np.abs(vec).argmax(axis=0), np.arange(vec.shape[1])])
        return pd.DataFrame({"key": [p["key"].iloc[0]], "mean": [mean.tolist()], "scale": [scale.tolist()], "axes": [vec.ravel().tolist()]})

    added = keyed.select("key", "features").mapInPandas(sums, "key string, at long, value double").groupBy("key", "at").agg(F.sum("value").alias("value"))
    found = added.groupBy("key").applyInPandas(axes, "key string, mean array<double>, scale array<double>, axes array<double>").collect()
    of = {r.key: (np.array(r["mean"]), np.array(r["scale"]), np.array(r["axes"]).reshape(width, -1)) for r in found}

    def place(batches):
        for p in batches:
            for key in set(p["key"]):
                own = p[[value == key for value in p["key"]]]
                mean, scale, vec = of[key]
                x = (np.stack(own["features"].to_numpy()) - mean) / scale
                yield pd.DataFrame({"batch": own["batch"], "id": own["id"], "pc": [np.round(r, 6).tolist() for r in x @ vec]})

    kind = vectors.schema["batch"].dataType.simpleString()
    return keyed.mapInPandas(place, f"batch {kind}, id long, pc array<double>")


def paired(vectors: DataFrame, ratio: int = 2, seed: int = 42) -> DataFrame:
    """Simulated doublets (id, features) of (id, features array): each cell's mean with each of the `ratio` cells that follow it in the order of a hash of the id."""
    hashed = written(vectors.select("id", "features", F.xxhash64("id", F.lit(seed)).alias("h")), "hashed")
    order = written(ranked(hashed.select("id", "h"), "h", ["id"], "place"), "order")
    n = order.count()
    placed = hashed.join(order, ["id", "h"]).select("place", "features")
    wanted = placed.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(ratio)))).select("place", "features", ((F.col("place") - 1 + F.col("step")) % max(1, n) + 1).alias("other"), "step")
    both = wanted.join(placed.select(F.col("place").alias("other"), F.col("features").alias("more")), "other")
    return both.select((F.col("place") * ratio + F.col("step")).alias("id"), F.zip_with("features", "more", lambda a, b: (a + b) / 2).alias("features"))


def doublet_scores(vectors: DataFrame, k: int = 15, ratio: int = 2, components: int = 8, leaf: int = 2000, margin: float = 0.1, seed: int = 42, simulated: bool = False) -> DataFrame:
    """(id, score) of (id, features array): the share of simulated doublets among each cell's k nearest neighbours, as a likelihood of being one.

    Simulated doublets are made of all cells, `ratio` for each; both kinds are reduced to principal components. Points are
    dealt to leaves of about `leaf` points by quantiles of one component after the other; a point whose component is within `margin` (in shares of
    its rank) of a bound is a neighbour to the leaf beyond it too. So neighbours are searched among all points near a cell; tests measure the recall. Points
    that can't be told apart by their components are parted by a hash. No cells give no rows. With `simulated` the simulated ones are scored too: (id, kind, score), kind 1.
    """
    n = vectors.count()
    if not n:
        return vectors.select("id", *([F.lit(0).alias("kind")] if simulated else []), F.lit(0.0).alias("score"))
    reduced = reducer(vectors, components)
    own = reduced(vectors.select("id", "features")).withColumn("kind", F.lit(0))
    made = reduced(paired(vectors, ratio, seed)).withColumn("kind", F.lit(1))
    points = written(own.unionByName(made).withColumn("leaf", F.lit(0).cast("long")).withColumn("home", F.lit(True)), "points")
    for level in range(max(0, math.ceil(math.log2(max(1, n * (1 + ratio) / leaf))))):
        value = F.col("pc")[level % components] + F.xxhash64("id", "kind", F.lit(level)) / 2.0**64 * 1e-9
        valued = points.withColumn("value", value)
        cuts = valued.where("home").groupBy("leaf").agg(F.percentile_approx("value", [0.5 - margin, 0.5, 0.5 + margin], 10_000).alias("c"))
        sides = F.array(
            F.when(F.col("value") <= F.col("c")[2], F.struct(F.lit(0).alias("side"), (F.col("home") & (F.col("value") <= F.col("c")[1])).alias("home"))),
            F.when(F.col("value") >= F.col("c")[0], F.struct(F.lit(1).alias("side"), (F.col("home") & (F.col("value") > F.col("c")[1])).alias("home"))),
        )
        split = valued.join(cuts, "leaf").select("id", "kind", "pc", "leaf", F.explode(F.array_compact(sides)).alias("to"))
        points = written(split.select("id", "kind", "pc", (F.col("leaf") * 2 + F.col("to.side")).alias("leaf"), F.col("to.home").alias("home")), "points")

    def score(p: pd.DataFrame) -> pd.DataFrame:
        x, kind = np.stack(p["pc"].to_numpy()), p["kind"].to_numpy(float)
        asked = np.flatnonzero(p["home"].to_numpy(bool) & (simulated | (kind == 0)))
        out = np.zeros(len(asked))
        size = min(k, len(x) - 1)
        for lo in range(0, len(asked), 512):
            rows = asked[lo : lo + 512]
            away = (x[rows] ** 2).sum(axis=1)[:, None] - 2 * x[rows] @ x.T + (x**2).sum(axis=1)[None, :]
            away[np.arange(len(rows)), rows] = np.inf
            near = np.argpartition(away, max(0, size - 1), axis=1)[:, :size] if size else np.empty((len(rows), 0), int)
            out[lo : lo + 512] = (kind[near].sum(axis=1) + 1) / (size + 2)
        # the share of simulated ones among neighbours, against their share among all points
        odds = out / (1 - out) / ratio
        return pd.DataFrame({"id": p["id"].to_numpy()[asked], "kind": kind[asked].astype(int), "score": np.round(odds / (1 + odds), 6)})

    scored = points.groupBy("leaf").applyInPandas(score, "id long, kind int, score double")
    return scored if simulated else scored.drop("kind")


def valley(counts: np.ndarray, rounds: int = 10_000) -> int | None:
    """The lowest place between the two peaks that a histogram has left after as many smoothings (means of three) as it takes; None if it never has two."""
    h = np.asarray(counts, float)
    for _ in range(rounds):
        steps = np.sign(np.diff(h))
        rising, peaks = True, []
        for i, step in enumerate([*steps, -1.0]):
            if step < 0 and rising:
                peaks.append(i)
            if step:
                rising = step > 0
        if len(peaks) == 2:
            low, high = peaks
            return low + int(np.argmin(h[low : high + 1]))
        if len(peaks) < 2:
            return None
        wide = np.concatenate([h[:1], h, h[-1:]])
        h = (wide[:-2] + wide[1:-1] + wide[2:]) / 3
    return None


def doublet_threshold(scores: DataFrame, otherwise: float = 0.5, bins: int = 256) -> float:
    """The score in the valley between the two peaks of (score): meant for simulated doublets, of which those of like cells score low and those of unlike cells high.

    Spark counts the scores in `bins` equal ranges between the least and the greatest. Scores without two peaks, and none at all, give `otherwise`.
    """
    ends = scores.agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    if ends.lo is None or ends.lo == ends.hi:
        return otherwise
    width = (ends.hi - ends.lo) / bins
    place = F.least(F.floor((F.col("score") - ends.lo) / width), F.lit(bins - 1)).alias("place")
    counts = np.zeros(bins)
    for r in scores.where("score is not null").groupBy(place).agg(F.count("*").alias("n")).collect():  # at most `bins` rows
        counts[r.place] = r.n
    found = valley(counts)
    return otherwise if found is None else ends.lo + (found + 0.5) * width


def doublet_calls(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """scores with is_doublet: a score above the threshold, that of a cell whose neighbours are as likely simulated as not."""
    return scores.withColumn("is_doublet", F.col("score") > threshold)


def called_doublets(vectors: DataFrame, **settings) -> DataFrame:
    """(id, score, threshold, is_doublet) of each cell, the threshold taken from the scores of the simulated doublets; settings are those of doublet_scores()."""
    scored = written(doublet_scores(vectors, simulated=True, **settings), "doublet-scores")
    threshold = doublet_threshold(scored.where("kind = 1").select("score"))
    return doublet_calls(scored.where("kind = 0").select("id", "score", F.round(F.lit(threshold), 6).alias("threshold")), threshold)
