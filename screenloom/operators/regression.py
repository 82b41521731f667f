"""Negative-binomial regression of every gene on covariates of cells, and p-values by resampling within strata of those covariates."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.checks import CheckError
from ..plans.store import written

MOST_STRATA = 100_000
RIDGE = 1e-3  # penalty of every coefficient but the intercept, so that a gene without counts in a batch has finite ones
ROUNDS = 100
AT_ONCE = 128  # strata whose draws are made together
PAIRS_AT_ONCE = 256  # whose draws are held together


@dataclass
class Design:
    """Strata of cells with equal covariates: names of the model's columns, their values for each stratum, and how many cells it has."""

    names: list[str]
    x: np.ndarray
    sizes: np.ndarray
    placed: DataFrame  # (cell, stratum)


def design(cells: DataFrame, factors: list[str], numbers: list[str], step: float | None = 1 / 64, most: int = MOST_STRATA) -> Design:
    """Strata of cells (cell, factors, numbers): an intercept, a column for each level of a factor but the first, and the numbers.

    Numbers are rounded to multiples of `step` (None: as they are), so cells share strata and sums over all cells, zeros included, are sums over
    strata. The driver holds the strata; more than `most` of them are an error. A null factor is a level of its own, a null number is 0.
    """
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in factors]
    values = [(F.round(v / step) * step if step else v).alias(c) for c, v in ((c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in numbers)]
    known = cells.select("cell", *keys, *values)
    groups = written(known.groupBy(*factors, *numbers).agg(F.count("*").alias("cells")), "strata")
    n = groups.count()
    if n > most:
        raise CheckError(f"{n} strata of equal covariates, over {most}: take a larger step or fewer covariates")
    rows = sorted(groups.collect())
    levels = {c: sorted({r[c] for r in rows})[1:] for c in factors}
    x = np.array([[1.0, *(float(r[c] == level) for c in factors for level in levels[c]), *(r[c] for c in numbers)] for r in rows]).reshape(len(rows), 1 + sum(map(len, levels.values())) + len(numbers))
    names = ["intercept", *(f"{c}={level}" for c in factors for level in levels[c]), *numbers]
    table = cells.sparkSession.createDataFrame([(*(r[c] for c in [*factors, *numbers]), i) for i, r in enumerate(rows)], ", ".join([*(f"{c} string" for c in factors), *(f"{c} double" for c in numbers), "stratum int"]))
    return Design(names, x, np.array([r.cells for r in rows], float), known.join(F.broadcast(table), [*factors, *numbers]).select("cell", "stratum"))


def fitted(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, their variances, overdispersion, whether converged) of a batch of genes.

    y and q (genes x strata) are the sums of counts and of their squares. Fisher scoring of all genes at once on the means, in turn with the overdispersion
    that makes the squared residuals what they are expected to be (0 at least); genes stop when both stand still.
    """
    genes, width = len(y), x.shape[1]
    beta, spread, done = np.zeros((genes, width)), np.zeros(genes), np.zeros(genes, bool)
    beta[:, 0] = np.log(np.maximum(y.sum(axis=1), 0.5) / sizes.sum())
    pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    ridge = np.full(width, RIDGE)
    ridge[0] = 0
    inverse = np.zeros((genes, width, width))
    at = np.arange(genes)
    mean = np.exp(np.clip(beta @ x.T, -30, 30))
    for _ in range(ROUNDS):
        if not len(at):
            break
        scale = 1 + spread[at, None] * mean
        slope = ((y[at] - sizes * mean) / scale) @ x - ridge * beta[at]
        info = ((sizes * mean / scale) @ pairs).reshape(len(at), width, width) + np.diag(ridge + 1e-9)
        inverse[at] = np.linalg.inv(info)
        move = np.clip(np.einsum("gab,gb->ga", inverse[at], slope), -3, 3)
        beta[at] += move
        mean = np.exp(np.clip(beta[at] @ x.T, -30, 30))
        square = (sizes * mean * mean).sum(axis=1)
        now = np.maximum(((q[at] - 2 * y[at] * mean + sizes * mean * mean).sum(axis=1) - (sizes * mean).sum(axis=1)) / np.maximum(square, 1e-12), 0)
        stands = (np.abs(move).max(axis=1) < 1e-8) & (np.abs(now - spread[at]) < 1e-8 * (1 + now))
        done[at], spread[at] = stands, now
        if stands.any():
            at, mean = at[~stands], mean[~stands]
    return beta, np.einsum("gaa->ga", inverse), spread, done


def in_strata(counts: DataFrame, made: Design) -> DataFrame:
    """counts with their cells' strata; counts that have a column stratum have it already."""
    return counts if "stratum" in counts.columns else counts.join(made.placed, "cell")


def nb_regression(counts: DataFrame, made: Design) -> DataFrame:
    """(gene, beta array, variance array, spread, converged) of every gene with a count: log-linear means and one overdispersion for each gene.

    Spark sums the counts and their squares by gene and stratum once, from non-zero counts; a gene is then a row of at most as many entries as
    there are strata, and every round of its fit runs over the strata in the task that has it.
    """
    x, sizes = made.x, made.sizes
    own = in_strata(counts, made).groupBy("gene", "stratum").agg(F.sum("n").cast("double").alias("y"), F.sum(F.col("n") * F.col("n")).cast("double").alias("q"))
    rows = own.groupBy("gene").agg(F.collect_list(F.struct("stratum", "y", "q")).alias("own"))
    batch = max(1, min(256, 4_000_000 // max(1, len(x))))

    def run(batches):
        for big in batches:
            for lo in range(0, big.num_rows, batch):
                part = big.slice(lo, batch)
                entries, where = part.column(1).flatten(), np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(part.column(1))))
                y, q = np.zeros((part.num_rows, len(x))), np.zeros((part.num_rows, len(x)))
                at = where, np.asarray(entries.field("stratum"))
                y[at], q[at] = np.asarray(entries.field("y")), np.asarray(entries.field("q"))
                beta, variance, spread, done = fitted(x, sizes, y, q)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(beta)), pa.array(list(variance)), pa.array(spread), pa.array(done)], names=["gene", "beta", "variance", "spread", "converged"])

    return rows.select(F.col("gene").cast("long").alias("gene"), "own").mapInArrow(run, "gene long, beta array<double>, variance array<double>, spread double, converged boolean")


def coefficients(fits: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    """(gene, covariate, beta, se, spread, converged): a row for each coefficient."""
    parts = F.explode(F.arrays_zip(F.lit(names).alias("covariate"), F.col("beta"), F.col("variance"))).alias("c")
    return fits.select("gene", parts, "spread", "converged").select(
        "gene", "c.covariate", F.round("c.beta", digits).alias("beta"), F.round(F.sqrt("c.variance"), digits).alias("se"), F.round("spread", digits).alias("spread"), "converged"
    )


def extras(counts: DataFrame, made: Design, fits: DataFrame) -> DataFrame:
    """(cell, gene, stratum, e) and fits' own other columns: what each non-zero count adds to its gene's score, n / (1 + spread * mean of the gene in the stratum)."""
    x = made.placed.sparkSession.createDataFrame([(i, row.tolist()) for i, row in enumerate(made.x)], "stratum int, x array<double>")
    own = [c for c in fits.columns if c not in ("gene", "beta", "variance", "spread", "converged")]
    placed = in_strata(counts, made).join(fits.select("gene", "beta", "spread", *own), "gene").join(F.broadcast(x), "stratum")  # at most MOST_STRATA rows
    mean = F.exp(F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))
    return placed.select("cell", "gene", "stratum", (F.col("n") / (1 + F.col("spread") * mean)).alias("e"), *own)


def normal_upper(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v / math.sqrt(2)) / 2 for v in x])


def skew_upper(z: np.ndarray, skew: np.ndarray) -> np.ndarray:
    """Upper tail at z of the skew-normal distribution with mean 0, deviation 1 and this skewness, by Owen's T."""
    third = np.abs(skew) ** (2 / 3)
    delta = np.sign(skew) * np.sqrt(np.pi / 2 * third / (third + ((4 - np.pi) / 2) ** (2 / 3)))
    delta = np.clip(delta, -0.9999, 0.9999)
    shape = delta / np.sqrt(1 - delta**2)
    width = 1 / np.sqrt(1 - 2 * delta**2 / np.pi)
    h = (z + width * delta * np.sqrt(2 / np.pi)) / width
    # the integrand is smooth in the angle whose tangent is the upper bound
    node, weight = np.polynomial.legendre.leggauss(48)
    angle = np.arctan(shape)
    t = angle[:, None] * (node + 1) / 2
    owen = (np.exp(-(h[:, None] ** 2) / (2 * np.cos(t) ** 2)) * weight).sum(axis=1) * angle / 2 / (2 * np.pi)
    return np.clip(normal_upper(h) + 2 * owen, 0, 1)


def skew_p(z: Column, skew: Column) -> Column:
    """Two-sided p of z: twice the smaller tail."""

    @F.pandas_udf("double")
    def tails(z: pd.Series, skew: pd.Series) -> pd.Series:
        a, g = z.to_numpy(float), skew.to_numpy(float)
        return pd.Series(np.minimum(1, 2 * np.minimum(skew_upper(a, g), skew_upper(-a, -g))))

    return tails(z, skew)


def uniforms(cells: np.ndarray, salt: int | np.ndarray, draws: int) -> np.ndarray:
    """Numbers in 0 .. 1 for each cell and draw, hashed from both and the salt, one for all or of each cell."""
    x = cells.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, draws + 1, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F) + np.asarray(salt, np.uint64).reshape(-1, 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x.astype(np.float64) / 2.0**64


def drawn_sums(stratum: np.ndarray, cell: np.ndarray, e: np.ndarray, m: np.ndarray, sizes: np.ndarray, salt: int, draws: int) -> np.ndarray:
    """`draws` sums of e over m random cells of each stratum with `sizes` cells, those without an entry counting 0."""
    order = np.lexsort((cell, stratum))
    return drawn_together(np.zeros(len(order), int), stratum[order], cell[order], e[order], m[order], sizes[order], np.full(len(order), salt), draws, 1)[0]


def drawn_together(pair: np.ndarray, stratum: np.ndarray, cell: np.ndarray, e: np.ndarray, m: np.ndarray, sizes: np.ndarray, salt: np.ndarray, draws: int, pairs: int) -> np.ndarray:
    """(pairs, draws) sums of drawn_sums() of several pairs, from entries in the order of pair (0 .. pairs - 1), stratum and cell.

    The entries of a stratum are taken one after the other with the chance (cells still to be drawn) / (cells still left), which draws without
    replacement; the first entries of AT_ONCE strata of any pairs are taken together, then their second ones, and so on.
    """
    out = np.zeros((pairs, draws))
    cuts = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(stratum, prepend=-1) != 0))
    longs = np.diff(cuts, append=len(pair))
    for a in range(0, len(cuts), AT_ONCE):
        first, many = cuts[a : a + AT_ONCE], longs[a : a + AT_ONCE]
        order = np.argsort(-many, kind="stable")
        first, many = first[order], many[order]
        wanted, total = np.repeat(m[first].astype(float)[:, None], draws, axis=1), np.zeros((len(first), draws))
        for j in range(many[0]):
            k = int(np.searchsorted(-many, -j))  # strata of more than j entries
            rows = first[:k] + j
            hit = uniforms(cell[rows], salt[rows], draws) * (sizes[rows].astype(float) - j)[:, None] < wanted[:k]
            total[:k] += hit * e[rows][:, None]
            wanted[:k] -= hit
        back = np.empty_like(total)
        back[order] = total
        of = pair[cuts[a : a + AT_ONCE]]
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        out[of[begin]] += np.add.reduceat(back, begin, axis=0)
    return out


def drawn_tails(batches, unit: str, draws: int):
    """Batches (unit, gene, p_value) from rows (unit, gene, score, salt, stratum, cell, e, m, cells) in the order of unit, gene, stratum and cell: the two-sided tail of each pair's score among its draws."""

    def tails(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        column = {c: np.asarray(table.column(c)) for c in ("score", "salt", "stratum", "cell", "e", "m", "cells")}
        pair = np.repeat(np.arange(len(at)), np.diff(at, append=table.num_rows))
        own = column["score"][at]
        got = np.empty(len(at))
        for a in range(0, len(at), PAIRS_AT_ONCE):
            rows = slice(at[a], at[a + PAIRS_AT_ONCE] if a + PAIRS_AT_ONCE < len(at) else table.num_rows)
            score = own[a : a + PAIRS_AT_ONCE, None]
            drawn = drawn_together(pair[rows] - a, *[column[c][rows] for c in ("stratum", "cell", "e", "m", "cells")], column["salt"][rows] & (2**63 - 1), draws, len(score))
            edge = 1e-9 * (1 + np.abs(score))
            upper, lower = (1 + (drawn >= score - edge).sum(axis=1)) / (draws + 1), (1 + (drawn <= score + edge).sum(axis=1)) / (draws + 1)
            got[a : a + PAIRS_AT_ONCE] = np.minimum(1.0, 2 * np.minimum(upper, lower))
        first = table.take(pa.array(at)).combine_chunks()
        return pa.RecordBatch.from_arrays([first.column(unit).combine_chunks(), first.column("gene").combine_chunks(), pa.array(got)], names=[unit, "gene", "p_value"])

    def begins(table: pa.Table) -> np.ndarray:
        new = np.ones(table.num_rows, bool)
        new[1:] = np.diff(np.asarray(table.column("salt"))) != 0
        for c in (unit, "gene"):
            new[1:] |= np.asarray(pc.not_equal(table.column(c).slice(1), table.column(c).slice(0, table.num_rows - 1)))
        return np.flatnonzero(new)

    held = []  # the rows of the last pair, which may go on
    for batch in batches:
        table = pa.Table.from_batches([batch])
        at = begins(pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table]))[1:] - 1 if held else begins(table)[1:]
        if len(at):
            whole = pa.concat_tables([*held, table.slice(0, at[-1])])
            yield tails(whole, begins(whole))
            held, table = [], table.slice(at[-1])
        if table.num_rows:
            held.append(table)
    if held:
        whole = pa.concat_tables(held)
        yield tails(whole, np.zeros(1, int))


def resampled_p(counts: DataFrame, treated: DataFrame, made: Design, fits: DataFrame, pairs: DataFrame, unit: str = "guide", draws: int = 999, limit: float = 0.9, digits: int = 6) -> DataFrame:
    """(unit, gene, score, z, skew, by, p_value) of each pair (unit, gene), against treated cells drawn anew within the strata of covariates.

    The score is the sum of extras() over the unit's treated cells. Under the null as many cells of each stratum are drawn at random; the mean, variance
    and third moment of that sum are exact from each gene's sums over strata, and the p-value is the two-sided tail of the
    skew-normal distribution that has them. Where its skewness would be over `limit` (few counts, or one very large one) no such distribution
    fits well, and the tail is that of `draws` hashed draws. A gene without counts has a null p-value; a unit of all cells too.

    A count meets its cell's units with the list of units that its gene is tested with, and its unit's cells of the stratum once; moments and draws read
    what comes of it. Draws of many pairs are made together, in the order of pairs.
    """
    wanted = pairs.select(unit, "gene").distinct()
    lists = wanted.where(F.col(unit).isNotNull()).groupBy("gene").agg(F.collect_list(unit).alias("_tested"))
    near = extras(counts, made, fits.join(lists, "gene"))
    units = treated.groupBy("cell").agg(F.collect_list(unit).alias("_units"))
    own = near.join(units, "cell", "left").select(F.explode("_tested").alias(unit), "gene", "stratum", "cell", "e", "_units")
    own = own.select(unit, "gene", "stratum", "cell", "e", F.coalesce(F.array_contains("_units", F.col(unit)), F.lit(False)).alias("_treated"))
    sizes = made.placed.sparkSession.createDataFrame([(i, n) for i, n in enumerate(made.sizes.tolist())], "stratum int, cells double")
    held = treated.join(made.placed, "cell").groupBy(unit, "stratum").agg(F.count("*").cast("double").alias("m"))
    entries = written(own.join(held, [unit, "stratum"]).join(F.broadcast(sizes), "stratum"), "entries")
    e = F.col("e")
    laid = entries.repartition(unit, "gene").groupBy(unit, "gene", "stratum").agg(
        F.sum(e).alias("s1"), F.sum(e * e).alias("s2"), F.sum(e * e * e).alias("s3"), F.sum(F.when(F.col("_treated"), e).otherwise(0.0)).alias("own"), F.first("m").alias("m"), F.first("cells").alias("cells")
    )
    n, m, mean = F.col("cells"), F.col("m"), F.col("s1") / F.col("cells")
    second = F.col("s2") / n - mean * mean
    third = F.col("s3") / n - 3 * mean * F.col("s2") / n + 2 * mean * mean * mean
    moments = laid.groupBy(unit, "gene").agg(
        F.sum(m * mean).alias("mean"),
        F.sum(F.when(n > 1, m * (n - m) / (n - 1) * second).otherwise(0)).alias("variance"),
        F.sum(F.when(n > 2, m * (n - m) * (n - 2 * m) / ((n - 1) * (n - 2)) * third).otherwise(0)).alias("third"),
        F.sum("own").alias("score"),
    )
    spread = F.when(F.col("variance") > 1e-12, F.sqrt("variance"))
    known = wanted.join(moments, [unit, "gene"], "left")
    placed = written(known.select(unit, "gene", F.coalesce("score", F.lit(0.0)).alias("score"), ((F.coalesce("score", F.lit(0.0)) - F.col("mean")) / spread).alias("z"), (F.col("third") / (spread * spread * spread)).alias("skew")), "scores")
    smooth = placed.where(F.col("z").isNull() | (F.abs("skew") <= limit)).select("*", F.lit("fit").alias("by"), F.when(F.col("z").isNotNull(), skew_p(F.coalesce("z", F.lit(0.0)), F.coalesce("skew", F.lit(0.0)))).alias("p_value"))
    kind = dict(placed.dtypes)[unit]
    rough = placed.where(F.abs("skew") > limit)
    rows = rough.select(unit, "gene", "score", F.xxhash64(unit, "gene").alias("salt")).join(entries.drop("_treated"), [unit, "gene"])
    rows = rows.select(unit, F.col("gene").cast("long").alias("gene"), "score", "salt", "stratum", F.col("cell").cast("long").alias("cell"), "e", "m", "cells").repartition(unit, "gene").sortWithinPartitions(unit, "gene", "stratum", "cell")
    tails = rows.mapInArrow(lambda batches: drawn_tails(batches, unit, draws), f"{unit} {kind}, gene long, p_value double")
    drawn = rough.select("*", F.lit("draws").alias("by")).join(tails, [unit, "gene"])
    rounded = [F.round(c, digits).alias(c) for c in ("score", "z", "skew")]
    return smooth.unionByName(drawn).select(unit, "gene", *rounded, "by", F.round("p_value", digits + 2).alias("p_value"))


def by_blocks(genes: DataFrame, units: DataFrame, pairs: DataFrame, compute, schema: str, unit: str = "guide", size: int = 512) -> DataFrame:
    """compute(gene entries, unit entries, pairs) for every block of about `size` genes and as many units, over the pairs in it.

    genes (gene, place, numbers) and units (unit, place, numbers) are sparse vectors, a row for each entry; they are sent once to
    every block that may need them, instead of once for every pair; pairs (unit, gene, numbers) are shuffled once.
    compute gets an Arrow table of each kind and gives an Arrow table of `schema`.
    """
    many_genes = -(-max(1, genes.select("gene").distinct().count()) // size)
    many_units = -(-max(1, units.select(unit).distinct().count()) // size)
    i, j = F.pmod(F.xxhash64("gene"), F.lit(many_genes)).cast("int"), F.pmod(F.xxhash64(unit), F.lit(many_units)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tagged = [
        genes.select(i.alias("i"), every(many_units).alias("j"), F.lit(0).alias("kind"), "*"),
        units.select(every(many_genes).alias("i"), j.alias("j"), F.lit(1).alias("kind"), "*"),
        pairs.select(i.alias("i"), j.alias("j"), F.lit(2).alias("kind"), "*"),
    ]
    whole = tagged[0].unionByName(tagged[1], allowMissingColumns=True).unionByName(tagged[2], allowMissingColumns=True)
    kinds = [genes.columns, units.columns, pairs.columns]

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")
        return compute(*[table.filter(pc.equal(kind, k)).select(columns).combine_chunks() for k, columns in enumerate(kinds)])

    return whole.groupBy("i", "j").applyInArrow(run, schema)


def dense(entries: pa.Table, key: str, columns: list[str], width: int) -> tuple[pa.Array, np.ndarray]:
    """The different keys of entries (key, place, columns), and (columns, keys, width) numbers with 0 where there is no entry."""
    column = entries.column(key).combine_chunks()
    ids = column.unique()
    out = np.zeros((len(columns), len(ids), width))
    at = np.asarray(pc.index_in(column, ids)), np.asarray(entries.column("place"))
    for k, name in enumerate(columns):
        out[k][at] = np.asarray(entries.column(name))
    return ids, out
