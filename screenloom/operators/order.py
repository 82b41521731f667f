"""Global order without a single task: running aggregates over value buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import bisect
from ..plans.store import written

ROWS, MOST = 200_000, 1024  # rows that a bucket is meant to have, and the most buckets
SHARES = [i / MOST for i in range(1, MOST)]
TIE_SHARES = [i / 64 for i in range(1, 64)]


def dealt(df: DataFrame, key: str, ties: list[str], descending: bool = False, rows: int = ROWS) -> DataFrame:
    """df with _bucket: buckets of about `rows` rows (at most MOST buckets) that follow each other in the order of key, then ties.

    Bounds are quantiles of key. A value that takes several of them has as many buckets of its own, cut by quantiles of the first tie if that
    is a number; so equal keys are spread too.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    tie = ties[0] if ties and dict(df.dtypes)[ties[0]] in numeric else None
    asked = [F.count("*").alias("n"), F.percentile_approx(key, SHARES, 20_000).alias("key")]
    found = df.agg(*asked, *([F.percentile_approx(tie, TIE_SHARES, 10_000).alias("tie")] if tie else [])).first()
    wanted = min(MOST, max(8, found.n // rows))
    cuts = [found.key[i * MOST // wanted - 1] for i in range(1, wanted)] if found.key else []
    value, bounds = F.col(key), F.lit(cuts) if cuts else F.expr("cast(array() as array<double>)")
    low = bisect(bounds, value)
    own = F.greatest(F.lit(1), bisect(bounds, value, right=True) - low)
    place = F.floor(bisect(F.lit(found.tie), F.col(tie)) * own / len(TIE_SHARES + [1])).cast("int") if tie and found.tie else F.lit(0)
    first = F.lit(len(cuts)) - (low + own - 1) if descending else low
    return df.withColumn("_bucket", first + place)


def running(df: DataFrame, key: str, ties: list[str], aggregates: dict[str, tuple[str, Column]], descending: bool = False, rows: int = ROWS) -> DataFrame:
    """df with running sum, min or max columns over the order of key, then ties.

    Rows are dealt to buckets, each is ordered alone, and what earlier buckets add up to (one row a bucket) is joined to it. Key must not be
    null. df is read for its quantiles, its buckets' totals and the result: hand in a written table if it is dear.
    """
    parts = dealt(df, key, ties, descending, rows)
    order = W.partitionBy("_bucket").orderBy(F.desc(key) if descending else F.asc(key), *ties).rowsBetween(W.unboundedPreceding, 0)
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    call = {"sum": F.sum, "min": F.min, "max": F.max}
    join = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + b, "min": F.least, "max": F.greatest}
    totals = parts.groupBy("_bucket").agg(*[call[kind](expr).alias(f"_{n}") for n, (kind, expr) in aggregates.items()])
    earlier = totals.select("_bucket", *[call[kind](f"_{n}").over(before).alias(f"_{n}") for n, (kind, _) in aggregates.items()])
    inside = parts.select("*", *[call[kind](expr).over(order).alias(n) for n, (kind, expr) in aggregates.items()])
    joined = inside.join(F.broadcast(earlier), "_bucket")  # at most MOST rows
    return joined.select(*df.columns, *[join[kind](F.col(f"_{n}"), F.col(n)).alias(n) for n, (kind, _) in aggregates.items()])


def ranked(df: DataFrame, key: str, ties: list[str], name: str = "rank", descending: bool = False) -> DataFrame:
    """df with its row number over the order of key, then ties.

    Rows are dealt to ranges of the order and sorted there; a number is the place within the range and the rows of those before it. The sorted
    rows are written once. Of df only what follows its last shuffle is worked out twice, for the ranges' bounds.
    """
    several = [F.desc(key) if descending else F.asc(key), *ties]
    laid = written(df.repartitionByRange(*several).sortWithinPartitions(*several).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    # the id has the range in its upper 31 bits and the place within it in the lower 33
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row a range
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = laid.withColumn("_part", part).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return placed.select(*df.columns, (F.col("_before") + within + 1).cast("long").alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order; null keys are a key.

    Spark keeps the first row of each key in every task before the shuffle (WindowGroupLimit), so a hot key sends a row a task.
    """
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once; null keys are a key.

    Keys are counted first and rows then joined to them, which AQE may split: no window has to hold all rows of a frequent key. df is read twice.
    """
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    return df.join(many, reduce(lambda x, y: x & y, [df[k].eqNullSafe(many[f"_{k}"]) for k in keys]), "left_semi")


def unique_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """name made unique by -1, -2 and so on after the first of each, in the order of a number that must not be null; null names stay null.

    Rows are numbered within a name and a range of the order, after those that the name has in earlier ranges, so a frequent name is spread
    over ranges. df is read three times: hand in a written table if it is dear.
    """
    parts = dealt(df, order, [])
    counts = parts.groupBy(F.col(name).alias("_name"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy("_name").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # at most MOST rows a name
    starts = counts.select("_name", "_b", before.alias("_before"))
    inside = parts.withColumn("_n", F.row_number().over(W.partitionBy(name, "_bucket").orderBy(order)) - 1)
    placed = inside.join(starts, (F.col("_bucket") == F.col("_b")) & F.col(name).eqNullSafe(F.col("_name")))
    n = F.col("_n") + F.col("_before")
    unique = F.when(n == 0, F.col(name)).when(F.col(name).isNotNull(), F.concat_ws("-", F.col(name), n.cast("string")))
    return placed.select(*df.columns, unique.alias("unique_name"))
