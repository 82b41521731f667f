"""Exact quantiles of groups of any size, by counting values in ever finer ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.store import written

BINS = 1024
FEW = 100_000  # searches that are broadcast; more are joined by a shuffle over SALTS parts of each group
SALTS = 32


def exact_quantiles(df: DataFrame, by: list[str], columns: list[str], shares: list[float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(by, column, share, value): quantiles of each column in each group, interpolated between neighbouring values as F.percentile does.

    Equal values are added up first. Each wanted rank is then searched in a range of values, at first the whole one of its group: a pass counts the values
    of every range in `bins` parts and goes on in the one that holds the rank, until that part is one value. All groups, columns
    and shares take part in each pass, and a task never holds more than counts of parts, so a group may be the whole table. Null keys
    are a group; null values and NaN are left out, infinite ones count; a group without values has no rows. by may be empty. Shares lie in 0 .. 1.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    named = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])).alias("x")
    # one struct as key: it compares equal where its fields are null
    key = F.struct(F.col("x.c").alias("c"), *[F.col(c).alias(k) for c, k in zip(by, keys)])
    steps = df.select(*by, named).where("x.v is not null and not isnan(x.v)").groupBy(key.alias("key"), (F.col("x.v") + 0.0).alias("v")).agg(F.count("*").alias("n"))
    steps = written(steps.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")), "values")
    ends = steps.groupBy("key").agg(F.sum("n").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    place = (F.col("rows") - 1) * F.col("share")
    wanted = written(ends.select("key", "lo", "hi", "rows", asked).select("*", F.floor(place).alias("low"), F.ceil(place).alias("high"), place.alias("place")), "wanted")
    # ranks from 0; `before` values lie below the range
    open_ = wanted.select("key", F.explode(F.array_distinct(F.array("low", "high"))).alias("rank"), "lo", "hi").distinct().withColumn("before", F.lit(0).cast("long"))
    found, search = open_.where("lo = hi"), written(open_.where("lo < hi"), "ranges")
    tame = lambda c: F.greatest(F.least(c, F.lit(8e307)), F.lit(-8e307))  # noqa: E731 - so that the width of a range is finite
    while left := search.count():
        v, lo, hi = tame(F.col("v")), tame(F.col("lo")), tame(F.col("hi"))
        part = F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.when(F.col("v") > F.col("lo"), bins - 1).otherwise(0)).cast("int")
        if left <= few:
            met = steps.join(F.broadcast(search), "key")
        else:
            met = steps.join(search.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key", "salt"])
        inside = met.where("v between lo and hi")
        # where all but the ends are one part, the highest value alone is the last part
        part = F.when(F.col("v") == F.col("hi"), bins - 1).otherwise(F.least(part, F.lit(bins - 2)))
        counted = inside.groupBy("key", "rank", "before", part.alias("part")).agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(W.partitionBy("key", "rank").orderBy("part")) + F.col("before")  # at most `bins` rows
        placed = counted.withColumn("upto", upto).where("rank < upto and rank >= upto - n")
        now = written(placed.select("key", "rank", "lo", "hi", (F.col("upto") - F.col("n")).alias("before")), "ranges")
        found, search = found.unionByName(now.where("lo = hi")), now.where("lo < hi")
    found = written(found.select("key", "rank", F.col("lo").alias("value")), "ranks")
    low, high = (found.select("key", F.col("rank").alias(n), F.col("value").alias(f"{n}_value")) for n in ("low", "high"))
    both = wanted.join(low, ["key", "low"]).join(high, ["key", "high"])
    near = F.col("low_value") * (F.col("high") - F.col("place")) + F.col("high_value") * (F.col("place") - F.col("low"))
    value = F.when(F.col("low_value") == F.col("high_value"), F.col("low_value")).otherwise(near)
    column = F.lit([str(c) for c in columns])[F.col("key.c")]
    return both.select(*[F.col(f"key.{k}").alias(c) for c, k in zip(by, keys)], column.alias("column"), "share", value.alias("value"))
