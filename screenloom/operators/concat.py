"""Tables of several batches or runs as one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_batches(frames: list[DataFrame], key: str = "cell") -> DataFrame:
    """stacked() with _0, _1 and so on after each key, by the frame it comes from: barcodes that batches share are told apart."""
    return stacked([df.withColumn(key, F.concat_ws("_", F.col(key).cast("string"), F.lit(str(i)))) for i, df in enumerate(frames)])


def first_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """stacked() with one row of each key: that of the first frame which has it."""
    numbered = stacked([df.withColumn("_frame", F.lit(i)) for i, df in enumerate(frames)])
    rest = [c for c in numbered.columns if c not in (*keys, "_frame")]
    kept = numbered.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_frame").alias("_row"))
    return kept.select(*keys, "_row.*")


def shared_columns(frames: list[DataFrame]) -> list[str]:
    """Names of the columns that all frames have, sorted."""
    return sorted(set.intersection(*[set(df.columns) for df in frames]))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def renamed(df: DataFrame, names: dict[str, str], other: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """df with columns renamed, and without those, but keys, that `other` has as well."""
    out = df.withColumnsRenamed(names)
    return out.drop(*[c for c in (other.columns if other is not None else []) if c not in keys])
