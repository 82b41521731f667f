"""Checks that raise before a plan goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame


class CheckError(ValueError):
    pass


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise CheckError(f"columns are missing: {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    if found := df.groupBy(*keys).count().where("count > 1").limit(10).collect():
        raise CheckError(f"{', '.join(keys)} repeat, such as {[r.asDict() for r in found]}")
    return df


def require_filled(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        if not df.where(df[n].isNull()).isEmpty():
            raise CheckError(f"{n} has nulls")
    return df


def require_matched(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    if found := left.join(right, list(keys), "left_anti").select(*keys).limit(10).collect():
        raise CheckError(f"no match for {[tuple(r) for r in found]}")
    return left
