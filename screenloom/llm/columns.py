"""Column helpers for array work inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that part words, besides the blank.
BREAKS = "\t\n\x0b\x0c\r"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once a row however often `then` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words(text: Column) -> Column:
    """Maximal runs of characters other than blank and \\x09-\\x0D; null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), BREAKS, " " * len(BREAKS)), " "), "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def before(values: Column, whole: Callable[[Column], Column], joined: Callable[[Column, Column], Column], block: int = 64) -> Column:
    """For each element of an integer array what `whole` makes of those before it (0 of none).

    Takes whole blocks first, then the blocks before a block and the elements before one in it: `joined` puts two such values together.
    """

    def with_blocks(v: Column) -> Column:
        n = F.size(v)
        starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
        return let(
            F.transform(starts, lambda j: whole(F.slice(v, j * block + 1, F.lit(block)))),
            lambda sums: let(
                F.transform(sums, lambda _, j: whole(F.slice(sums, F.lit(1), j))),
                lambda base: F.transform(v, lambda _, i: joined(F.get(base, F.floor(i / block).cast("int")), whole(F.slice(v, F.floor(i / block).cast("int") * block + 1, i % block)))),
            ),
        )

    return let(values, with_blocks)


def sums_before(values: Column) -> Column:
    """For each element of an integer array the sum of those before it."""
    return before(values, total, lambda a, b: a + b)


def most_before(values: Column) -> Column:
    """For each element of an array of integers from 0 the largest of those before it, 0 for the first."""
    return before(values, lambda v: F.coalesce(F.array_max(v), F.lit(0)), F.greatest)


def first_not_below(values: Column, x: Column) -> Column:
    """Index from 0 of the first element >= x of an ascending array (its size if there is none), by bisection."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(values) + 1)).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & (F.get(values, mid) < x)
        return F.struct(
            F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"),
        )

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi")), step, lambda s: s["lo"])
