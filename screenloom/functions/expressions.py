"""Scalar expressions of the screen analysis; all are built-in column functions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of true in each dialect, control types and the control label.
TRUE_WORDS = {"metadata": ("true", "1", "t", "yes"), "results": ("true", "1", "t", "yes", "y"), "strict": ("true",), "flags": ("true", "1")}
CONTROL_TYPES = ("safe-targeting", "non-targeting", "negative control")
CONTROL = "non-targeting"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once a row however often `then` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def bisect(values: Column, x: Column, right: bool = False) -> Column:
    """How many elements of an ascending array are below x (or not above it: right), found by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(values) + 1)).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        at = F.get(values, mid)
        below = (s["lo"] < s["hi"]) & ((at <= x) if right else (at < x))
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi")), step, lambda s: s["lo"])


def is_true(value: Column, dialect: str = "metadata", missing: bool = True) -> Column:
    """Text or boolean to boolean; null gives `missing`."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isNull(), F.lit(missing)).otherwise(text.isin(*TRUE_WORDS[dialect]))


def is_control(targeting: Column, kind: Column, name: Column) -> Column:
    """A guide that targets nothing: by flag, by type or by the name of its target."""
    named = (name == CONTROL) | name.startswith(f"{CONTROL}|")
    return ~F.coalesce(targeting, F.lit(True)) | F.coalesce(F.lower(kind).isin(*CONTROL_TYPES), F.lit(False)) | F.coalesce(named, F.lit(False))


def whole(value: Column) -> Column:
    """Text of a number to a long, cut towards zero; null where it is none."""
    number = value.cast("string").try_cast("double")
    return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("long")


def target_key(name: Column, chrom: Column, start: Column, end: Column) -> Column:
    coords = F.concat_ws("::", F.lit("coords"), name, chrom, whole(start).cast("string"), whole(end).cast("string"))
    missing = chrom.isNull() | whole(start).isNull() | whole(end).isNull()
    return F.when(missing, F.concat(F.lit("name_only::"), name)).otherwise(coords)


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGTacgt", "TGCAtgca"))


def upstream(read: Column, guide: Column, size: int = 12) -> Column:
    """The `size` letters before the first occurrence of guide, filled up with '-' on the left."""
    at = F.call_function("instr", read, guide)
    before = F.substring(read, F.greatest(F.lit(1), at - size), F.least(at - 1, F.lit(size)))
    return F.when(at > 0, F.lpad(before, size, "-"))


def human(value: Column) -> Column:
    """Three significant digits, halves to even, with K, M, B or T, and without zeros at the end."""
    exact, rounded = value.cast("decimal(38,12)"), None
    for power in range(-6, 16):
        one = F.bround(exact, 2 - power).cast("decimal(38,12)")
        rounded = one if rounded is None else F.when(F.abs(exact) >= F.lit(10.0**power).cast("decimal(38,12)"), one).otherwise(rounded)

    def named(r: Column) -> Column:
        chosen = None
        for power, unit in ((0, ""), (3, "K"), (6, "M"), (9, "B"), (12, "T")):
            scaled = (r / F.lit(10**power).cast("decimal(13,0)")).cast("decimal(38,6)").cast("string")
            text = F.concat(F.regexp_replace(scaled, r"\.?0+$", ""), F.lit(unit))
            chosen = text if chosen is None else F.when(F.abs(r) >= F.lit(10**power), text).otherwise(chosen)
        return F.when(r == 0, F.lit("0")).otherwise(chosen)

    return let(rounded, named)


def thousands(value: Column, decimals: int = 0) -> Column:
    """A number with commas between thousands."""
    return F.format_number(value, decimals)


def percent(share: Column, decimals: int = 1) -> Column:
    """A share as percent, halves to even."""
    return F.concat(F.format_string(f"%.{decimals}f", F.bround(share * 100.0, decimals)), F.lit("%"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series at x + 8; error below 1e-12 of its value or of 1."""
    y = x + 8.0
    shift = F.log(x)
    for i in range(1, 8):
        shift = shift + F.log(x + float(i))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - shift


def two_sided_p(z: Column) -> Column:
    """2 (1 - Phi(|z|)) by the rational approximation of erfc, error below 3e-7."""

    def tail(x: Column) -> Column:
        return let(1 / (1 + 0.3275911 * x), lambda t: t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x))

    return let(F.abs(z) / math.sqrt(2), tail)
