"""False discovery rates, curves, enrichment and inequality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import let, log_gamma
from ..plans.store import written
from .order import ranked, running


def bh(results: DataFrame, p: str, name: str = "q_value", by: list[str] | None = None) -> DataFrame:
    """Benjamini-Hochberg adjusted values; rows with a null p keep a null.

    Equal p have one adjusted value, that of the last of them. For the whole table only distinct p with their counts are ordered, over buckets, and then
    joined to the rows; results is then read twice: hand in a written table if it is dear. Rows of a family of `by` are shuffled to one task, which sorts
    them and spills; nothing is joined and results is read once.
    """
    if by:
        up, down = W.partitionBy(*by).orderBy(p), W.partitionBy(*by).orderBy(F.desc(p))  # both take rows of equal p together
        placed = results.select("*", F.count(p).over(up).alias("_upto"), F.count(p).over(W.partitionBy(*by)).alias("_n"))
        low = placed.withColumn("_q", F.col(p) * F.col("_n") / F.nullif(F.col("_upto"), F.lit(0))).withColumn("_low", F.min("_q").over(down))
        return low.select(*results.columns, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.col("_low"))).alias(name))
    steps = written(results.where(F.col(p).isNotNull()).groupBy(p).agg(F.count("*").alias("_c")), "steps")
    total = steps.agg(F.sum("_c").alias("_n"))  # one row
    placed = running(steps, p, [], {"_upto": ("sum", F.col("_c"))}).crossJoin(F.broadcast(total))
    placed = written(placed.select(p, (F.col(p) * F.col("_n") / F.col("_upto")).alias("_q")), "steps")
    low = running(placed, p, [], {"_low": ("min", F.col("_q"))}, descending=True)
    return results.join(low.select(p, F.least(F.lit(1.0), F.col("_low")).alias(name)), p, "left").select(*results.columns, name)


def rejection_cut(results: DataFrame, p: str, alpha: float, bins: int = 512) -> float | None:
    """The largest p whose Benjamini-Hochberg adjusted value is below alpha, None if there is none: p and all smaller ones are rejected.

    That is the largest p with p * n / (number of values up to p) < alpha. Values are counted in `bins` ranges between 0 and alpha, and from the
    highest range on that may hold it, each is counted in finer ones until it is a single value. So nothing is ordered and no row is joined;
    every pass gives the driver at most `bins` rows. results is read for each pass: hand in a written table.
    """
    values = results.where(F.col(p).isNotNull()).select(F.col(p).cast("double").alias("p"))
    n = values.count()

    def search(low: float, high: float, before: int) -> float | None:
        width = (high - low) / bins or 1.0
        place = F.least(F.floor((F.col("p") - low) / width), F.lit(bins - 1))
        rows = sorted(values.where(F.col("p").between(low, high)).groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).collect())
        upto = before + sum(r.n for r in rows)
        for r in reversed(rows):
            if r.lo == r.hi:
                found = r.lo if r.lo * n / upto < alpha else None
            else:  # no value of the range does if even its least would not with all of the range counted
                found = search(r.lo, r.hi, upto - r.n) if r.lo * n / upto < alpha else None
            if found is not None:
                return found
            upto -= r.n
        return None

    return search(0.0, alpha, 0) if n else None


def bonferroni(results: DataFrame, p: str, name: str = "p_bonferroni") -> DataFrame:
    total = results.agg(F.count(p).alias("_n"))
    return results.crossJoin(F.broadcast(total)).withColumn(name, F.least(F.lit(1.0), F.col(p) * F.col("_n"))).drop("_n")


def curve(scored: DataFrame) -> DataFrame:
    """(score, tp, fp) at each distinct score, from the highest; scored has score and label (0 or 1)."""
    return _curve(_steps(scored))


def _steps(scored: DataFrame) -> DataFrame:
    """Labels added up for each distinct score, written once: scored itself is read a single time."""
    return written(scored.groupBy("score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")), "curve")


def _curve(steps: DataFrame) -> DataFrame:
    return running(steps, "score", [], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, descending=True).select("score", "pos", "neg", "tp", "fp")


def areas(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Areas under the ROC and the precision-recall curve by trapezoids over distinct scores."""
    steps = _steps(scored)
    points, ends = _curve(steps), steps.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / F.nullif(tp0 + fp0, F.lit(0)))
    roc = F.sum(F.col("neg") * (F.col("tp") + tp0) / 2.0)
    pr = F.sum(F.col("pos") * (precision + before) / 2.0)
    sums = points.agg(roc.alias("roc"), pr.alias("pr")).crossJoin(ends)
    return sums.select(F.round(F.col("roc") / (F.col("all_pos") * F.col("all_neg")), digits).alias("auroc"), F.round(F.col("pr") / F.col("all_pos"), digits).alias("auprc"), F.col("all_pos").cast("long").alias("positives"), F.col("all_neg").cast("long").alias("negatives"))


def balanced(scored: DataFrame, ties: list[str], seed: int = 42) -> DataFrame:
    """All positives and as many negatives (all of them if there are fewer), those with the smallest hash of their ties.

    A hash is the first 15 hexadecimal digits of an MD5. Negatives are counted by its upper 16 bits, which shows how far the wanted ones reach;
    a little more than those are ordered. scored is worked out once.
    """
    scored = written(scored, "scored")
    positives = scored.where("label = 1")
    text = F.concat_ws(":", *[F.col(t).cast("string") for t in ties], F.lit(str(seed)))
    hashed = scored.where("label = 0").withColumn("_h", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"))
    wanted, cut, held = positives.count(), -1, 0
    for r in sorted(hashed.groupBy(F.shiftright("_h", 44).alias("top")).agg(F.count("*").alias("n")).collect()):  # at most 65536 rows
        if held >= wanted:
            break
        cut, held = r.top, held + r.n
    kept = ranked(hashed.where(F.shiftright("_h", 44) <= cut), "_h", ties, "_rank").where(F.col("_rank") <= wanted)
    return positives.unionByName(kept.drop("_h", "_rank"))


def gini(values: DataFrame, value: str, by: list[str], digits: int = 6) -> DataFrame:
    """Gini coefficient within each group, 0 for a group of zeros; only distinct values with their counts are ordered."""
    steps = values.groupBy(*by, value).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*by).orderBy(value))
    placed = steps.select(*by, value, "_c", upto.alias("_upto"), F.sum("_c").over(W.partitionBy(*by)).alias("_n"))
    # the places of equal values add up to the mean of the first and the last, times their number
    places = F.col("_c") * (2 * F.col("_upto") - F.col("_c") + 1)
    share = F.sum((places - F.col("_c") * (F.col("_n") + 1)) * F.col(value)) / (F.max("_n") * F.nullif(F.sum(F.col("_c") * F.col(value)), F.lit(0)))
    return placed.groupBy(*by).agg(F.round(F.coalesce(share, F.lit(0.0)), digits).alias("gini"))


def fisher_greater(a: Column, b: Column, c: Column, d: Column) -> Column:
    """One-sided Fisher p of [[a, b], [c, d]]; null where a margin is empty.

    The chance of the table as it stands, by log-gamma, and of each more extreme one from that before it.
    """

    def tail(s: Column) -> Column:
        row, col, n = s["a"] + s["b"], s["a"] + s["c"], s["a"] + s["b"] + s["c"] + s["d"]
        logs = sum((log_gamma(x + 1.0) for x in (row, n - row, col, n - col)), F.lit(0.0)) - sum((log_gamma(x + 1.0) for x in (n, s["a"], s["b"], s["c"], s["d"])), F.lit(0.0))
        more = F.least(row, col) - s["a"]
        steps = F.when(more > 0, F.sequence(F.lit(0).cast("long"), more - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))

        def step(t: Column, i: Column) -> Column:
            part = t["part"] * (s["b"] - i) * (s["c"] - i) / ((s["a"] + i + 1) * (s["d"] + i + 1))
            return F.struct(part.alias("part"), (t["sum"] + part).alias("sum"))

        start = let(F.exp(logs), lambda p: F.struct(p.alias("part"), p.alias("sum")))
        p = F.aggregate(steps, start, step, lambda t: F.least(F.lit(1.0), t["sum"]))
        return F.when(F.least(row, col, n - row, n - col) > 0, p)

    return let(F.struct(*[x.cast("long").alias(k) for k, x in zip("abcd", (a, b, c, d))]), tail)


def odds_ratio(a: Column, b: Column, c: Column, d: Column) -> Column:
    """a d / (b c), infinite where b or c is 0; null where a margin is empty."""
    empty = F.least(a + b, c + d, a + c, b + d) == 0
    return F.when(~empty, F.when(b * c == 0, F.lit(float("inf"))).otherwise(a * d / F.nullif((b * c).cast("double"), F.lit(0.0))))
