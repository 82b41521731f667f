"""Cell and gene quality control on long-form counts (cell, gene, n)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.store import written
from .order import ranked
from .quantiles import exact_quantiles


def cell_metrics(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """Totals, detected genes and mitochondrial share of each cell."""
    mt = F.sum(F.when(F.col("mt"), F.col("n")).otherwise(0))
    facts = counts.join(genes.select("gene", "mt"), "gene").groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("detected"), mt.alias("mt_total"))
    return facts.select("cell", "total", "detected", F.round(100.0 * F.col("mt_total") / F.col("total"), 6).alias("percent_mt"), F.round(F.log1p("total"), 6).alias("log_total"))


def gene_detection(counts: DataFrame) -> DataFrame:
    return counts.groupBy("gene").agg(F.count("*").alias("cells"), F.sum("n").alias("total"))


def mito_filter(metrics: DataFrame, below: float) -> DataFrame:
    return metrics.where(F.col("percent_mt") < below)


def fraction_filter(counts: DataFrame, fraction: float) -> DataFrame:
    """Genes detected in strictly more than floor(cells * fraction) cells."""
    cells = counts.agg(F.countDistinct("cell").alias("cells_all"))  # one row
    return gene_detection(counts).crossJoin(F.broadcast(cells)).where(F.col("cells") > F.floor(F.col("cells_all") * fraction)).drop("cells_all")


def summaries(cells: DataFrame, columns: list[str], by: str = "batch") -> DataFrame:
    """Median, mean, deviation, extremes and quartiles of each column, for every batch and for all.

    Quantiles are exact and found by counting ranges, so no task holds the values of a batch, or of all cells. cells is worked out once.
    """
    cells = written(cells.select(by, *columns), "cells")

    def four(c: str):
        yield F.round(F.avg(c), 6).alias(f"{c}_mean")
        yield F.round(F.stddev_samp(c), 6).alias(f"{c}_std")
        yield F.min(c).alias(f"{c}_min")
        yield F.max(c).alias(f"{c}_max")

    # grouping_id tells the row of all cells from that of cells without a batch
    whole = F.grouping_id().cast("int")
    grouped = cells.groupingSets([[by], []], by).agg(F.count("*").alias("n_cells"), *[m for c in columns for m in four(c)], whole.alias("_all"))
    both = cells.select(by, *columns, F.lit(0).alias("_all")).unionByName(cells.select(F.lit(None).cast(dict(cells.dtypes)[by]).alias(by), *columns, F.lit(1).alias("_all")))
    names = {0.5: "median", 0.25: "q25", 0.75: "q75"}
    found = exact_quantiles(both, [by, "_all"], columns, list(names))
    wide = found.groupBy(by, "_all").agg(*[F.round(F.max(F.when((F.col("column") == c) & (F.col("share") == s), F.col("value"))), 6).alias(f"{c}_{n}") for c in columns for s, n in names.items()])
    wide = wide.withColumnsRenamed({by: "_by", "_all": "_whole"})
    joined = grouped.join(wide, grouped[by].eqNullSafe(wide["_by"]) & (F.col("_all") == F.col("_whole")), "left")
    order = [f"{c}_{n}" for c in columns for n in ("median", "mean", "std", "min", "max", "q25", "q75")]
    return joined.select(F.coalesce(grouped[by], F.lit("all")).alias(by), "n_cells", *order)


def ladder(cells: DataFrame, column: str, steps: list[int]) -> DataFrame:
    """How many cells exceed each threshold, in one pass."""
    counted = cells.agg(*[F.count_if(F.col(column) > s).alias(f"s{s}") for s in steps])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(s).alias("threshold"), F.col(f"s{s}").alias("cells")) for s in steps])).alias("x")).select("x.*")


def barcode_rank(metrics: DataFrame) -> DataFrame:
    """Cells by falling total with their rank and log1p of the total; metrics are worked out once."""
    return ranked(written(metrics.select("cell", "total"), "totals"), "total", ["cell"], descending=True).select("cell", "total", "rank", F.round(F.log1p("total"), 6).alias("log_total"))


def knee(ranks: DataFrame) -> DataFrame:
    """The rank farthest from the chord between the first and the last rank, and its total."""
    ends = ranks.agg(*[f(c, "rank").alias(f"{c}_{n}") for c in ("rank", "log_total") for n, f in (("lo", F.min_by), ("hi", F.max_by))])
    dx, dy = F.col("rank_hi") - F.col("rank_lo"), F.col("log_total_hi") - F.col("log_total_lo")
    far = F.round(F.abs(dy * (F.col("rank") - F.col("rank_lo")) - dx * (F.col("log_total") - F.col("log_total_lo"))) / F.sqrt(dx * dx + dy * dy), 6)
    placed = ranks.crossJoin(F.broadcast(ends)).select("rank", "total", far.alias("distance"))
    return placed.agg(F.max_by(F.struct("rank", "total", "distance"), F.struct("distance", -F.col("rank"))).alias("k")).select("k.*")


def knee_filter(metrics: DataFrame) -> DataFrame:
    point = knee(barcode_rank(metrics)).select(F.col("total").alias("least"))
    return metrics.crossJoin(F.broadcast(point)).where(F.col("total") >= F.col("least")).drop("least")


def moi(cells: DataFrame, assigned: DataFrame, limit: float = 1.5) -> DataFrame:
    """Mean guides a cell, cells without guides included, and whether it is high."""
    per = assigned.groupBy("cell").agg(F.count("*").alias("guides"))
    mean = cells.join(per, "cell", "left").agg(F.avg(F.coalesce("guides", F.lit(0))).alias("m"))
    return mean.select(F.round("m", 6).alias("mean_guides"), F.when(F.col("m") > limit, "high").otherwise("low").alias("moi"))


def guide_metrics(cells: DataFrame, guide_counts: DataFrame) -> DataFrame:
    per = guide_counts.groupBy("cell").agg(F.count("*").alias("guides"), F.sum("n").alias("guide_umis"))
    return cells.join(per, "cell", "left").fillna(0, ["guides", "guide_umis"]).select("cell", "guides", "guide_umis")


def funnel(cells: DataFrame, metrics: DataFrame, assigned: DataFrame, below: float) -> DataFrame:
    """Cells that each step keeps and how many it removes."""
    kept = mito_filter(metrics, below)
    both = kept.join(assigned.select("cell").distinct(), "cell", "left_semi")
    steps = [cells.select("cell"), metrics.select("cell"), kept.select("cell"), both.select("cell")]
    rows = None
    for i, (name, df) in enumerate(zip(("all", "counted", "mito", "guides"), steps)):
        one = df.agg(F.count("*").alias("cells")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "cells")
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("removed", F.coalesce(F.lag("cells").over(W.orderBy("step")) - F.col("cells"), F.lit(0)))  # four rows


def centred_log_ratio(counts: DataFrame, features: int) -> DataFrame:
    """log1p(x / exp(mean over all features of log1p)) of each cell's counts."""
    mean = F.sum(F.log1p("n")).over(W.partitionBy("cell")) / features
    return counts.select("cell", "feature", F.round(F.log1p(F.col("n") / F.exp(mean)), 6).alias("clr"))
