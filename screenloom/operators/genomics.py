"""Windows, enrichment and tracks over genome coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairs import overlapping


def tss_windows(genes: DataFrame, width: int) -> DataFrame:
    """Windows around each gene's mean start; genes on several chromosomes are left out."""
    per = genes.groupBy("gene").agg(F.count_distinct("chr").alias("n"), F.min("chr").alias("chr"), F.bround(F.avg("pos")).cast("long").alias("tss"))
    return per.where("n = 1").select(F.col("gene").alias("id"), "chr", F.greatest(F.lit(0), F.col("tss") - width).alias("start"), (F.col("tss") + width).alias("stop"))


def enrichment(results: DataFrame, targets: DataFrame, alpha: float) -> DataFrame:
    """For each factor (results: factor, gene, p_value): tests, rejections, targets, their overlap and recall.

    A gene's factors go to its results as one list, so results that are dealt by gene stay where they are.
    """
    lists = targets.where("factor is not null").groupBy("gene").agg(F.collect_set("factor").alias("_factors"))
    joined = results.join(lists, "gene", "left")
    hit, bound = F.col("p_value") <= alpha, F.coalesce(F.array_contains("_factors", F.col("factor")), F.lit(False))
    made = joined.groupBy("factor").agg(F.count("*").alias("tests"), F.count_if(hit).alias("rejections"), F.count_if(bound).alias("targets"), F.count_if(hit & bound).alias("overlap"))
    return made.withColumn("recall", F.round(F.col("overlap") / F.nullif("targets", F.lit(0)), 6))


def bound_genes(genes: DataFrame, peaks: DataFrame, width: int) -> DataFrame:
    met = overlapping(tss_windows(genes, width), peaks, 4 * width)
    return met.select(F.col("b_id").alias("peak"), F.col("a_id").alias("gene")).distinct()


def strong_peaks(peaks: DataFrame, share: float) -> DataFrame:
    """Peaks (factor, score, ...) that reach the quantile `share` of their factor's scores."""
    cuts = peaks.groupBy("factor").agg(F.percentile("score", share).alias("_cut"))
    return peaks.join(cuts, "factor").where(F.col("score") >= F.col("_cut")).drop("_cut")


def enrichment_by_window(results: DataFrame, genes: DataFrame, peaks: DataFrame, widths: list[int], alpha: float) -> DataFrame:
    """enrichment() of each width of the windows around gene starts: (width, factor, tests, rejections, targets, overlap).

    Peaks meet the widest windows once; which narrower ones they reach follows from the distance. peaks have a factor. A gene's factors go to its
    results as one list with the narrowest window of each, so results aren't laid out over widths, and stay where they are if they are dealt by gene.
    """
    widest = max(widths)
    starts = tss_windows(genes, widest).select("id", "chr", "start", "stop", (F.col("stop") - widest).alias("tss"))
    met = overlapping(starts, peaks, 4 * widest).select(F.col("a_id").alias("gene"), F.col("b_id").alias("peak"))
    sides = met.join(starts.select(F.col("id").alias("gene"), "tss"), "gene").join(peaks.select(F.col("id").alias("peak"), "factor", F.col("start").alias("p0"), F.col("stop").alias("p1")), "peak")
    reach = [F.when((F.greatest(F.lit(0), F.col("tss") - w) < F.col("p1")) & (F.col("p0") < F.col("tss") + w), F.lit(w)) for w in sorted(widths)]
    bound = sides.select("factor", "gene", F.coalesce(*reach).alias("width")).where("factor is not null and width is not null").groupBy("gene", "factor").agg(F.min("width").alias("width"))
    lists = bound.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("factor", "width"))).alias("_widths"))
    joined = results.join(lists, "gene", "left").withColumn("_width", F.try_element_at("_widths", F.col("factor")))
    hit = F.col("p_value") <= alpha
    counts = [F.struct(F.lit(w).alias("width"), F.count_if(F.col("_width") <= w).alias("targets"), F.count_if(hit & (F.col("_width") <= w)).alias("overlap")) for w in widths]
    per = joined.groupBy("factor").agg(F.count("*").alias("tests"), F.count_if(hit).alias("rejections"), F.array(*counts).alias("_each"))
    return per.select("factor", "tests", "rejections", F.explode("_each").alias("_one")).select("_one.width", "factor", "tests", "rejections", "_one.targets", "_one.overlap")


def tracks(results: DataFrame, guides: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """BEDPE rows (guide to another gene) and bedgraph rows (guide on its own target) of results with coordinates."""
    at = guides.select("guide_id", F.col("chr").alias("chr1"), F.col("pos").alias("start1"), "target_gene")
    to = genes.select("gene", F.col("chr").alias("chr2"), F.col("pos").alias("start2"))
    known = results.dropna(subset=["log2_fc", "p_value"]).join(at, "guide_id").join(to, "gene")
    own = F.col("gene") == F.col("target_gene")
    pe = known.where(~own).select("chr1", "start1", (F.col("start1") + 1).alias("end1"), "chr2", "start2", (F.col("start2") + 1).alias("end2"), F.col("log2_fc").alias("score"))
    graph = known.where(own).select(F.col("chr1").alias("chr"), F.col("start1").alias("start"), (F.col("start1") + 1).alias("end"), F.col("log2_fc").alias("score"))
    return pe, graph
