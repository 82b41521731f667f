"""Summaries and evaluation tables of test results (guide_id, gene, log2_fc, p_value, q_value)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.checks import CheckError
from ..plans.store import written

BROADCAST_ROWS = 2_000_000  # of laid out links that a join may broadcast


def per_guide(results: DataFrame, hit: Column) -> DataFrame:
    """Tests of each guide, and how many of them are hits: q_value < alpha, or p_value up to rejection_cut() where no q is needed."""
    tested = results.dropna(subset=["log2_fc", "p_value"])
    return tested.groupBy("guide_id").agg(
        F.count("*").alias("n_tests"),
        F.count_if(hit).alias("n_sig"),
        F.count_if(hit & (F.col("log2_fc") > 0)).alias("n_up"),
        F.count_if(hit & (F.col("log2_fc") < 0)).alias("n_down"),
        F.round(F.median("log2_fc"), 7).alias("median_fc"),
        F.max(F.abs("log2_fc")).alias("max_abs_fc"),
        F.round(F.count_if(hit) / F.count("*"), 6).alias("frac_sig"),
    )


def overall(per: DataFrame, guides: DataFrame) -> DataFrame:
    known = per.join(guides.select("guide_id", "control"), "guide_id")
    return known.groupBy("control").agg(F.count("*").alias("guides"), F.sum("n_tests").alias("tests"), F.sum("n_sig").alias("sig"), F.round(F.median("n_sig"), 6).alias("median_sig"), F.round(F.avg("n_sig"), 6).alias("mean_sig"))


def intended(results: DataFrame, guides: DataFrame) -> DataFrame:
    """Each targeting guide with the result of its own target gene, null where it has none. Guides are broadcast, so other results go no further."""
    own = guides.where("not control").select("guide_id", "target", "target_gene")
    named = F.broadcast(own.select("guide_id", F.col("target_gene").alias("gene")))
    kept = results.select("guide_id", "gene", "log2_fc", "p_value").join(named, ["guide_id", "gene"], "left_semi")
    return own.join(kept, (own["guide_id"] == kept["guide_id"]) & (own["target_gene"] == kept["gene"]), "left").select(own["guide_id"], "target", "log2_fc", "p_value")


def knockdown(rows: DataFrame, share: float = 0.4, alpha: float = 0.05) -> DataFrame:
    known = rows.dropna(subset=["log2_fc", "p_value"])
    strong = F.col("log2_fc") <= math.log2(share)
    return known.agg(
        F.count("*").alias("guides"), F.count_if(F.col("p_value") < alpha).alias("sig"), F.count_if(strong).alias("strong"),
        F.count_if(strong & (F.col("p_value") < alpha)).alias("strong_sig"), F.round(F.median("log2_fc"), 7).alias("median_fc"),
    )


def labelled(results: DataFrame, guides: DataFrame) -> DataFrame:
    """Scores 1 - p: positives are guides on their own target, negatives controls on the same genes."""
    known = results.where("p_value is not null").join(guides.select("guide_id", "control", "target_gene"), "guide_id")
    genes = guides.where("not control").select(F.col("target_gene").alias("gene")).distinct()
    positive = known.where("not control and gene = target_gene").select("guide_id", "gene", F.round(1 - F.col("p_value"), 6).alias("score"), F.lit(1).alias("label"))
    negative = known.where("control").join(genes, "gene", "left_semi").select("guide_id", "gene", F.round(1 - F.col("p_value"), 6).alias("score"), F.lit(0).alias("label"))
    return positive.unionByName(negative)


def require_controls(table: DataFrame) -> DataFrame:
    """table (label 0 or 1) if it has positives and at least as many negatives, else an error: a balanced evaluation draws as many negatives as there are positives."""
    found = table.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")).first()
    if not found.positives:
        raise CheckError("no result is a positive")
    if found.negatives < found.positives:
        raise CheckError(f"{found.negatives} negatives for {found.positives} positives")
    return table


def linked(results: DataFrame, guides: DataFrame, links: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Scores 1 - p: positives are results on a validated link (target, gene), negatives controls on the genes of the positives.

    Links are first laid to the guides of their targets. Up to `most` such rows are broadcast, so that results stay where they are; more are joined by a shuffle.
    """
    known = results.where("p_value is not null").join(F.broadcast(guides.select("guide_id", "control", "target")), "guide_id")
    wanted = written(links.join(guides.select("guide_id", "target"), "target").select("guide_id", "target", "gene").distinct(), "links")
    few = wanted.count() <= most
    score = F.round(1 - F.col("p_value"), 6).alias("score")
    positive = known.join(F.broadcast(wanted) if few else wanted, ["guide_id", "target", "gene"], "left_semi").select("guide_id", "gene", score, F.lit(1).alias("label"))
    genes = positive.select("gene").distinct()
    negative = known.where("control").join(F.broadcast(genes) if few else genes, "gene", "left_semi").select("guide_id", "gene", score, F.lit(0).alias("label"))
    return positive.unionByName(negative)


def volcano(results: DataFrame, fc: float = 1.0, alpha: float = 0.05) -> DataFrame:
    """Class of each result: up, down or none."""
    kind = F.when((F.col("log2_fc") >= fc) & (F.col("p_value") <= alpha), "up").when((F.col("log2_fc") <= -fc) & (F.col("p_value") <= alpha), "down").otherwise("none")
    return results.select("guide_id", "gene", kind.alias("class"))


def volcano_labels(results: DataFrame, n: int = 10) -> DataFrame:
    """The n lowest fold changes and the n lowest p-values among down-regulated results."""
    down = results.where("log2_fc < 0 and p_value is not null")
    first = down.orderBy("log2_fc", "guide_id", "gene").limit(n).select("guide_id", "gene", F.lit("fold").alias("by"))
    return first.unionByName(down.orderBy("p_value", "guide_id", "gene").limit(n).select("guide_id", "gene", F.lit("p").alias("by")))


def degrees(edges: DataFrame) -> DataFrame:
    """Weighted degree of every node of edges (src, dst, w): in plus out."""
    ends = edges.select(F.col("src").alias("node"), "w").unionByName(edges.select(F.col("dst").alias("node"), "w"))
    return ends.groupBy("node").agg(F.round(F.sum("w"), 6).alias("degree"), F.count("*").alias("edges"))
