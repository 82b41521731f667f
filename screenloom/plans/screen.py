"""A whole screen: quality control, pairs, effects, adjustment and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import effects, evaluation, pairs, qc, statistics
from . import checks, store


@dataclass(frozen=True)
class Screen:
    """Long-form tables: counts (cell, gene, n), assigned (cell, guide), cells (cell, batch), genes and guides."""

    counts: DataFrame
    assigned: DataFrame
    cells: DataFrame
    genes: DataFrame
    guides: DataFrame

    def checked(self) -> Screen:
        checks.require_unique(checks.require_filled(checks.require_columns(self.guides, "guide_id", "target", "chr", "pos"), "guide_id"), "guide_id")
        checks.require_columns(self.counts, "cell", "gene", "n")
        return self


def analyse(screen: Screen, mito_below: float = 20.0, limit: int | None = 1_000_000, alpha: float = 0.05) -> dict[str, DataFrame]:
    """cells that pass, results of every pair (near pairs where limit is given), and the summary of each guide."""
    passing = qc.mito_filter(qc.cell_metrics(screen.counts, screen.genes), mito_below).select("cell")
    counts = screen.counts.join(passing, "cell", "left_semi")
    found = effects.effects(counts, screen.assigned.join(passing, "cell", "left_semi"), passing).withColumnRenamed("guide", "guide_id")
    if limit is not None:
        found = found.join(pairs.within_distance(screen.guides, screen.genes, limit).select("guide_id", "gene"), ["guide_id", "gene"], "left_semi")
    results = statistics.bh(store.written(found, "effects"), "p_value")
    return {"cells": passing, "results": results, "per_guide": evaluation.per_guide(results, F.col("q_value") < alpha)}
