"""Guide metadata: targets, control buckets, assignment and collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import CONTROL
from ..plans.checks import CheckError
from .order import ranked

MOST_ENTRIES = 2**31 - 1  # cells x genes that are worked on without chunks


def guides_per_target(guides: DataFrame) -> DataFrame:
    """Median number of guides of a target, cut to a whole number, at least one."""
    per = guides.where("not control").groupBy("target").agg(F.count("*").alias("n"))
    return per.agg(F.greatest(F.lit(1), F.floor(F.median("n"))).cast("long").alias("size"))


def control_buckets(guides: DataFrame) -> DataFrame:
    """Controls in the order of guide_id, dealt to groups as large as a target; the group names the target and its place."""
    size = guides_per_target(guides)
    numbered = ranked(guides.where("control").select("guide_id"), "guide_id", [], "row").crossJoin(F.broadcast(size))
    group = (F.floor((F.col("row") - 1) / F.col("size")) + 1).cast("long")
    named = numbered.select("guide_id", group.alias("group"))
    return named.select("guide_id", F.concat(F.lit(f"{CONTROL}|"), F.col("group").cast("string")).alias("target"), F.lit(CONTROL).alias("chr"), F.col("group").alias("start"), F.col("group").alias("end"))


def collapse(assigned: DataFrame, guides: DataFrame, least: int = 2, most: int = 2) -> DataFrame:
    """Cells with `least` to `most` guides, all of one target: their guides as one joined id."""
    per = assigned.join(guides.select(F.col("guide_id").alias("guide"), "target"), "guide")
    grouped = per.groupBy("cell").agg(F.count("*").alias("guides"), F.count_distinct("target").alias("targets"), F.min("target").alias("target"), F.array_join(F.array_sort(F.collect_list("guide")), "|").alias("collapsed"))
    return grouped.where((F.col("targets") == 1) & F.col("guides").between(least, most)).select("cell", "target", "collapsed")


def assignment_counts(guides: DataFrame, assigned: DataFrame) -> DataFrame:
    per = assigned.groupBy(F.col("guide").alias("guide_id")).agg(F.count("*").alias("cells"))
    return guides.select("guide_id").join(per, "guide_id", "left").fillna(0, ["cells"])


def controls_only(assigned: DataFrame, guides: DataFrame) -> DataFrame:
    """Cells with a control guide and no targeting one."""
    kind = assigned.join(guides.select(F.col("guide_id").alias("guide"), "control"), "guide")
    return kind.where("control").select("cell").distinct().join(kind.where("not control").select("cell"), "cell", "left_anti")


def expression_by_guide(counts: DataFrame, assigned: DataFrame, guides: DataFrame, guide: int, gene: int) -> DataFrame:
    """A gene's counts in the cells of one guide and in control cells, zeros included."""
    own = assigned.where(F.col("guide") == guide).select("cell", F.lit("perturbed").alias("label"))
    other = controls_only(assigned, guides).select("cell", F.lit("control").alias("label"))
    values = counts.where(F.col("gene") == gene).select("cell", "n")
    return own.unionByName(other).join(values, "cell", "left").select("cell", "label", F.coalesce("n", F.lit(0)).alias("n"))


def chunks(genes: DataFrame, size: int) -> DataFrame:
    """Genes in the order of id, dealt to chunks of a fixed size."""
    numbered = ranked(genes.select("gene"), "gene", [], "row")
    return numbered.groupBy(F.floor((F.col("row") - 1) / size).cast("long").alias("chunk")).agg(F.min("row").alias("first"), F.max("row").alias("last"), F.count("*").alias("genes"))


def planned_chunks(genes: DataFrame, cells: int, size: int, mode: str = "auto", most: int = MOST_ENTRIES) -> DataFrame:
    """(mode, chunk, first, last, genes): chunks() if the matrix is to be cut, else all genes as one.

    auto cuts a matrix of more than `most` entries (cells x genes), force always, off never; no more genes than `size` are one chunk in any mode.
    Another mode, or a size below 1, is an error. No genes give no rows.
    """
    if mode not in ("auto", "off", "force") or size < 1:
        raise CheckError(f"mode {mode!r} is none of auto, off and force, or size {size} is below 1")
    n = genes.count()
    cut = n > size and (mode == "force" or mode == "auto" and cells * n > most)
    return chunks(genes, size if cut else max(1, n)).select(F.lit(mode).alias("mode"), "chunk", "first", "last", "genes")


def balanced_chunks(genes: DataFrame, size: int) -> DataFrame:
    """As few chunks as `size` allows, whose sizes differ by one at most; the first ones take what is left over."""
    n = genes.count()
    number = max(1, -(-n // size)) if size > 0 else 1
    base, more = divmod(n, number)
    numbered = ranked(genes.select("gene"), "gene", [], "row").withColumn("row", F.col("row") - 1)
    cut = more * (base + 1)
    chunk = F.when(F.col("row") < cut, F.floor(F.col("row") / (base + 1))).otherwise(more + F.floor((F.col("row") - cut) / max(1, base)))
    return numbered.groupBy(chunk.cast("long").alias("chunk")).agg(F.min("row").alias("start"), (F.max("row") + 1).alias("stop"))


def chunk_guides(pairs: DataFrame, genes: DataFrame, guides: DataFrame, size: int) -> DataFrame:
    """(chunk, guide_id): the guides that chunks of `size` genes test, and controls in every chunk."""
    numbered = ranked(genes.select("gene"), "gene", [], "row").select("gene", F.floor((F.col("row") - 1) / size).cast("long").alias("chunk"))
    controls = guides.where("control").select("guide_id").distinct()
    every = numbered.select("chunk").distinct().crossJoin(F.broadcast(controls))  # a row for each chunk and control, each once
    others = pairs.join(numbered, "gene").select("chunk", "guide_id").distinct()
    tested = others.join(F.broadcast(controls.withColumnRenamed("guide_id", "_control")), F.col("guide_id").eqNullSafe(F.col("_control")), "left_anti")
    return tested.unionByName(every)
