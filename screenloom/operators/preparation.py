"""What precedes the tests: flags, filters, batch codes, covariates, controls and sample routing."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import CONTROL
from .guides import guides_per_target
from .order import ranked

#: Prefixes of mitochondrial and ribosomal gene symbols, modality names of sample sheets, and chromosomes with enrichment windows.
MITOCHONDRIAL, RIBOSOMAL = "MT-", "^(RPS|RPL)"
MODALITIES = {"scRNA sequencing": "scRNA", "gRNA sequencing": "gRNA", "cell hashing barcode sequencing": "hash"}
CHROMOSOMES = [f"chr{c}" for c in (*range(1, 23), "X", "Y")]


def gene_flags(genes: DataFrame) -> DataFrame:
    """genes (gene, symbol, ...) with mt and ribo by the prefix of the symbol."""
    return genes.withColumn("mt", F.coalesce(F.col("symbol").startswith(MITOCHONDRIAL), F.lit(False))).withColumn("ribo", F.coalesce(F.col("symbol").rlike(RIBOSOMAL), F.lit(False)))


def cell_shares(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """(cell, total, detected, log_total, log_detected, percent_mt, percent_ribo) of each cell; genes have mt and ribo."""

    def share(flag: str) -> Column:
        return F.round(100.0 * F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias(f"percent_{flag}")

    facts = counts.join(genes.select("gene", "mt", "ribo"), "gene").groupBy("cell")
    return facts.agg(F.sum("n").alias("total"), F.count("*").alias("detected"), F.round(F.log1p(F.sum("n")), 6).alias("log_total"), F.round(F.log1p(F.count("*")), 6).alias("log_detected"), share("mt"), share("ribo"))


def gene_dropout(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """(gene, cells, total, mean, pct_dropout): pct_dropout is the share of all cells without a count, in percent."""
    every = cells.agg(F.count("*").alias("all_cells"))
    per = counts.groupBy("gene").agg(F.count("*").alias("cells"), F.sum("n").alias("total")).crossJoin(F.broadcast(every))
    return per.select("gene", "cells", "total", F.round(F.col("total") / F.col("all_cells"), 6).alias("mean"), F.round(100.0 * (1 - F.col("cells") / F.col("all_cells")), 6).alias("pct_dropout"))


def cells_with_genes(counts: DataFrame, least: int) -> DataFrame:
    """counts of cells with `least` or more detected genes."""
    kept = counts.groupBy("cell").agg(F.count("*").alias("k")).where(F.col("k") >= least).select("cell")
    return counts.join(kept, "cell", "left_semi")


def genes_in_cells(counts: DataFrame, least: int = 10) -> DataFrame:
    """counts of genes detected in `least` or more cells."""
    kept = counts.groupBy("gene").agg(F.count("*").alias("k")).where(F.col("k") >= least).select("gene")
    return counts.join(kept, "gene", "left_semi")


def batch_codes(cells: DataFrame, order: str) -> DataFrame:
    """cells with batch_number, from 1 in the order in which batches first appear by the column `order`."""
    first = cells.groupBy("batch").agg(F.min(order).alias("_first"))
    return cells.join(ranked(first, "_first", ["batch"], "batch_number").drop("_first"), "batch")


def centred(cells: DataFrame, column: str, name: str) -> DataFrame:
    """cells with log1p of a column less its mean over all cells."""
    mean = cells.agg(F.avg(F.log1p(column)).alias("_mean"))
    return cells.crossJoin(F.broadcast(mean)).withColumn(name, F.round(F.log1p(column) - F.col("_mean"), 6)).drop("_mean")


def covariate_table(spark: SparkSession, text: str) -> DataFrame:
    """A table from a JSON object of column name to list of values, such as batch and cov1; values become text."""
    columns = json.loads(text)
    rows = [[None if v is None else str(v) for v in row] for row in zip(*columns.values(), strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def with_covariates(cells: DataFrame, covariates: DataFrame) -> DataFrame:
    """cells with the covariates of their batch; batches without any keep nulls."""
    return cells.join(covariates, "batch", "left")


def varying(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that have more than one value, a null counting as one."""
    row = df.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns]).first()
    return [c for c in columns if (row[c] or 0) > 1]


def formula(df: DataFrame, columns: list[str]) -> str:
    """The columns that vary, joined as a formula."""
    return " + ".join(varying(df, columns))


def independent(df: DataFrame, columns: list[str]) -> list[str]:
    """Covariates to fit: those that vary, taken in turn as long as the model matrix keeps its full rank.

    Text covariates stand for their levels, a null being a level of its own; null numbers are taken as the median. The products of all columns of the model matrix are
    summed by Spark over the table's distinct rows, so the driver holds a square of levels.
    """
    kinds = dict(df.dtypes)
    chosen: list[str] = []
    for c in varying(df, columns):
        design: list[Column] = [F.lit(1.0)]
        for x in (*chosen, c):
            if kinds[x] == "string":
                levels = sorted((r[0] for r in df.select(F.coalesce(x, F.lit("(none)"))).distinct().collect()))
                design += [(F.coalesce(x, F.lit("(none)")) == level).cast("double") for level in levels[1:]]
            else:
                middle = df.agg(F.median(x)).first()[0] or 0.0
                design.append(F.coalesce(F.col(x).cast("double"), F.lit(float(middle))))
        named = df.select(*[d.alias(f"d{i}") for i, d in enumerate(design)])
        pairs = [(i, j) for i in range(len(design)) for j in range(i, len(design))]
        sums = named.agg(*[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()
        square = np.zeros((len(design), len(design)))
        for i, j in pairs:
            square[i, j] = square[j, i] = sums[f"p{i}_{j}"] or 0.0
        scale = np.sqrt(np.maximum(np.diag(square), 1e-300))
        if np.linalg.matrix_rank(square / np.outer(scale, scale), tol=1e-9) == len(design):
            chosen.append(c)
    return chosen


def dropped_without(guides: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """guides without rows that lack one of the columns, and how many went."""
    kept = guides.dropna(subset=list(columns))
    return kept, guides.count() - kept.count()


def control_by_contains(targeting: Column, kind: Column, name: Column) -> Column:
    """The wider control mask: not targeting, of type non-targeting, or a target whose name contains it, in any case."""
    return ~F.coalesce(targeting, F.lit(True)) | F.coalesce(F.lower(kind) == CONTROL, F.lit(False)) | F.coalesce(F.lower(name).contains(CONTROL), F.lit(False))


def filled_type(kind: Column, targeting: Column) -> Column:
    return F.coalesce(kind, F.when(F.coalesce(targeting, F.lit(False)), F.lit("targeting")).otherwise(F.lit(CONTROL)))


def element_sizes(guides: DataFrame) -> DataFrame:
    """(size, elements): how many targets have each number of guides."""
    per = guides.where("not control").groupBy("target").agg(F.count("*").alias("size"))
    return per.groupBy("size").agg(F.count("*").alias("elements"))


def control_elements(guides: DataFrame, strategy: str = "median") -> DataFrame:
    """guides (guide_id, target, control) with element: targets as they are; controls all as one (`same`), or in the order of guide_id in groups of the median size."""
    if strategy not in ("median", "same"):
        raise ValueError(f"strategy {strategy!r} is neither 'median' nor 'same'")
    if strategy == "same":
        return guides.select("guide_id", F.when(F.col("control"), F.lit(CONTROL)).otherwise(F.col("target")).alias("element"))
    size = guides_per_target(guides)
    numbered = ranked(guides.where("control").select("guide_id"), "guide_id", [], "row").crossJoin(F.broadcast(size))
    group = (F.floor((F.col("row") - 1) / F.col("size")) + 1).cast("string")
    named = numbered.select("guide_id", F.concat(F.lit(f"{CONTROL}|"), group).alias("element"))
    return guides.where("not control").select("guide_id", F.col("target").alias("element")).unionByName(named)


def routed(sheet: DataFrame, modality: str) -> DataFrame:
    """Rows of a sample sheet of one modality, in any case."""
    return sheet.where(F.lower("file_modality") == modality.lower())


def first_values(sheet: DataFrame, columns: list[str]) -> DataFrame:
    """(modality, column, value): the least value of each metadata column of each modality."""
    per = sheet.groupBy(F.lower("file_modality").alias("modality")).agg(*[F.min(c).alias(c) for c in columns])
    return per.unpivot(["modality"], columns, "column", "value")


def recoded(sheet: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen columns of a sheet, with the short names of modalities."""
    return sheet.select(*columns).replace(MODALITIES, subset=["file_modality"])


def split_by_batch(df: DataFrame, path: str) -> None:
    """df as one folder of Parquet a batch, with _ for blanks in their names."""
    df.withColumn("batch", F.translate("batch", " ", "_")).write.partitionBy("batch").parquet(path)


def subsampled(reads: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Reads whose hash, the first 15 hexadecimal digits of an MD5, falls below the fraction: the same ones in every run and partitioning."""
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("read_id").cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    return reads.where(hashed < int(fraction * 16**15))
