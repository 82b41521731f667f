"""Incoming batches of counts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def distinct_molecules(spark: SparkSession, path: str, schema: str, late: str = "1 hour") -> DataFrame:
    """A stream of (ts, cell, feature, umi) files without molecules already seen within `late`."""
    return spark.readStream.schema(schema).parquet(path).withWatermark("ts", late).dropDuplicatesWithinWatermark(["cell", "feature", "umi"])


def windowed_totals(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "feature").agg(F.count("*").alias("n"))


def append_counts(stream: DataFrame, out: str, checkpoint: str):
    """Write what has arrived to Parquet and stop; a restart goes on where this ended."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
