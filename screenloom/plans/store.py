"""Intermediate results that are used more than once, as written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a temporary folder if the session is one process, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="screenloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """df worked out once: written as Parquet to the shared folder and read back, so that plans that use it twice read it, and lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt(df: DataFrame, key: str, parts: int = 0) -> DataFrame:
    """df dealt by key: to `parts` partitions where that is more than spark.sql.shuffle.partitions, else to as many as Spark takes."""
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key) if parts > few else df.repartition(key)


def dropped(df: DataFrame) -> None:
    """Removes a table that written() made and nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for file in df.inputFiles()[:1]:
        folder = path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
