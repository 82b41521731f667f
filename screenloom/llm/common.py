"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one number that a join may broadcast: some 48 MB as a hash table.
BROADCAST_KEYS = 2_000_000
#: Folders of the tables that this process wrote and did not drop, oldest first.
WRITTEN: list[str] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where none is set, a session in one process (tests) takes a temporary one; a cluster's raises, since its executors
    would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="screenloom-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def table(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives executors.

    The shuffle files behind it go as soon as it is written. parts: the most tasks that write, where the number of rows is known to be small.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        (df.coalesce(parts) if parts else df).write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    WRITTEN.append(path)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table that table() wrote and nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        WRITTEN[:] = [path for path in WRITTEN if path.rsplit("/", 1)[1] != folder.getName()]


def drop_written(spark: SparkSession, since: int, but: DataFrame) -> None:
    """Remove the tables written after the first `since`, all but the table `but`: what a finished stage read on the way to its result."""
    kept = {file.rsplit("/", 2)[1] for file in but.inputFiles()}
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in WRITTEN[since:]:
        if path.rsplit("/", 1)[1] not in kept:
            folder = files.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
            WRITTEN.remove(path)


def arrow_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Bound what one Arrow batch holds, so that very long texts don't add up in a Python worker.

    Lowers the session's settings where they are higher and leaves lower ones.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        now = re.sub(r"(?i)b$", "", spark.conf.get(f"spark.sql.execution.arrow.{name}"))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def release() -> None:
    """Give a task's freed memory back to the system: a Python worker lives on, and the next stage's needs come on top."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """df with its place from 0 in the given order. df must be a written table, whose files give the same rows in the same order again.

    Rows are dealt to ranges of the order, and by their place in df where they are alike in it, so no task gets a hot key whole. Each range is
    written in order; a place is the number of rows in earlier ranges and the place in the own one. Rows that are alike in the order take places in no set order.
    """
    tie, place = free_name(df, "tie"), free_name(df, "place")
    several = [*order, F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*several).sortWithinPartitions(*several).drop(tie)
    laid = table(dealt.withColumn(place, F.monotonically_increasing_id()), "numbered")
    # the id has the range in its upper 31 bits and the place within it in the lower 33
    part, within = F.shiftright(place, 33), F.col(place).bitwiseAND((1 << 33) - 1)
    sizes = laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # a row a range
    base, before = {}, 0
    for r in sorted(sizes):
        base[r.part], before = before, before + r.n
    if not base:
        return laid.select(*df.columns, F.lit(0).cast("long").alias(name))
    starts = F.lit([base.get(i, 0) for i in range(max(base) + 1)])
    return laid.select(*df.columns, (F.element_at(starts, part.cast("int") + 1) + within).cast("long").alias(name))


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores so that no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_keys(df: DataFrame, key: Column, keys: DataFrame, how: str = "left_semi", most: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of df whose key, a long, is in keys (left_semi) or isn't (left_anti); keys is a written table of one column of longs.

    Up to `most` keys are counted and broadcast, so that df stays where it is; more are joined by a shuffle of df.
    """
    name = free_name(df, "key")
    few = keys.count() <= most
    wanted = keys.select(F.col(keys.columns[0]).alias(name))
    return df.withColumn(name, key).join(F.broadcast(wanted) if few else wanted.hint("merge"), name, how).select(*df.columns)
