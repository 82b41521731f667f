"""Files fetched and summed on the executors: streamed piece by piece, verified, and left alone when they are there already."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 8 << 20  # bytes that a task holds of a file
MOST_TASKS = 10_000
FETCHED = "source string, target string, md5 string, size long, status string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path within it; Spark's own listing names local files file:/a b, without escapes."""
    local = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in local else (fs.LocalFileSystem(), local)


def state(path: str) -> tuple[int, int] | None:
    """(size, time of the last change in nanoseconds) of a file, None where there is none."""
    system, inner = opened(path)
    info = system.get_file_info(inner)
    return (info.size, info.mtime_ns or 0) if info.type == fs.FileType.File else None


def digest(path: str, copy: str | None = None) -> str:
    """The MD5 of a file, read once in pieces; with `copy` the pieces are written there on the way."""
    system, inner = opened(path)
    made = hashlib.md5()
    with system.open_input_stream(inner, compression=None) as source:
        if copy is None:
            while piece := source.read(PIECE):
                made.update(piece)
        else:
            to, place = opened(copy)
            with to.open_output_stream(place, compression=None) as out:
                while piece := source.read(PIECE):
                    made.update(piece)
                    out.write(piece)
    return made.hexdigest()


def note_of(path: str) -> str:
    """Where the sum of a file is noted: beside it, with the size and time that it had then."""
    return f"{path}.md5"


def noted(path: str) -> str | None:
    """The sum that was noted for a file, if the file is still as it was."""
    system, place = opened(note_of(path))
    now = state(path)
    if now is None or system.get_file_info(place).type != fs.FileType.File:
        return None
    with system.open_input_stream(place) as f:
        words = f.read().decode().split()
    return words[0] if len(words) == 3 and words[1:] == [str(n) for n in now] else None


def note(path: str, md5: str) -> None:
    system, place = opened(note_of(path))
    size, changed = state(path)
    partial = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as f:
        f.write(f"{md5} {size} {changed}\n".encode())
    system.move(partial, place)


def fetch_one(source: str, target: str, md5: str | None) -> tuple[str | None, int | None, str]:
    """(md5, size, status) after a file has been brought from source to target; see fetched().

    A copy is written under a name of its own and moved when it is whole and right, so a task that is lost or runs twice leaves no half file under the target's name.
    """
    if state(target) is not None:
        if md5 is None:
            return None, state(target)[0], "unverified"
        have = noted(target)
        if have is None:
            have = digest(target)
            note(target, have)
        if have == md5:
            return have, state(target)[0], "kept"
    if state(source) is None:
        return None, None, "missing"
    system, place = opened(target)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    tail = f".{uuid.uuid4().hex}.part"
    try:
        found = digest(source, target + tail)
        if md5 is not None and found != md5:
            return found, state(source)[0], "mismatch"
        system.move(place + tail, place)
    finally:
        if state(target + tail) is not None:
            system.delete_file(place + tail)
    note(target, found)
    return found, state(target)[0], "fetched"


def fetched(files: DataFrame) -> DataFrame:
    """(source, target, md5, size, status) of files (source, target, md5), md5 in hex or null: each target brought up to date by one task, in pieces.

    kept: the target has the sum it should have; its sum is read from the note beside it if its size and time are as noted, so a run that is started
    again goes on where the last one ended. unverified: it exists and no sum is given, it is left as it is. fetched: it was copied from source, in
    place of a file with another sum too. mismatch: the source has another sum than it should; nothing is put in place and an older target stays. missing: there is no source.
    md5 is the sum that was found. A target named twice is brought once for each (source, md5). Rows without source or target are left out.
    """
    asked = files.select("source", "target", F.lower(F.trim("md5")).alias("md5")).where("source is not null and target is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = [(s, t, *fetch_one(s, t, m if isinstance(m, str) and m else None)) for s, t, m in zip(p["source"], p["target"], p["md5"])]
            out = pd.DataFrame(rows, columns=["source", "target", "md5", "size", "status"])
            yield out.astype({"size": "Int64"})

    return asked.repartition(tasks_for(asked.count()), "target").mapInPandas(run, FETCHED)


def tasks_for(files: int) -> int:
    """Twice as many tasks as files, so that few tasks get two; MOST_TASKS at most."""
    return max(1, min(2 * files, MOST_TASKS))


def with_targets(sheet: DataFrame, brought: DataFrame, *columns: str) -> DataFrame:
    """sheet with the paths in `columns` replaced by where they were brought to; paths that weren't brought stay."""
    ready = brought.where(F.col("status").isin("kept", "fetched", "unverified")).groupBy("source").agg(F.min("target").alias("_target"))
    for column in columns:
        moved: Column = F.coalesce("_target", F.col(column))
        sheet = sheet.join(ready.withColumnRenamed("source", column), column, "left").select(*[moved.alias(c) if c == column else F.col(c) for c in sheet.columns])
    return sheet


def streamed_sums(paths: DataFrame) -> DataFrame:
    """(path, md5) of files (path) of any size, each read in pieces by one task; those that are missing have no row."""
    asked = paths.select("path").where("path is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            there = [path for path in p["path"] if state(path) is not None]
            yield pd.DataFrame({"path": there, "md5": [digest(path) for path in there]}, dtype="str")

    return asked.repartition(tasks_for(asked.count()), "path").mapInPandas(run, "path string, md5 string")


def sums_below(spark: SparkSession, paths: str | list[str], whole: int) -> tuple[DataFrame, DataFrame]:
    """Files by Spark's own listing: (path, md5) of those of up to `whole` bytes, and (path) of the larger ones."""
    listed = spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(paths)
    small = listed.where(F.col("length") <= whole).select("path", F.md5("content").alias("md5"))
    return small, listed.where(F.col("length") > whole).select("path")
