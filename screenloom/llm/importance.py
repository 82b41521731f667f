"""Operator 13: documents drawn like a target text, by importance weights over hashed runs of words and Gumbel noise."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_batches, drop_table, free_name, numbered, release, table
from .textbytes import LOWER, buffer_of, slices

#: Whether a byte belongs to a word: letters, digits and all of UTF-8 beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
STEPS = 64  # bytes that all words advance together; the few words that go on do so one by one


def crc_table() -> np.ndarray:
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(0xEDB88320), rows >> 1)
    return rows


CRC = crc_table()


def crcs(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every range of bytes: the states of all ranges that are that long advance by a byte at once."""
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(starts - ends, kind="stable")  # longest first, so those still running are a prefix
    sizes = (ends - starts)[order]
    going = np.searchsorted(-sizes, -np.arange(1, STEPS + 1), side="right")
    first, run = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for step, n in enumerate(going.tolist()):
        if not n:
            break
        run[:n] = CRC[(run[:n] ^ body[first[:n] + step]) & 0xFF] ^ (run[:n] >> 8)
    run ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(-sizes, -STEPS, side="left"))):
        run[i] = zlib.crc32(body[first[i] + STEPS : first[i] + sizes[i]], int(run[i]))
    state[order] = run
    return state


def features(texts: pa.Array, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every run of 1 to `runs` words, the text of each, and the number of words of each text."""
    body, at = buffer_of(texts)
    body = LOWER[body]
    inside = np.concatenate([[False], INSIDE[body], [False]])
    edge = np.zeros(len(body) + 1, bool)
    edge[at] = True  # words don't run on into the next text
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    before = np.searchsorted(starts, at)
    words = np.diff(before)
    home = np.repeat(np.arange(len(words)), words)
    found, owners = [crcs(body, starts, ends)], [home]
    if runs > 1:
        sizes = ends - starts + 1
        to = np.concatenate([[0], np.cumsum(sizes)])
        joined = np.full(int(to[-1]), 32, np.uint8)
        inner = np.arange(int(to[-1])) - np.repeat(to[:-1], sizes)
        letters = inner < np.repeat(sizes - 1, sizes)
        joined[letters] = body[(np.repeat(starts, sizes) + inner)[letters]]
        for run in range(2, runs + 1):
            first = np.flatnonzero(home[run - 1 :] == home[: len(home) - run + 1])
            found.append(crcs(joined, to[first], to[first + run] - 1))
            owners.append(home[first])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), words


def bucket_counts(texts: DataFrame, column: str = "text", runs: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task gives one number a bucket, which Spark adds up; the driver gets `buckets` rows."""
    arrow_batches(texts.sparkSession)

    def run(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for first, count in slices(batch.column(0)):
                held += np.bincount(features(batch.column(0).slice(first, count), runs, buckets)[0], minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], names=["bucket", "n"])
        release()

    out = np.zeros(buckets, np.int64)
    for r in texts.select(column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of both smoothed shares) of each bucket, in doubles."""
    s_all, t_all, more = int(own.sum()), int(target.sum()), len(own)
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + more)) / ((s + 1) * (t_all + more)))) for s, t in zip(own.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, name: str = "importance", runs: int = 1) -> DataFrame:
    """docs with a column `name`, struct<n_features, words, weight>: the floored mean gain of a text's features, 0 without any."""
    if free_name(docs, name) != name:
        raise ValueError(f"there is a column {name} already")
    arrow_batches(docs.sparkSession)

    @F.arrow_udf("struct<n_features:long,words:long,weight:long>")
    def weigh(texts: pa.Array) -> pa.Array:
        columns = [[np.empty(0, np.int64)] for _ in range(3)]
        for first, count in slices(texts):
            buckets, owner, words = features(texts.slice(first, count), runs, len(gain))
            n = np.bincount(owner, minlength=count)
            total = np.zeros(count, np.int64)
            np.add.at(total, owner, gain[buckets])
            for column, made in zip(columns, (n, words, total // np.maximum(n, 1))):
                column.append(made.astype(np.int64))
        release()
        return pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["n_features", "words", "weight"])

    return docs.withColumn(name, weigh(F.col("text")))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise times 1000, floored: from the first 32 bits of the SHA-256 of `seed:doc_id`. A null id counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(rows: DataFrame, share: float) -> DataFrame:
    """rows (doc_id, words, score and more; a written table) with rank: 1, 2, 3 and so on for the floor(share * N) highest scores of the N rows that may be drawn.

    Ties go to the smaller doc_id, null ids last; rows alike in both take ranks in no set order. A histogram of the
    scores (whole numbers, some ten thousands) gives the lowest that is drawn, so only about the drawn rows are put in order.
    """
    pool = F.col("may")
    levels = rows.where(pool).groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    wanted = round(share * 100) * sum(r.n for r in levels) // 100
    held, least = 0, None
    for r in levels:
        if held >= wanted:
            break
        held, least = held + r.n, r.score
    top = pool & (F.col("score") >= F.lit(least)) if least is not None else F.lit(False)
    none = F.lit(None).cast("long")
    rest = rows.where(~top).withColumn("rank", none)
    placed = numbered(rows.where(top), [F.desc("score"), F.col("doc_id").isNull(), F.asc("doc_id")], "position")
    return rest.unionByName(placed.withColumn("rank", F.when(F.col("position") < wanted, F.col("position") + 1)).drop("position"))


def resampled(docs: DataFrame, target: DataFrame, share: float = 0.1, least_words: int = 20, runs: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs, as the target's texts would have it.

    Texts are read twice, once for the counts of all features and once for the weights; then only these numbers are
    written, ordered and returned. A null or empty text has no feature, weight 0, and is never drawn.
    """
    gain = gains(bucket_counts(docs, "text", runs, buckets), bucket_counts(target, "text", runs, buckets))
    own = weighed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), gain, "found", runs)
    made = own.select("doc_id", "found.*").select("doc_id", "n_features", "weight", (F.col("words") >= least_words).alias("may"), (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"))
    return drawn(table(made, "weights"), share).select("doc_id", "n_features", "weight", "score", "rank")
