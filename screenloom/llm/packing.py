"""Operator 6: token ids as fixed-width bit-packed blocks, written in document order and read back."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import encoder, ids_of, prepared
from .common import arrow_batches, release, table

BLOCK_IDS = 1 << 18
KEEP = 128 << 20  # bytes of encodings that a worker remembers
BLOCKS = "part int, block int, start long, n_ids long, width int, doc_ids array<long>, offsets array<long>, payload binary"


def width_of(n_ids: int) -> int:
    """The fewest bits that hold every id below n_ids."""
    return max(1, (n_ids - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Id i takes the bits from i * width on, lowest bit first; whole bytes are taken as such."""
    if width % 8 == 0:
        return np.ascontiguousarray(ids, "<u4").view("u1").reshape(-1, 4)[:, : width // 8].tobytes()
    bits = np.unpackbits(np.ascontiguousarray(ids, "<u4").view("u1").reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, first: int, count: int) -> np.ndarray:
    """Ids first .. first + count - 1 of a block, without reading the rest of it."""
    if not count:
        return np.empty(0, "<u4")
    if width % 8 == 0:
        n = width // 8
        whole = np.zeros((count, 4), "u1")
        whole[:, :n] = np.frombuffer(payload, "u1", count * n, first * n).reshape(count, n)
        return whole.view("<u4").ravel()
    low, high = first * width // 8, -(-(first + count) * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, "u1", high - low, low), bitorder="little")
    bits = bits[first * width - 8 * low :][: count * width].reshape(count, width)
    out = np.zeros((count, 32), "u1")
    out[:, :width] = bits
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def write_blocks(docs: DataFrame, path: str, end_id: int | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode all texts in ascending doc_id order and write them as blocks of about block_ids ids.

    Documents are range partitioned by doc_id, so blocks of ascending (part, block) hold ascending
    ids. A row is one block: where it starts in its part, the documents in it and where each begins
    (offsets, in ids, with the end), and the packed ids. A document is never split, so a very long one has a
    block of its own size. Null ids come first, rows that share an id are dealt to several tasks and ordered by a hash of the text, a null
    or empty text has the end id alone. Other columns aren't read. The container is Parquet, written by Spark's committer: a
    lost executor's blocks are written anew. Returns the table as read back.
    """
    spark = docs.sparkSession
    arrow_batches(spark)

    def run(batches):
        enc = encoder(path, KEEP)
        size = 1 + max(max(enc.ids.values()), *enc.special.values(), end_id or 0)
        width, tail = width_of(size), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        part, block, start, names, parts, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def made():
            offsets = np.cumsum([0, *(len(p) // 4 for p in parts)])
            ids = np.frombuffer(b"".join(parts), "<u4")
            payload = b"".join(pack(ids[i : i + 65536], width) for i in range(0, len(ids), 65536))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "start": start, "n_ids": len(ids), "width": width, "doc_ids": names, "offsets": offsets.tolist(), "payload": payload}],
                schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]),
            )

        for batch in batches:
            for name, parsed in zip(batch.column(0).to_pylist(), prepared(enc, batch.column(1).to_pylist())):
                ids = ids_of(enc, parsed) + tail
                names.append(name)
                parts.append(ids)
                held += len(ids) // 4
                if held >= block_ids:
                    yield made()
                    block, start, names, parts, held = block + 1, start + held, [], [], 0
        if names:
            yield made()
        release()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text", F.pmod(F.monotonically_increasing_id(), F.lit(1009))).alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return table(ordered.mapInArrow(run, BLOCKS), "blocks")


def read_blocks(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document: start is the number of ids of all documents before it."""
    arrow_batches(blocks.sparkSession, rows=16)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))  # a row for each task that wrote
    before = parts.select("part", F.coalesce(F.sum("part_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = row["offsets"]
                ids = [unpack(row["payload"], row["width"], a, b - a).tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["before"] + row["start"] + a for a in at[:-1]], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"]
                )

    return blocks.join(before, "part").mapInArrow(run, "doc_id long, start long, ids binary")


def blocks_digest(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    read = read_blocks(write_blocks(docs, path, end_id))
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
