"""Operators 4 and 5: byte-level BPE round trip and token counts."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import decoder, encoder, ids_of, prepared
from .common import arrow_batches, release


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each whole text, little-endian unsigned 32-bit integers in a binary.

    A null or empty text has no ids. Each input row gives one row, repeated ids too; other columns
    of docs are not read. Words of any length are encoded by the states of TrieEncoder's trie, once for each
    distinct word that a worker remembers; special strings in a text give their special ids.
    """
    arrow_batches(docs.sparkSession)

    def run(batches):
        enc = encoder(path, short=0)
        for batch in batches:
            ids = [ids_of(enc, p) for p in prepared(enc, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the text that the ids stand for, special tokens kept; null ids give a null text."""
    arrow_batches(encoded.sparkSession)

    def run(batches):
        dec = decoder(path)
        for batch in batches:
            texts = [None if x is None else dec.text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text) of encode() and then decode(), in one worker: the ids don't go back to the JVM between the two."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        enc, dec = encoder(path, short=0), decoder(path)
        for batch in batches:
            ids = [ids_of(enc, p) for p in prepared(enc, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(map(dec.text, ids), pa.string())], names=["doc_id", "ids", "text"])
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def round_trip_digest(docs: DataFrame, path: str) -> DataFrame:
    return round_trip(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each whole text, without making its ids.

    The pieces of a pre-token are counted once for each distinct one that a worker remembers; a
    document's frequencies of pre-tokens are joined to these counts and summed, within the task
    that read it: a shuffle of all (document, pre-token) rows would outweigh the text. A null or
    empty text has no bytes and no tokens. A special string in a text is one token.
    """
    arrow_batches(docs.sparkSession)

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            totals, sizes, run_of, held = [], [], [], 0

            def close(run_of, totals):
                known = enc.counts({w for counts, _ in run_of for w in counts})
                totals.extend(sum([known[w] * n for w, n in counts.items()]) + extra for counts, extra in run_of)

            for text in batch.column(1).to_pylist():
                text = text or ""
                counts, extra = Counter(), 0
                for special, words in enc.parsed(text):
                    extra += special is not None
                    counts.update(words)
                run_of.append((counts, extra))
                sizes.append(len(text.encode()))
                held += len(text)
                if held >= 1 << 20:
                    close(run_of, totals)
                    run_of, held = [], 0
            close(run_of, totals)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
