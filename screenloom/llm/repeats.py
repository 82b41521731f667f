"""Operator 10: words inside repeated passages, found by fixed-block anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, release, table
from .textbytes import ROOTS, buffer_of, mixed, range_hashes, slices, word_hashes, word_ranges

CHUNK_WORDS = 1_500_000
GROUP_BYTES = 32 << 20  # of text whose entries one task holds at a time, some 250 MB
ROWS = "bucket int, part int, chunk long, docs binary, body binary, gaps binary, many binary, hits binary"
DOC = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("at", "<u4")])


def anchor(window: int) -> int:
    """The largest block size of which every window holds a whole block of any grid."""
    return (window + 1) // 2


class Chunk:
    """Entries (128-bit hash, place) of many documents of one task, aggregated before they are shuffled.

    A hash with several places here is a repeat by itself: its places are reported at once, and
    it travels once. One with a single place travels with it, and gets a reply if it is met elsewhere.
    """

    def __init__(self, buckets: list[int], parts: int, size: int, block: int):
        """buckets: one number for each shuffle partition; each is taken in `parts` parts."""
        self.buckets, self.size, self.block = np.array(buckets, np.int32), size, block
        self.all = len(buckets) * parts
        self.part, self.number = TaskContext.get().partitionId(), 0
        self.clear()

    def clear(self) -> None:
        self.docs, self.high, self.low, self.places, self.words = [], [], [], [], 0

    def add(self, docs: np.ndarray, high: np.ndarray, low: np.ndarray, places: np.ndarray, words: int) -> None:
        """docs: key of each document and its first word's place in this addition."""
        docs = docs.copy()
        docs["at"] += self.words
        self.docs.append(docs)
        self.high.append(high)
        self.low.append(low)
        self.places.append(places + self.words)
        self.words += words

    def rows(self):
        if not self.words:
            return
        docs, high, low, places = map(np.concatenate, (self.docs, self.high, self.low, self.places))
        self.clear()
        chunk, self.number = (self.part << 32) + self.number, self.number + 1
        order = np.lexsort((places, low, high))
        new = np.concatenate([[True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])]) if len(order) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1 if len(group) else new
        owner = np.searchsorted(docs["at"], places, side="right") - 1
        aligned = (places - docs["at"][owner]) % self.block == 0
        if several.any():
            local = np.sort(places[order][several])
            mine = np.searchsorted(docs["at"], local, side="right") - 1
            names, counts = np.unique(mine, return_counts=True)
            head = docs[names]
            body = (local - docs["at"][mine]).astype("<u4")
            head["at"] = counts
            yield {"bucket": int(self.buckets[int(local[0]) % len(self.buckets)]), "part": 0, "chunk": chunk, "docs": head.tobytes(), "body": b"", "gaps": b"", "many": b"", "hits": body.tobytes()}
        first = order[new & several]
        marked = np.zeros(len(group) and int(group[-1]) + 1, bool)
        np.logical_or.at(marked, group[several], aligned[order][several])
        flags = marked[group[new & several]]
        single = np.sort(order[new & ~several]) if len(order) else order
        single = single[np.argsort(places[single], kind="stable")]
        to_single, to_many = (high[single] >> np.uint64(40)) % np.uint64(self.all), (high[first] >> np.uint64(40)) % np.uint64(self.all)
        by_single, by_many = np.argsort(to_single, kind="stable"), np.argsort(to_many, kind="stable")
        cut_single = np.searchsorted(to_single[by_single], np.arange(self.all + 1))
        cut_many = np.searchsorted(to_many[by_many], np.arange(self.all + 1))
        for b in range(self.all):
            mine, many = single[by_single[cut_single[b] : cut_single[b + 1]]], by_many[cut_many[b] : cut_many[b + 1]]
            if not len(mine) and not len(many):
                continue
            named = np.unique(owner[mine])
            at = places[mine]
            gaps = np.diff(at, prepend=0)
            kind = "<u2" if not len(gaps) or gaps.max() < 65536 else "<u4"
            yield {
                "bucket": int(self.buckets[b % len(self.buckets)]),
                "part": b // len(self.buckets),
                "chunk": chunk,
                "docs": docs[named].tobytes(),
                "body": self.packed(high[mine], low[mine]),
                "gaps": gaps.astype(kind).tobytes(),
                "many": b"".join((self.packed(high[first[many]], low[first[many]]), flags[many].astype("u1").tobytes())),
                "hits": b"",
            }

    def packed(self, high: np.ndarray, low: np.ndarray) -> bytes:
        both = np.stack([high.astype("<u8"), low.astype("<u8")], axis=1).view("u1").reshape(-1, 16)
        return np.ascontiguousarray(both[:, : self.size] if self.size <= 8 else np.concatenate([both[:, :8], both[:, 8 : self.size]], axis=1)).tobytes()


SCHEMA = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("chunk", pa.int64()), *((n, pa.binary()) for n in ("docs", "body", "gaps", "many", "hits"))])


def unpacked(raw: bytes, size: int) -> np.ndarray:
    """Entries as rows of one 64-bit integer, or two where an entry is longer."""
    n = len(raw) // size
    out = np.zeros((n, 8 if size <= 8 else 16), "u1")
    out[:, :size] = np.frombuffer(raw, "u1").reshape(n, size)
    return out.view("<u8")


def replies(batches, size: int, indexed: bool, block: int):
    """Rows of one partition, sorted by part, to (chunk, docs, hits): where an entry's hash was met again, a row for each row.

    indexed: only hashes that stand at an aligned block somewhere count: those make the index that the rest probe. A part's
    hashes are in no other, so that one part is held at a time.
    """
    part, rows = 0, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["hits"]:
                yield reply(r["chunk"], r["docs"], r["hits"])
                continue
            if r["part"] != part:
                yield from met(rows, size, indexed, block)
                part, rows = r["part"], []
            rows.append(r)
    yield from met(rows, size, indexed, block)
    release()


def reply(chunk: int, docs: bytes, hits: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([docs], pa.binary()), pa.array([hits], pa.binary())], names=["chunk", "docs", "hits"])


def met(rows: list[dict], size: int, indexed: bool, block: int):
    """The replies to the rows of one part."""
    keys, marks, weight, places, owners, sources = [], [], [], [], [], []
    for number, r in enumerate(rows):
        docs = np.frombuffer(r["docs"], DOC)
        one = unpacked(r["body"], size)
        at = np.cumsum(np.frombuffer(r["gaps"], "<u4" if len(r["gaps"]) == 4 * len(one) else "<u2").astype(np.int64))
        mine = np.searchsorted(docs["at"], at, side="right") - 1
        inner = at - docs["at"][mine]
        n = len(r["many"]) // (size + 1)
        several = unpacked(r["many"][: n * size], size)
        keys += [one, several]
        marks += [inner % block == 0, np.frombuffer(r["many"], "u1")[n * size :].astype(bool)]
        weight += [np.ones(len(one), "u1"), np.full(n, 2, "u1")]
        places += [inner.astype("<u4"), np.zeros(n, "<u4")]
        owners += [mine.astype("<i4"), np.full(n, -1, "<i4")]
        sources += [np.full(len(one), number, "<i4"), np.full(n, -1, "<i4")]
    if not keys:
        return
    keys, marks, weight, places, owners, sources = map(np.concatenate, (keys, marks, weight, places, owners, sources))
    if not len(keys):
        return
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
    keys = keys[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    del keys
    begin = np.flatnonzero(new)
    again = np.add.reduceat(weight[order], begin, dtype=np.int64) > 1
    if indexed:
        again &= np.logical_or.reduceat(marks[order], begin)
    hit = order[np.repeat(again, np.diff(np.append(begin, len(order)))) & (owners[order] >= 0)]
    hit = hit[np.lexsort((places[hit], owners[hit], sources[hit]))]
    cut = np.searchsorted(sources[hit], np.arange(len(rows) + 1))
    for number, r in enumerate(rows):
        part = hit[cut[number] : cut[number + 1]]
        if len(part):
            names, counts = np.unique(owners[part], return_counts=True)
            head = np.frombuffer(r["docs"], DOC)[names]
            head["at"] = counts
            yield reply(r["chunk"], head.tobytes(), places[part].tobytes())


def by_document(batches):
    """(chunk, docs, hits) sorted by chunk to (k1, k2, places), a row for each document of a chunk."""

    def close(held):
        docs = np.concatenate([np.frombuffer(d, DOC) for d, _ in held])
        hits = np.concatenate([np.frombuffer(h, "<u4") for _, h in held])
        names, which = np.unique(docs[["k1", "k2"]], return_inverse=True)
        owner = np.repeat(which, docs["at"])
        order = np.lexsort((hits, owner))
        cut = np.searchsorted(owner[order], np.arange(1, len(names)))
        found = [x.tobytes() for x in np.split(hits[order], cut)]
        return pa.RecordBatch.from_arrays([pa.array(names["k1"]), pa.array(names["k2"]), pa.array(found, pa.binary())], names=["k1", "k2", "places"])

    now, held = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["chunk"] != now and held:
                yield close(held)
                held = []
            now = r["chunk"]
            held.append((r["docs"], r["hits"]))
    if held:
        yield close(held)


def window_hashes(body, starts, ends, words, width: int):
    """For each text's windows of `width` words: two hashes, and the place of the window's first word."""
    a, b = (word_hashes(body, starts, ends, r) for r in ROOTS)
    n = np.diff(words)
    each = np.maximum(0, n - width + 1)
    first = np.repeat(words[:-1], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return mixed(range_hashes(a, first, first + width, ROOTS[1])), mixed(range_hashes(b, first, first + width, ROOTS[0])), first


def met_again(source: DataFrame, width: int, size: int, indexed: bool, block: int, parts_each: int, near: int = 0) -> DataFrame:
    """(k1, k2, found): for each text, lists of the places (little-endian 32-bit) of its windows that stand elsewhere too.

    source has k1, k2, text and, where near is positive, the places that a window must hold one of among its first `near` words.
    A shuffle partition is worked off in parts_each parts.
    """
    spark = source.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spark.range(parts * 40).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
    buckets = sorted(int(r.id) for r in dealt.collect())  # one number for each shuffle partition

    def emit(batches):
        chunk = Chunk(buckets, parts_each, size, block)
        for batch in batches:
            for first, count in slices(batch.column(2)):
                part = batch.slice(first, count)
                body, at = buffer_of(part.column(2))
                starts, ends, words = word_ranges(body, at)
                high, low, place = window_hashes(body, starts, ends, words, width)
                if near:
                    anchored = np.zeros(len(starts) + 1, np.int64)
                    for lo, lists in zip(words[:-1].tolist(), part.column(3).to_pylist()):
                        for raw in lists:
                            np.add.at(anchored, lo + np.frombuffer(raw, "<u4").astype(np.int64) + 1, 1)
                    anchored = np.cumsum(anchored)
                    take = anchored[place + near] > anchored[place]
                    high, low, place = high[take], low[take], place[take]
                docs = np.zeros(count, DOC)
                docs["k1"], docs["k2"], docs["at"] = np.asarray(part.column(0)), np.asarray(part.column(1)), words[:-1]
                chunk.add(docs, high, low, place, len(starts))
                if chunk.words >= CHUNK_WORDS:
                    yield from (pa.RecordBatch.from_pylist([r], schema=SCHEMA) for r in chunk.rows())
        yield from (pa.RecordBatch.from_pylist([r], schema=SCHEMA) for r in chunk.rows())
        release()

    def answer(batches):
        yield from replies(batches, size, indexed, block)

    dealt = source.mapInArrow(emit, ROWS).repartition(parts, "bucket")
    answers = (dealt.sortWithinPartitions("part") if parts_each > 1 else dealt).mapInArrow(answer, "chunk long, docs binary, hits binary")
    found = answers.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(by_document, "k1 long, k2 long, places binary")
    return found.groupBy("k1", "k2").agg(F.collect_list("places").alias("found"))


def repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each whole text without the words that a repeated window of `window` words covers.

    1. Blocks of 18 words on a grid of each text are the index, every rolling window of 18 words probes it. A window of 35
       words holds a whole block of any grid, so one that is repeated holds a hit among its first 18 places.
    2. Hits are extended: of the windows of 35 words that hold one, those whose sequence is met again stay, by 96 bits of hash.
       Neighbouring ones join to maximal repeats, and every word in one is removed.

    Texts stand by a hash of id and text, so rows that share an id but not the text are told apart, and rows that repeat
    each other repeat every window. A null text has no words. Hashes travel packed, for each task and
    shuffle partition; a hash that a task meets often travels once. A partition of more than about GROUP_BYTES of text is sorted and worked off in parts.
    """
    arrow_batches(docs.sparkSession)
    block = anchor(window)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    parts_each = max(1, -(-size // (GROUP_BYTES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    hits = table(met_again(keyed.select("k1", "k2", "text"), block, 5, True, block, parts_each), "hits")
    candidates = keyed.join(hits, ["k1", "k2"]).select("k1", "k2", "text", "found")
    flags = table(met_again(candidates, window, 12, False, block, parts_each, near=block), "repeats")
    marked = keyed.join(flags, ["k1", "k2"], "left").select("doc_id", "text", "found")

    def run(batches):
        for batch in batches:
            counts, removed, kept = [], [], []
            for first, count in slices(batch.column(1)):
                part = batch.slice(first, count)
                body, at = buffer_of(part.column(1))
                starts, ends, words = word_ranges(body, at)
                plain = body.tobytes()
                for lo, hi, lists in zip(words[:-1].tolist(), words[1:].tolist(), part.column(2).to_pylist()):
                    cover = np.zeros(hi - lo + 1, np.int64)
                    for raw in lists or ():
                        places = np.frombuffer(raw, "<u4").astype(np.int64)
                        np.add.at(cover, places, 1)
                        np.add.at(cover, places + window, -1)
                    stay = lo + np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                    counts.append(hi - lo)
                    removed.append(hi - lo - len(stay))
                    kept.append(b" ".join([plain[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def repeats_digest(docs: DataFrame) -> DataFrame:
    return repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
