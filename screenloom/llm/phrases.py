"""Operator 12: phrases whose words keep together, counted exactly after pruning by hashed buckets and by their parts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_batches, drop_table, release, table
from .textbytes import LOWER, ROOTS, buffer_of, mixed, slices, word_hashes

#: What a byte is to a phrase: part of a word, between words, or the end of a piece.
PART, GAP, END = 0, 1, 2
ROLE = np.zeros(256, np.uint8)
ROLE[[0x20, 0x09]] = GAP
ROLE[[*b".,;:!?", *range(0x0A, 0x0E)]] = END
BLOCK = 1 << 14  # buckets of one row of counts, bits of one row of marks
HUB = 100_000  # rows of one key that one task of a join takes


@dataclass(frozen=True)
class Bits:
    """Sizes of what a pass holds: bits of the number of buckets that phrases of the next length are counted in, bits of the number of marks for
    frequent phrases, and rows that a task holds before it adds equal phrases up. Both numbers of bits are 14 or more."""

    buckets: int = 25
    known: int = 27
    rows: int = 1_000_000


class Pieces:
    """Words of some texts: places, hashes, the piece each is in and the text it is from."""

    def __init__(self, texts: pa.Array, langs: np.ndarray):
        body, at = buffer_of(texts)
        self.body = LOWER[body]
        role = ROLE[body]
        inside = np.concatenate([[False], role == PART, [False]])
        edge = np.zeros(len(body) + 1, bool)
        edge[at] = True  # words don't run on into the next text
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        self.home = np.searchsorted(at, self.starts, side="right") - 1
        # one more at each end of a piece and at each new text, so equal numbers are one piece
        self.piece = np.concatenate([[0], np.cumsum(role == END)])[self.starts] + self.home
        self.words = word_hashes(self.body, self.starts, self.ends, ROOTS[0])
        self.langs = langs[self.home]

    def whole(self, k: int) -> np.ndarray:
        """Whether k words from each place on are in one piece."""
        n = max(0, len(self.words) - k + 1)
        return self.piece[k - 1 : k - 1 + n] == self.piece[:n]

    def keys(self, k: int) -> np.ndarray:
        """A 64-bit key of the k words from each place on, and of the language."""
        n = max(0, len(self.words) - k + 1)
        key = self.words[:n]
        for j in range(1, k):
            key = mixed(key * ROOTS[1] + self.words[j : j + n])
        return mixed(key ^ self.langs[:n])

    def phrases(self, k: int, where: np.ndarray) -> pa.Array:
        """The k words from each of these places on, joined by one blank."""
        sizes = self.ends - self.starts
        total = np.concatenate([[0], np.cumsum(sizes)])
        joined, to = np.full(int(total[-1]) + len(sizes), 32, np.uint8), total + np.arange(len(total))
        joined[np.arange(int(total[-1])) + np.repeat(np.arange(len(sizes)), sizes)] = self.body[np.arange(int(total[-1])) + np.repeat(self.starts - total[:-1], sizes)]
        first, many = to[where], to[where + k] - 1 - to[where]
        offsets = np.concatenate([[0], np.cumsum(many)])
        laid = joined[np.arange(int(offsets[-1])) + np.repeat(first - offsets[:-1], many)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(where), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(laid)])


def marked(bits: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Whether the bit of each key is set in a packed array of 2**size bits."""
    place = (keys >> np.uint64(64 - size)).astype(np.int64)
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def language_keys(langs: list[str]) -> np.ndarray:
    raw = [x.encode() for x in langs]
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), at[:-1], at[1:], ROOTS[1])


def counts_of_blocks(held: np.ndarray) -> tuple[list[int], list[bytes]]:
    """(block, counts) of a task's bucket counts: all counts of a block, or the places and counts of those that aren't 0 where that is shorter."""
    blocks, rows = [], []
    for block in range(len(held) // BLOCK):
        own = held[block * BLOCK : (block + 1) * BLOCK]
        some = np.flatnonzero(own)
        if len(some):
            blocks.append(block)
            rows.append(own.tobytes() if 3 * len(some) >= BLOCK else some.astype("<u2").tobytes() + own[some].tobytes())
    return blocks, rows


def frequent_bits(blocks: DataFrame, least: int, size: int) -> np.ndarray:
    """2**size bits, packed: which buckets have counts of `least` or more in all of blocks (block, counts). The driver gets 2**size / 8 bytes."""

    def run(batches):
        now, held = None, None
        for batch in batches:
            out = []
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if now is not None:
                        out.append((now, np.packbits(held >= least).tobytes()))
                    now, held = block, np.zeros(BLOCK, np.int64)
                data = np.frombuffer(raw.as_buffer(), np.uint8)
                if len(data) == BLOCK:
                    held += data
                else:
                    n = len(data) // 3
                    held[data[: 2 * n].view("<u2")] += data[2 * n :]
            yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in out], pa.int32()), "bits": pa.array([x for _, x in out], pa.binary())})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int32()), "bits": pa.array([np.packbits(held >= least).tobytes()], pa.binary())})

    dealt = blocks.select("block", "counts").repartition("block").sortWithinPartitions("block")
    return gathered(dealt.mapInArrow(run, "block int, bits binary"), size)


def gathered(rows: DataFrame, size: int) -> np.ndarray:
    bits = np.zeros(1 << size >> 3, np.uint8)
    for r in rows.collect():
        bits[r.block * BLOCK // 8 : (r.block + 1) * BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def known_bits(frequent: DataFrame, k: int, size: int) -> np.ndarray:
    """2**size bits, packed, with the bit of each frequent phrase (lang, phrase) of k words set: others may share it, none is lost."""
    arrow_batches(frequent.sparkSession, 100_000)

    def keys(batches):
        for batch in batches:
            pieces = Pieces(batch.column(1), language_keys(batch.column(0).to_pylist()))
            place = (pieces.keys(k)[pieces.whole(k)] >> np.uint64(64 - size)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"block": pa.array((place // BLOCK).astype(np.int32)), "place": pa.array((place % BLOCK).astype(np.int32))})

    def mark(batches):
        now, held, out = None, None, []
        for batch in batches:
            block, place = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for one in np.unique(block).tolist():
                if one != now:
                    if now is not None:
                        out.append((now, np.packbits(held).tobytes()))
                    now, held = one, np.zeros(BLOCK, bool)
                held[place[block == one]] = True
        if now is not None:
            out.append((now, np.packbits(held).tobytes()))
        yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in out], pa.int32()), "bits": pa.array([x for _, x in out], pa.binary())})

    places = frequent.select("lang", "phrase").mapInArrow(keys, "block int, place int")
    return gathered(places.repartition("block").sortWithinPartitions("block").mapInArrow(mark, "block int, bits binary"), size)


def counting(k: int, last: bool, parts, buckets, bits: Bits):
    """A pass over batches (lang, text): rows (lang, phrase, n) of the phrases of k words that may be frequent, and (block, counts) of those of k + 1.

    A phrase may be frequent if both its parts of k - 1 words are marked in `parts` and its bucket in `buckets` (broadcasts; none for single words).
    A phrase of k + 1 words is counted in its bucket if both its parts may be frequent.
    """

    def run(batches):
        names: dict[str, int] = {}
        rows, n_rows = [], 0
        held = np.zeros(0 if last else 1 << bits.buckets, np.uint8)

        def summed() -> pa.Table:
            return pa.concat_tables(rows).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])

        def out(done: pa.Table):
            langs = pa.array([*names], pa.string())
            for part in done.to_batches(max_chunksize=100_000):
                column = dict(zip(part.schema.names, part.columns))
                none = pa.nulls(part.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([langs.take(column["lang"]), column["phrase"].cast(pa.large_string()).cast(pa.string()), column["n_sum"], none, pa.nulls(part.num_rows, pa.binary())], names=["lang", "phrase", "n", "block", "counts"])

        for batch in batches:
            for first, count in slices(batch.column(1)):
                own = batch.column(0).slice(first, count).to_pylist()
                pieces = Pieces(batch.column(1).slice(first, count), language_keys(own))
                may = pieces.whole(k)
                if k > 1 and len(may):
                    part = marked(parts.value, pieces.keys(k - 1), bits.known)
                    may &= part[:-1] & part[1:]
                    may[may] = marked(buckets.value, pieces.keys(k)[may], bits.buckets)
                where = np.flatnonzero(may)
                if len(where):
                    codes = np.array([names.setdefault(x, len(names)) for x in own], np.int32)
                    rows.append(pa.table({"lang": codes[pieces.home[where]], "phrase": pieces.phrases(k, where), "n": np.ones(len(where), np.int64)}))
                    n_rows += len(where)
                if not last and len(may) > 1:
                    more = pieces.whole(k + 1) & may[:-1] & may[1:]
                    place, times = np.unique((pieces.keys(k + 1)[more] >> np.uint64(64 - bits.buckets)).astype(np.int64), return_counts=True)
                    held[place] = np.minimum(held[place] + np.minimum(times, 255), 255)
                if n_rows > bits.rows:
                    done = summed()
                    if done.num_rows > bits.rows // 2:
                        yield from out(done)
                        rows, n_rows = [], 0
                    else:
                        rows, n_rows = [done.rename_columns(["n" if c == "n_sum" else c for c in done.schema.names]).select(["lang", "phrase", "n"])], done.num_rows
        if rows:
            yield from out(summed())
        blocks, counts = counts_of_blocks(held)
        for lo in range(0, len(blocks), 256):
            n = len(blocks[lo : lo + 256])
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(blocks[lo : lo + 256], pa.int32()), pa.array(counts[lo : lo + 256], pa.binary())], names=["lang", "phrase", "n", "block", "counts"])
        release()

    return run


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, bits: Bits = Bits()) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of every phrase of 1 to `longest` words with n occurrences, n of `least` or more; and (lang, n) of all words. Both are written tables.

    One pass over the texts for each length counts the phrases of that length exactly, and those of the next length in 2**25 hashed
    buckets. Before the next pass the buckets that reach `least` and the frequent phrases become bitmaps of 4 and 16 MB, whatever the size of the
    corpus, which are broadcast: only phrases whose bucket and whose parts are marked are counted. A bitmap never leaves out a frequent phrase; what it
    lets through too much is counted exactly and dropped. Equal phrases are added up in the task that read them before they are shuffled.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where("text is not null")
    context, found, totals, held = spark.sparkContext, None, None, []
    parts = buckets = None
    for k in range(1, longest + 1):
        last = k == longest
        made = table(texts.mapInArrow(counting(k, last, parts, buckets, bits), "lang string, phrase string, n long, block int, counts binary"), "counted")
        counted = made.where("phrase is not null")
        if k == 1:
            totals = table(counted.groupBy("lang").agg(F.sum("n").alias("n")), "totals", 1)
        own = table(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", F.lit(k).alias("k"), "phrase", "n"), "frequent")
        held.append(own)
        found = own if found is None else found.unionByName(own)
        for old in (parts, buckets):
            if old is not None:
                old.unpersist()
        if not last:
            parts, buckets = context.broadcast(known_bits(own, k, bits.known)), context.broadcast(frequent_bits(made.where("block is not null"), least, bits.buckets))
        drop_table(made)
    return found, totals


def looked_up(rows: DataFrame, counts: DataFrame, part: str, name: str, hub: int) -> DataFrame:
    """rows (lang, phrase, and the phrase's `part`) with the count of that part as `name`.

    A part that very many phrases have is dealt to several tasks, each with a copy of its count: of counts (lang, phrase, n, most), most
    is how many rows it can have at most. `hub` is such that those parts are few, and they are broadcast.
    """
    known = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name), F.ceil(F.col("most") / hub).alias("deals"))
    hubs = known.where("deals > 1").select("lang", part, "deals")
    copies = known.select("lang", part, name, F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("deals") - 1, F.lit(0)))).alias("deal"))
    dealt = rows.join(F.broadcast(hubs), ["lang", part], "left").withColumn("deal", F.pmod(F.xxhash64("phrase"), F.coalesce("deals", F.lit(1).cast("long"))))
    return dealt.drop("deals").join(copies.hint("merge"), ["lang", part, "deal"]).drop("deal")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000, bits: Bits = Bits()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to `longest` words.

    a is how often the phrase occurs, l and r how often the two parts do at the cut with the lowest score, and the score is
    floor(1000000 a a / (l r)) in whole numbers of 38 digits. Phrases of which `inside` per cent or more occur in one longer phrase are left
    out. A null text has no words, a null language is 'und'; rows that repeat count as often as they occur.
    """
    found, totals = frequent_phrases(docs, longest, least, bits)
    most = totals.agg(F.sum("n").alias("n")).first().n or 0
    hub = max(HUB, most // (least * HUB))  # at most about HUB parts have more rows
    counts = found.withColumn("most", F.col("n") / least)
    several = found.where("k > 1")
    cuts = several.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumn("left", F.expr("substring_index(phrase, ' ', j)"))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)")).select("lang", "phrase", F.col("n").alias("a"), "j", "left", "right")
    both = looked_up(looked_up(cuts, counts, "left", "l", hub), counts, "right", "r", hub)
    exact = F.expr("(cast(1000000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0))) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    best = both.select("lang", "phrase", "a", F.struct(exact.alias("score"), "j", "l", "r").alias("cut")).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    longer = several.where("k > 2").select(
        "lang", "n", F.explode(F.expr("array_distinct(flatten(transform(sequence(2, k - 1), m -> transform(sequence(0, k - m), i -> array_join(slice(split(phrase, ' '), i + 1, m), ' ')))))")).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = best.join(longer.hint("merge"), ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    scored = table(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")
    first = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = may_lead(scored, top).withColumn("rank", first).where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def may_lead(scored: DataFrame, top: int) -> DataFrame:
    """Rows that may be among their language's first `top` by score: those down to the step of scores in which the top-th lies, by counts of about 300 steps."""
    step = F.floor(F.log1p(F.col("score").cast("double")) * 20).cast("int")
    stepped = scored.withColumn("step", step)
    sizes = stepped.groupBy("lang", "step").agg(F.count("*").alias("size"))
    before = F.sum("size").over(W.partitionBy("lang").orderBy(F.desc("step"))) - F.col("size")
    open_steps = sizes.withColumn("before", before).where(F.col("before") < top).select("lang", "step")
    return stepped.join(open_steps, ["lang", "step"], "left_semi").drop("step")
