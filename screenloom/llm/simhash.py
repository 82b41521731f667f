"""Operator 2: SimHash fingerprints, linked within a Hamming distance by vantage-point trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, drop_table, release, table
from .graph import components
from .textbytes import LOWER, buffer_of, slices, word_ranges

SEED, BITS = 42, 64
MOST = 20_000  # members that one shard may have
LEVELS = 8  # splits of a shard by vantage points before the rest is dealt in blocks
LEAF = 64


def fingerprint_column(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit SimHash of each text, as signed integers."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = []
    for first, count in slices(texts):
        body, at = buffer_of(texts.slice(first, count))
        starts, ends, words = word_ranges(body, at)
        body = LOWER[body]
        # words with one blank after each
        sizes = ends - starts + 1
        to = np.concatenate([[0], np.cumsum(sizes)])
        joined = np.full(int(to[-1]), 32, np.uint8)
        lengths = ends - starts
        source = np.repeat(starts - to[:-1], lengths)
        target = np.arange(int(lengths.sum())) + np.repeat(to[:-1] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        joined[target] = body[target + source]
        plain = joined.tobytes()
        begin, end = to[:-1].tolist(), (to[1:] - 1).tolist()
        for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
            if a == b:
                out.append(0)
                continue
            n = max(1, b - a - shingle + 1)
            counts = np.zeros(BITS, np.int64)
            for lo in range(a, a + n, 65536):
                hi = min(lo + 65536, a + n)
                hashes = np.array([digest(plain[x:y], SEED) for x, y in zip(begin[lo:hi], end[lo + shingle - 1 : hi + shingle - 1] if b - a >= shingle else [end[b - 1]])], ">u8")
                counts += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            out.append(int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big"))
    return np.array(out, np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): SimHash of each whole text over its word shingles; no words give 0."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint_column(batch.column(1), shingle))], names=["doc_id", "fp"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Spanning edges of the pairs found so far: a label for each member, and the links that joined two."""

    def __init__(self, n: int):
        self.label, self.links = np.arange(n), []

    def take(self, i: int, near: np.ndarray) -> None:
        labels = self.label[near]
        others, first = np.unique(labels, return_index=True)
        apart = others != self.label[i]
        self.links += [(i, int(near[k])) for k in first[apart]]
        if apart.any():
            self.label[np.isin(self.label, others[apart])] = self.label[i]


def tree_links(points: np.ndarray, residents: int, radius: int) -> list[tuple[int, int]]:
    """Links within radius between points[:residents] and all points, but for those that others imply.

    A vantage point splits the residents at the median distance d. A pair across the split has its
    outer member within d + radius, so only those visit the inner branch; by the same bound visitors enter the branches.
    """
    forest = Forest(len(points))

    def search(own: np.ndarray, guests: np.ndarray) -> None:
        if len(own) > LEAF:
            away = np.bitwise_count(points[own] ^ points[own[0]])
            cut = int(np.median(away))
            inner, outer = own[away <= cut], own[away > cut]
            if len(outer):
                far = np.bitwise_count(points[guests] ^ points[own[0]])
                search(inner, np.concatenate([guests[far <= cut + radius], outer[away[away > cut] <= cut + radius]]))
                search(outer, guests[far.astype(int) > cut - radius])
                return
        everyone = np.concatenate([own, guests])
        for lo in range(0, len(own), 256):
            rows = own[lo : lo + 256]
            close = np.bitwise_count(points[rows][:, None] ^ points[everyone][lo:][None, :]) <= radius
            close[np.arange(len(rows)), np.arange(len(rows))] = False
            for k in np.flatnonzero(close.any(axis=1)):
                forest.take(int(rows[k]), everyone[lo:][close[k]])

    search(np.arange(residents), np.arange(residents, len(points)))
    return forest.links


def shard_links(batches, radius: int):
    """Batches of (shard, own, fp, rep), sorted by shard with own rows first, to batches of links (u, v)."""
    shard, own, guests, reps = None, [], [], []

    def close():
        links = []
        residents = np.concatenate([p for p, _ in own]) if own else np.empty(0, np.uint64)
        if len(residents) and len(residents) + sum(len(p) for p, _ in guests) > 1:
            points = np.concatenate([residents, *(p for p, _ in guests)])
            names = np.concatenate([n for _, n in own + guests])
            links = [(names[a], names[b]) for a, b in tree_links(points, len(residents), radius)]
        return links

    for batch in batches:
        shards, mine = np.asarray(batch.column(0)), np.asarray(batch.column(1).cast(pa.int8())).astype(bool)
        points, reps = np.asarray(batch.column(2)).view(np.uint64), np.asarray(batch.column(3))
        cuts = np.concatenate([[0], np.flatnonzero(shards[1:] != shards[:-1]) + 1, [len(shards)]])
        links = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if shards[a] != shard:
                links += close()
                shard, own, guests = shards[a], [], []
            home = mine[a:b]
            if home.any():
                own.append((points[a:b][home], reps[a:b][home]))
            if not home.all():
                guests.append((points[a:b][~home], reps[a:b][~home]))
                if sum(len(p) for p, _ in guests) > MOST:
                    links += close()
                    guests = []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["u", "v"])
    links = close()
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["u", "v"])


def links(points: DataFrame, radius: int = 4, most: int = MOST, levels: int = LEVELS) -> DataFrame:
    """(u, v): links that connect all points (fp, rep; each fp once) within `radius` bits, pair by pair exact.

    Of radius + 1 blocks of bits two such fingerprints share one whole, so points are dealt to the
    shards (block, its value). A shard with more than `most` members is split at its vantage point's
    median distance, level by level; points within `radius` beyond the border visit the shard across it. What vantage points don't
    part after `levels` is compared in blocks of residents that all members of the shard visit. Each shard is
    searched by a vantage-point tree of its own, and gives a spanning forest of its links.
    """
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    keys = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    members = points.select("fp", "rep", F.explode(F.array(*keys)).alias("key")).select(F.xxhash64("key.block", "key.value").alias("shard"), F.lit(True).alias("own"), "fp", "rep")
    for level in range(levels + 1):
        sizes = members.groupBy("shard").agg(F.count("*").alias("n"), F.min_by("fp", F.struct(~F.col("own"), F.xxhash64("fp"))).alias("vantage"))
        large = table(sizes.where(F.col("n") > most), "large")
        if large.isEmpty():
            drop_table(large)
            break
        rest, crowd = members.join(large, "shard", "left_anti"), members.join(large, "shard")
        if level == levels:
            block = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / most))
            blocks = crowd.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / most) - 1)))
            split = blocks.select(F.xxhash64("shard", "block").alias("shard"), (F.col("own") & (block == F.col("block"))).alias("own"), "fp", "rep")
        else:
            away = crowd.withColumn("away", F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))).cast("int"))
            cuts = away.where("own").groupBy("shard").agg(F.percentile_approx("away", 0.5).alias("cut"))
            away = away.join(cuts, "shard")
            inner, outer = F.col("away") <= F.col("cut"), F.col("away") > F.col("cut")
            sides = F.array(
                F.when((F.col("own") & inner) | (F.col("away") <= F.col("cut") + radius), F.struct(F.lit(0).alias("side"), (F.col("own") & inner).alias("own"))),
                F.when((F.col("own") & outer) | (~F.col("own") & (F.col("away") > F.col("cut") - radius)), F.struct(F.lit(1).alias("side"), F.col("own").alias("own"))),
            )
            split = away.select("shard", "fp", "rep", F.explode(F.array_compact(sides)).alias("to")).select(F.xxhash64("shard", "to.side").alias("shard"), "to.own", "fp", "rep")
        before, members = members, table(rest.unionByName(split), "members")
        drop_table(large)
        if level:
            drop_table(before)
    dealt = members.repartition("shard").sortWithinPartitions("shard", F.desc("own"), "fp")

    def run(batches):
        return shard_links(batches, radius)

    return dealt.mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of each row: component_id is the smallest doc_id reachable by links of at most `radius` bits.

    Exact copies meet as one fingerprint before any comparison, and links are between fingerprints, so a row with a null doc_id links its
    neighbours like any other and only never names a component; a component of null ids alone is null. Texts without words have
    fingerprint 0 and are linked like any other. Rows that repeat a doc_id stay.
    """
    own = table(fingerprints(docs, shingle), "fingerprints")
    points = table(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    found = components(links(points.select("fp", F.col("fp").alias("rep")), radius)).withColumnRenamed("node", "fp")
    linked = table(found.join(points, "fp").select("fp", "component", "least"), "linked")
    named = linked.groupBy("component").agg(F.min("least").alias("first"))
    firsts = linked.select("fp", "component").join(named, "component").select("fp", "first")
    known = points.join(firsts, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id"))
    return own.join(known, "fp", "left").select("doc_id", "fp", "component_id")


def near_groups_digest(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
