"""The pipeline's near copies: candidates from operator 2's linked fingerprints and from banded min-hashes of word shingles, checked by their exact Jaccard similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, by_keys, drop_table, free_name, release, table
from .graph import components, with_least
from .simhash import fingerprint_column, links as fingerprint_links
from .textbytes import LOWER, ROOTS, buffer_of, mixed, range_hashes, slices, word_hashes, word_ranges

SHINGLE, LEAST = 5, 0.8
FINGERPRINT_SHINGLE, RADIUS = 4, 4  # operator 2's
BANDS, ROWS = 20, 5  # a pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.9996 at 0.8
CENTRES = (1, 1, 2)  # how many of a band's members the others are held against, round by round; what is left then meets by rare shingles
RARITY_BITS, RARITY_BLOCK = 18, 4096  # shingles are counted in so many hashed places, and added up by blocks of them
CROWD = 200  # texts of a shingle that one task of the join takes
#: Odd factors of the min-hashes' orders, and of the rows of a band.
FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * ROOTS[0]) | np.uint64(1)


def shingles(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's word shingles in turn, and where each text's begin, with the end.

    A text of fewer words is one shingle, one without words has none.
    """
    body, at = buffer_of(texts)
    starts, ends, words = word_ranges(body, at)
    hashes = word_hashes(LOWER[body], starts, ends, ROOTS[0])
    n = np.diff(words)
    many = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    to = np.concatenate([[0], np.cumsum(many)])
    first = np.arange(to[-1]) + np.repeat(words[:-1] - to[:-1], many)
    last = np.minimum(first + shingle, np.repeat(words[1:], many))
    return mixed(range_hashes(hashes, first, last, ROOTS[1]) + (last - first).astype(np.uint64)), to


def bands(texts: pa.Array) -> pa.Array:
    """list<long> of each text: a hash for each band of its min-hashes; none without words."""
    out = []
    for begin, count in slices(texts):
        hashes, to = shingles(texts.slice(begin, count))
        some = np.flatnonzero(np.diff(to))
        made = np.zeros((len(some), BANDS), np.uint64)
        for k, factor in enumerate(FACTORS if len(some) else []):
            # 'some' leaves out empty texts only, so each range ends where the next begins
            made[:, k // ROWS] = mixed(made[:, k // ROWS] + np.minimum.reduceat(hashes * factor, to[some]) + np.uint64(k))
        rows = [[] for _ in range(count)]
        for i, row in zip(some.tolist(), made.view(np.int64).tolist()):
            rows[i] = row
        out += rows
    return pa.array(out, pa.list_(pa.int64()))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, node, fp, bands) of each row: operator 2's fingerprint and the bands; equal texts have one node, a 64-bit hash of the text."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            prints = pa.array(fingerprint_column(batch.column(2), FINGERPRINT_SHINGLE))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints, bands(batch.column(2))], names=["doc_id", "node", "fp", "bands"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("node"), "text").mapInArrow(run, "doc_id long, node long, fp long, bands array<long>")


def near_prints(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, centre): pairs of texts (node, fp, bands) that connect those whose fingerprints operator 2 links, by at most radius bits.

    Texts without words, which all have fingerprint 0, are left to their equal ones.
    """
    some = points.where(F.size("bands") > 0).select("node", "fp")
    first = table(some.groupBy("fp").agg(F.min("node").alias("rep")), "prints")
    equal = some.join(first.hint("merge"), "fp").where("node != rep").select("node", F.col("rep").alias("centre"))
    return equal.unionByName(fingerprint_links(first, radius).select(F.col("u").alias("node"), F.col("v").alias("centre")))


def grams(texts: DataFrame) -> DataFrame:
    """(node, grams): the distinct shingles of each row (node, text), sorted."""
    arrow_batches(texts.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for begin, count in slices(batch.column(1)):
                hashes, to = shingles(batch.column(1).slice(begin, count))
                out += [np.unique(hashes[a:b]).tobytes() for a, b in zip(to[:-1], to[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "grams"])
        release()

    return texts.select("node", "text").mapInArrow(run, "node long, grams binary")


def alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (node, centre) whose sets have a Jaccard similarity of least or more."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                shared = 0
                if len(small) >= least * len(large):
                    shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                keep.append(shared >= least * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["node", "centre"]).filter(pa.array(keep, pa.bool_()))
        release()

    own = sets.hint("merge")
    both = pairs.join(own.withColumnRenamed("grams", "a"), "node").join(own.select(F.col("node").alias("centre"), F.col("grams").alias("b")), "centre")
    return both.select("node", "centre", "a", "b").mapInArrow(run, "node long, centre long")


def rarity(sets: DataFrame) -> np.ndarray:
    """How many texts of sets (node, grams) have a shingle, counted by its upper RARITY_BITS bits: 1 MB whatever the corpus."""

    def run(batches):
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for grams in batch.column(0):
                counts += np.bincount(places(np.frombuffer(grams.as_buffer(), np.uint64)), minlength=len(counts))
        if counts.any():
            blocks = counts.reshape(-1, RARITY_BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        made = sum(np.frombuffer(c.as_buffer(), np.int64) for c in rows.column("counts"))
        return pa.table({"block": rows.column("block").slice(0, 1), "counts": pa.array([made.tobytes()], pa.binary())})

    schema = "block int, counts binary"
    rows = sets.select("grams").mapInArrow(run, schema).groupBy("block").applyInArrow(add, schema).collect()  # a row a block
    counts = np.zeros((1 << RARITY_BITS) // RARITY_BLOCK * RARITY_BLOCK, np.int32)
    for r in rows:
        counts[r.block * RARITY_BLOCK : (r.block + 1) * RARITY_BLOCK] = np.minimum(np.frombuffer(r.counts, np.int64), np.iinfo(np.int32).max)
    return counts


def places(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(token, node, size, at, small): the rarest shingles of each text of sets (node, grams), with their places from 0 in the order of rarity.

    Texts of a similarity of least or more share at least one of them, and one that is `small` in the smaller text. Shingles of a single text are left out.
    """
    counts = rarity(sets)

    def run(batches):
        for batch in batches:
            rows = [[], [], [], [], []]
            for node, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams = np.frombuffer(value.as_buffer(), np.uint64)
                seen, n = counts[places(grams)], len(grams)
                order = np.lexsort((grams, seen))[: n - int(np.ceil(least * n - 1e-9)) + 1]
                at = np.flatnonzero(seen[order] > 1)
                small = at < n - int(np.ceil(2 * least / (1 + least) * n - 1e-9)) + 1
                for column, values in zip(rows, (grams[order[at]].view(np.int64), np.full(len(at), node), np.full(len(at), n), at, small)):
                    column.append(values)
            arrays = [pa.array(np.concatenate(c).astype(t)) for c, t in zip(rows, (np.int64, np.int64, np.int32, np.int32, np.bool_))] if rows[0] else []
            if arrays:
                yield pa.RecordBatch.from_arrays(arrays, names=["token", "node", "size", "at", "small"])

    return sets.select("node", "grams").mapInArrow(run, "token long, node long, size int, at int, small boolean")


def by_rare_shingles(sets: DataFrame, least: float) -> DataFrame:
    """(node, centre): the pairs of sets (node, grams) that may have a similarity of least or more, each once; no such pair is missing.

    In one order of all shingles, rare ones first, two texts of that similarity share a shingle near the beginning of both, after which enough
    of both is left for what they must have in common. A shingle of many texts is dealt to several tasks.
    """
    rows = table(prefixes(sets, least), "prefixes")
    crowded = table(rows.groupBy("token").agg(F.ceil(F.count("*") / CROWD).alias("deals")).where("deals > 1"), "crowded").hint("merge")
    known = rows.join(crowded, "token", "left").withColumn("deals", F.coalesce("deals", F.lit(1).cast("long")))
    large = known.select("token", F.pmod(F.xxhash64("node"), F.col("deals")).alias("deal"), "node", F.col("size").alias("n"), "at")
    small = known.where("small").select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"), F.col("node").alias("centre"), F.col("size").alias("m"), F.col("at").alias("to"))
    first = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("centre") < F.col("node")))
    shared = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("to"))  # at most, if this is the first shingle that both have
    enough = (F.col("m") >= least * F.col("n") - 1e-9) & (shared >= least / (1 + least) * (F.col("n") + F.col("m")) - 1e-9)
    met = large.alias("l").join(small.alias("s").hint("merge"), (F.col("l.token") == F.col("s.token")) & (F.col("l.deal") == F.col("s.deal")) & first & enough)
    return met.select("node", "centre").distinct()


def groups(docs: DataFrame, points: DataFrame, least: float = LEAST, repeated: bool = True, prints: DataFrame | None = None) -> DataFrame:
    """(node, rep, group) of points (node, rep, bands): texts joined by links of pairs whose similarity is least or more.

    The pairs prints (node, centre) are compared first; texts that they join are one group from the start and aren't compared again.

    Every band that two texts share holds its members against the smallest of them; those that aren't alike
    are held against the smallest that is left, then against two of those left (CENTRES); texts that are in one group by then count as alike. Texts that
    are left in any band are compared with each other, whatever band they have, where rare shingles let them be alike: none of their links is missed.
    A group of copies of any size costs a few pairs a member, and all links are exact, but a pair can be missed that shares no band, or
    of which one text is like a centre of their band and in a group without the other.
    Only texts that share a band or that prints names are shingled. repeated: whether rows of docs may repeat a doc_id and its text.
    """
    members = points.select(F.explode("bands").alias("u"), F.col("node").alias("v"))
    crowd = least_of_each(members)
    asked = crowd.select(F.col("v").alias("node"))
    if prints is not None:
        prints = table(prints, "print-pairs")
        asked = asked.unionByName(prints.select("node")).unionByName(prints.select(F.col("centre").alias("node")))
    wanted = table(asked.distinct().join(points, "node").select(row_key(F.col("node"), F.col("rep")).alias("row")), "wanted")
    own = docs.select(F.xxhash64("text").alias("node"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = grams(by_keys(own, row_key(F.col("node"), F.col("doc_id")), wanted))
    sets = table(made.dropDuplicates(["node"]) if repeated else made, "grams")
    links, known = None, None
    if prints is not None:
        links = table(alike(prints, sets, least), "alike")
        known = linked(links)
    for n, centres in enumerate(CENTRES):
        if n and crowd.isEmpty():
            break
        if n:
            known = linked(links)
        held = crowd.where("v != m").select("u", F.col("v").alias("node"), F.col("m").alias("centre"), F.lit(False).alias("met"))
        if known is not None:  # texts that earlier rounds put into one group needn't be compared
            a, b = known.select("node", F.col("component").alias("a")), known.select(F.col("node").alias("centre"), F.col("component").alias("b"))
            met = F.coalesce("a", "node") == F.coalesce("b", "centre")
            held = table(held.join(a, "node", "left").join(b, "centre", "left").select("u", "node", "centre", met.alias("met")), "held")
        found = table(alike(held.where("not met").select("node", "centre").distinct(), sets, least), "alike")
        links = found if links is None else links.unionByName(found)
        left = held.join(links.distinct().withColumn("like", F.lit(True)).hint("merge"), ["node", "centre"], "left")
        left = left.groupBy("u", "node").agg(F.max(F.coalesce("like", "met")).alias("like")).where("not like").select("u", F.col("node").alias("v"))
        if centres > 1:  # a centre is held against the others
            left = left.join(crowd.select("u", F.col("m").alias("v")).distinct(), ["u", "v"], "left_anti")
        before, crowd = crowd, least_of_each(left, CENTRES[n + 1] if n + 1 < len(CENTRES) else 1)
        drop_table(before)
    if not crowd.isEmpty():
        rest = table(sets.hint("merge").join(crowd.select(F.col("v").alias("node")).distinct(), "node"), "rest")
        links = links.unionByName(table(alike(by_rare_shingles(rest, least), rest, least), "alike"))
    joined = linked(links).withColumnRenamed("component", "group")
    for old in (crowd, wanted, sets):
        drop_table(old)
    return points.select("node", "rep").join(joined.hint("merge"), "node", "left").withColumn("group", F.coalesce("group", "node"))


def linked(links: DataFrame) -> DataFrame:
    """(node, component) of the texts of links (node, centre), written."""
    return table(components(links.select(F.col("node").alias("u"), F.col("centre").alias("v"))), "known")


def least_of_each(members: DataFrame, centres: int = 1) -> DataFrame:
    """members (u: a band, v: a text) of bands with two or more, each with m, the smallest v; written. A band of very many members is dealt to several tasks.

    With several centres a band's members fall into so many classes by a hash, and each member comes once with the smallest v of every class.
    """
    if centres == 1:
        known, low = with_least(members, few=2)
    else:
        several = members.withColumn("class", F.explode(F.sequence(F.lit(0), F.lit(centres - 1))))
        edges = several.select(F.xxhash64("u", "class").alias("u"), "v", F.col("u").alias("band"), (F.pmod(F.xxhash64("v"), F.lit(centres)) == F.col("class")).alias("own"))
        known, low = with_least(edges, few=2, own=F.col("own"), more=("band",))
        known = known.select(F.col("band").alias("u"), "v", "m")
    crowd = table(known, "crowd")
    drop_table(low)
    return crowd


def row_key(node: Column, doc_id: Column) -> Column:
    return F.xxhash64(node, doc_id)


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs with one row of each group of near copies: the one with the smallest doc_id, null ids last.

    Copies are texts with equal 64-bit hashes, and texts linked by pairs whose distinct five-word shingles have a Jaccard
    similarity of least or more: pairs that operator 2's fingerprints link, then those that share a band. Texts without words are copies of equal ones only. Of rows that
    repeat a doc_id and its text one stays. Texts aren't shuffled as long as the keys of the rows that go can be broadcast
    (by_keys): they are read for their sketches, those of candidates for their shingles, and the kept ones for the result.
    """
    own = table(sketches(docs), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    points = table(own.groupBy("node").agg(F.min(first).alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands")).select("node", F.col("first.id").alias("rep"), "fp", "bands"), "points")
    tally = table(own.groupBy(row_key(F.col("node"), F.col("doc_id")).alias("row")).agg(F.count("*").alias("n")), "tally")
    named = groups(docs, points, least, not tally.where("n > 1").isEmpty(), near_prints(points))
    best = named.groupBy("group").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("rep"), F.col("node").alias("node"))).alias("best"))
    kept = best.select(row_key(F.col("best.node"), F.col("best.rep")).alias("row"), F.lit(True).alias("stays"))
    marked = table(tally.join(kept.hint("merge"), "row", "left").where("stays is null or n > 1"), "marked")
    for old in (own, points, tally):
        drop_table(old)
    key = row_key(F.xxhash64("text"), F.col("doc_id").cast("long"))
    rows = by_keys(docs, key, marked.select("row"), "left_anti")
    again = marked.where("stays").select("row")
    if again.isEmpty():
        return rows
    whole = free_name(docs, "row")
    several = by_keys(docs, key, again).select(key.alias("key"), F.struct("*").alias(whole))
    return rows.unionByName(several.groupBy("key").agg(F.first(whole).alias(whole)).select(f"{whole}.*"))
