"""Operator 3: documents that contain benchmark items, found by the q-gram lemma and checked by alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, by_keys, drop_table, release, table
from .textbytes import BREAK, LOWER, ROOTS, buffer_of, mixed, range_hashes, slices

Q, BUDGET = 10, 0.08
LEAST_Q = 6  # floor(n / (edits + 1)) is at least 6 for every length n with edits, at a budget of 0.08
BLOCK_BYTES = 8 << 20  # benchmark text that one pass over the documents holds
TABLE_BITS = 24  # of a table of q-grams at most; a small benchmark has a smaller one
SLICE_BYTES = 1 << 19  # of texts whose q-grams are laid out at a time
ALIGNED_CELLS, FAR = 1 << 18, 1 << 28
REGION_BYTES = 4 << 20  # of texts that are aligned at a time
POSTINGS = 1 << 18  # shared q-grams that are laid out at a time


def normalised(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case A-Z and take runs of blanks as one blank: bytes, where texts begin, and each byte's place in body."""
    blank = BREAK[body]
    first = np.zeros(len(body) + 1, bool)
    first[at] = True
    keep = np.flatnonzero(~blank | ~np.concatenate([[False], blank])[: len(body)] | first[: len(body)])
    out = LOWER[body[keep]]
    out[blank[keep]] = 32
    return out, np.searchsorted(keep, at), keep


def gram_hashes(body: np.ndarray, q: int) -> np.ndarray:
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * ROOTS[0])
    first = np.arange(max(0, len(body) - q + 1))
    return mixed(range_hashes(letters[body], first, first + q, ROOTS[0]))


def trimmed(text: str) -> np.ndarray:
    """Normalised bytes of an item without blanks at its ends."""
    body, at = buffer_of(pa.array([text]))
    body = normalised(body, at)[0]
    inner = np.flatnonzero(body != 32)
    return body[inner[0] : inner[-1] + 1] if len(inner) else body[:0]


def indexes(items: list[tuple[int, str]], q: int = Q, budget: float = BUDGET) -> list[ItemIndex]:
    """Indexes of a block of items by the longest q-grams, of q or fewer bytes, that their edit budgets leave in every match.

    Items of n bytes with floor(budget * n) edits share a q-gram with each match if q * (edits + 1) <= n. Those for which
    q is too long have an index of shorter ones.
    """
    known = [(name, body, int(budget * len(body))) for name, body in ((name, trimmed(text)) for name, text in items) if len(body)]
    groups: dict[int, list] = {}
    for name, body, edits in known:
        fits = len(body) // (edits + 1)
        groups.setdefault(q if fits >= q or not edits else min(q, max(1, fits if fits < LEAST_Q else LEAST_Q)), []).append((name, body, edits))
    return [ItemIndex(group, size) for size, group in sorted(groups.items())]


class ItemIndex:
    """Every q-gram of items (name, bytes, edits), and each item's least count of shared q-grams."""

    def __init__(self, items: list[tuple[int, np.ndarray, int]], q: int):
        self.q, self.names, self.texts = q, [n for n, _, _ in items], [t for _, t, _ in items]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([e for _, _, e in items], np.int64)
        self.least = sizes + 1 - q * (self.edits + 1)
        self.short = [i for i, n in enumerate(self.least) if n < 1]  # shorter than q: found as they are
        hashes = [gram_hashes(t, q) for t in self.texts]
        owner = np.concatenate([np.full(len(h), i) for i, h in enumerate(hashes)] or [np.empty(0, int)]).astype(np.int64)
        place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.empty(0, int)]).astype(np.int64)
        grams = np.concatenate(hashes or [np.empty(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        bits = min(TABLE_BITS, max(8, len(self.grams).bit_length() + 5))  # 1 of 32 places is taken, of the largest table more
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.grams >> self.shift] = True
        self.spread = int(sizes.max(initial=0) * 2 + 2)

    def bands(self, doc: np.ndarray, near: np.ndarray, k: np.ndarray):
        """((text, item, band) columns, shared q-grams in each) of text q-grams at `near` that are the index's k-th, POSTINGS at a time.

        A match's diagonals differ by its edits at most: one of two bands of width 2 * (edits + 1) that overlap there has them all.
        """
        keys, counts = np.empty((3, 0), np.int64), np.empty(0, np.int64)
        times = self.count[k]
        before = np.concatenate([[0], np.cumsum(times)])
        for lo in range(0, int(before[-1]), POSTINGS):
            hi = min(lo + POSTINGS, int(before[-1]))
            nth = np.arange(lo, hi)
            gram = np.searchsorted(before, nth, side="right") - 1
            post = self.first[k[gram]] + nth - before[gram]
            item = self.owner[post]
            band = (near[gram] + doc[gram] * self.spread - self.place[post]) // (self.edits[item] + 1)
            both = np.concatenate([keys, np.stack([doc[gram], item, band]), np.stack([doc[gram], item, band - 1])], axis=1)
            weight = np.concatenate([counts, np.ones(2 * (hi - lo), np.int64)])
            order = np.lexsort(both[::-1])
            both = both[:, order]
            begin = np.flatnonzero(np.concatenate([[True], (both[:, 1:] != both[:, :-1]).any(axis=0)]))
            keys, counts = both[:, begin], np.add.reduceat(weight[order], begin)
        return keys, counts

    def regions(self, body: np.ndarray, at: np.ndarray):
        """(text, item, first byte, end) of the bands of diagonals that share enough q-grams with an item; they may reach beyond the text."""
        hashes = gram_hashes(body, self.q)
        near = np.flatnonzero(self.table[hashes >> self.shift])
        k = np.searchsorted(self.grams, hashes[near])
        same = (k < len(self.grams)) & (self.grams[np.minimum(k, len(self.grams) - 1)] == hashes[near]) if len(self.grams) else np.zeros(0, bool)
        near, k = near[same], k[same]
        doc = np.searchsorted(at, near, side="right") - 1
        whole = near + self.q <= at[doc + 1]
        keys, counts = self.bands(doc[whole], near[whole], k[whole])
        for d, i, b in keys[:, counts >= np.maximum(self.least[keys[1]], 1)].T.tolist():
            edits = int(self.edits[i])
            low = b * (edits + 1) - d * self.spread - edits
            # up to `edits` places beyond the text, so that the band has the diagonals of deletions at its edges
            yield d, i, max(int(at[d]) - edits, low), min(int(at[d + 1]) + edits, low + 4 * (edits + 1) + len(self.texts[i]))

    def found(self, body: np.ndarray, at: np.ndarray):
        """(text, item, edits, first byte, end), the closest region of each text and item."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        run, held = [], 0
        for one in self.regions(body, at):
            run.append(one)
            held += one[3] - one[2]
            if held >= REGION_BYTES:
                self.closest(run, body, at, best)
                run, held = [], 0
        self.closest(run, body, at, best)
        plain = body.tobytes() if self.short else b""
        for i in self.short:
            one, place = self.texts[i].tobytes(), -1
            while (place := plain.find(one, place + 1)) >= 0:
                d = int(np.searchsorted(at, place, side="right")) - 1
                if place + len(one) <= at[d + 1]:
                    best.setdefault((d, i), (0, place, place + len(one)))
        return [(d, i, *v) for (d, i), v in best.items()]

    def closest(self, near: list, body: np.ndarray, at: np.ndarray, best: dict) -> None:
        """Puts the closest places of these regions, as far as they are within the items' edits, into best."""
        edits, ends = align([self.texts[i] for _, i, _, _ in near], [padded(body, at, d, low, high) for d, _, low, high in near])
        near = [(*n, e, x) for n, e, x in zip(near, edits, ends) if e <= self.edits[n[1]]]
        _, begins = align([self.texts[n[1]][::-1] for n in near], [padded(body, at, n[0], n[2], n[3])[::-1] for n in near])
        for (d, i, low, high, e, end), back in zip(near, begins):
            best[d, i] = min(best.get((d, i), (1 << 30, 0, 0)), (e, max(int(at[d]), high - back), min(int(at[d + 1]), low + end)))


def padded(body: np.ndarray, at: np.ndarray, d: int, low: int, high: int) -> np.ndarray:
    """body[low:high], with 256 for each place outside text d: it matches no byte, so an item's byte there is a deleted one."""
    first, end = max(low, int(at[d])), min(high, int(at[d + 1]))
    out = np.full(high - low, 256, np.int16)
    out[first - low : end - low] = body[first:end]
    return out


def align(items: list[np.ndarray], regions: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """For each item and its region: fewest edits that turn the item into a part of the region, and where that part
    ends, over the band of diagonals that the region allows. Pairs advance together, the longest items first, as many as ALIGNED_CELLS allows."""
    edits, ends = [0] * len(items), [0] * len(items)
    widths = [max(1, len(r) - len(t) + 1) for t, r in zip(items, regions)]
    order, first = sorted(range(len(items)), key=lambda k: -len(items[k])), 0
    while first < len(order):
        longest, last, width = len(items[order[first]]), first, 0
        while last < len(order) and (last == first or (last + 1 - first) * (longest + max(width, widths[order[last]])) <= ALIGNED_CELLS):
            width, last = max(width, widths[order[last]]), last + 1
        pairs, first = order[first:last], last
        letters, text = np.full((longest, len(pairs)), 257, np.int16), np.full((len(pairs), longest + width), 256, np.int16)
        for n, k in enumerate(pairs):
            letters[: len(items[k]), n] = items[k]
            held = regions[k][: longest + width]
            text[n, : len(held)] = held
        steps = np.arange(width, dtype=np.int32)
        floor = np.where(steps[None, :] < np.array([widths[k] for k in pairs])[:, None], 0, FAR).astype(np.int32)
        row, left = floor.copy(), len(pairs)
        for i in range(longest):
            while len(items[pairs[left - 1]]) <= i:
                left -= 1
            now = row[:left]
            moved = now + (text[:left, i : i + width] != letters[i, :left, None])
            np.minimum(moved[:, :-1], now[:, 1:] + 1, out=moved[:, :-1])
            moved = np.minimum.accumulate(moved - steps, axis=1) + steps
            row[:left] = np.maximum(moved, floor[:left])
        at = row.argmin(axis=1)
        for n, k in enumerate(pairs):
            edits[k], ends[k] = int(row[n, at[n]]), min(len(regions[k]), len(items[k]) + int(at[n]))
    return edits, ends


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, budget: float = BUDGET, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, start, end): documents that contain an item within `budget` edits per byte.

    Both are compared with A-Z in lower case and runs of blanks as one; edits are counted in UTF-8 bytes, start and
    end are code points of the text. A row is the closest place of one item in one document row. Items are
    taken in blocks of at most about block_bytes, each held by every task of one pass, so a benchmark of any size
    fits. Items without words and null texts match nothing. An item of n bytes is allowed floor(budget * n) edits. Rows of documents and items
    that repeat are reported each; of equally close places of an item in a text the first one. Other columns of both tables are not read.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // block_bytes))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in range(blocks):
        held = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()]
        shared = spark.sparkContext.broadcast(sorted(held, key=str))

        def run(batches, shared=shared):
            release()  # what the worker's earlier stages left
            made = indexes(shared.value, q, budget)
            for batch in batches:
                names, rows = batch.column(0).to_pylist(), []
                for first, count in slices(batch.column(1), SLICE_BYTES):
                    raw, raw_at = buffer_of(batch.column(1).slice(first, count))
                    body, at, origin = normalised(raw, raw_at)
                    for name, (d, _, edits, begin, end) in ((index.names[hit[1]], hit) for index in made for hit in index.found(body, at)):
                        start_byte = origin[begin] if begin < len(origin) else len(raw)
                        text = raw[raw_at[d] : origin[end - 1] + 1]
                        points = np.cumsum((text & 0xC0) != 0x80)
                        skip = int(start_byte - raw_at[d])
                        rows.append((names[first + d], name, edits, int(points[skip - 1]) if skip else 0, int(points[-1])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "item_id", "edits", "start", "end"])
            release()

        hits = texts.mapInArrow(run, "doc_id long, item_id long, edits long, start long, end long")
        out = hits if out is None else out.unionByName(hits)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs but the rows whose text contains a benchmark item; all columns stay. Null texts stay, and all rows where there are no items."""
    key = F.xxhash64("doc_id", "text")
    found = table(leaks(docs.select(key.alias("doc_id"), "text"), benchmark).select("doc_id"), "leaks")
    gone = table(found.distinct(), "leaks")
    drop_table(found)
    return by_keys(docs, key, gone, "left_anti")
