"""Words of a batch of texts as byte ranges and hashes, without a loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that part words: blank and \x09-\x0D. UTF-8 has none of them inside another character.
BREAK = np.zeros(256, bool)
BREAK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ROOTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in turn, and where each begins, with the end; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return body, at - at[0]


def word_ranges(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of words before it (with the total)."""
    inside = ~BREAK[body]
    before = np.concatenate([[False], inside])
    first = np.zeros(len(body) + 1, bool)
    first[at] = True  # words don't run on into the next text
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | first))
    ends = np.flatnonzero(before & (~after | first))
    return starts, ends, np.searchsorted(starts, at)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(root: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, root, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, root: np.uint64) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each range of values: alike wherever the range stands."""
    inverse = np.uint64(pow(int(root), -1, 2**64))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(root, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts]


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, root: np.uint64) -> np.ndarray:
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * root)
    return mixed(range_hashes(letters[body], starts, ends, root) + (ends - starts).astype(np.uint64))


def slices(texts: pa.Array, most: int = 2 << 20):
    """Runs of texts of about `most` bytes: (first, count)."""
    sizes = np.diff(buffer_of(texts)[1])
    first, held = 0, 0
    for i, size in enumerate(sizes):
        held += int(size)
        if held >= most:
            yield first, i + 1 - first
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes) - first
