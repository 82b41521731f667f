"""What a worker holds at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from screenloom.llm import decontaminate
from screenloom.llm.textbytes import buffer_of, slices


def test_leaks_are_searched_in_little_memory():
    """4 MB of texts are searched in less than 48 MB, tables of the items' q-grams included, and planted items are found whatever the slices."""
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(2200)]
    items = [(i, " ".join(rng.choice(words, 20))) for i in range(200)]
    for i in range(0, 200, 10):
        texts[i * 11] += " " + items[i][1] + " " + texts[0]
    column = pa.array(texts)
    tracemalloc.start()
    found = set()
    for index in decontaminate.indexes(items):
        for first, count in slices(column, decontaminate.SLICE_BYTES):
            body, at, _ = decontaminate.normalised(*buffer_of(column.slice(first, count)))
            found |= {(first + hit[0], index.names[hit[1]], hit[2]) for hit in index.found(body, at)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(i * 11, i, 0) for i in range(0, 200, 10)} <= found
    assert peak < 48 << 20
