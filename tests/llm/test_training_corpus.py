"""The driver makes the features of its training texts a slice at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from surgecast.llm import language_id as L

TEXTS = [" ".join(f"w{(i * 31 + j * 7) % 997}ä" for j in range(40 + i % 300)) for i in range(400)] + ["", "a", " B  c "]


def _peak(make):
    tracemalloc.start()
    try:
        return make(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_slices_give_the_features_of_the_whole():
    f, whole = _peak(lambda: L.Features(pa.array(TEXTS, pa.large_string())))
    c, sliced = _peak(lambda: L.Corpus(TEXTS, limit=1 << 14))
    assert np.array_equal(c.counts, f.words.counts) and np.array_equal(c.size, f.words.end - f.words.start) and np.array_equal(c.hash, f.hash)
    at, was = L.C.ranges(c.start, c.size), L.C.ranges(f.words.start, c.size)
    assert np.array_equal(c.two[at], f.two[was]) and np.array_equal(c.three[at], f.three[was])
    assert all(np.array_equal(a, b) for a, b in zip(c.affixes, f.affixes))
    assert sliced < 0.7 * whole, (sliced, whole)
