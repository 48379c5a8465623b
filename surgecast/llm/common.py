"""Shared helpers: word boundaries and hashes of whole text columns in numpy,
bounded slices of Arrow batches, lineage cuts, connected components.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, found on the
UTF-8 bytes (separators are single bytes there). A word's hash is 64 bits of a
polynomial over a random byte table, mixed; equality of words is equality of
hashes throughout this subpackage, except where a module compares bytes.
"""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.session import shared_dir

U64 = np.uint64
SLICE_BYTES = 1 << 19
SEPARATORS = bytes([0x20, 9, 10, 11, 12, 13])
WORD = r"[^\x20\x09-\x0D]+"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# --------------------------------------------------------------- Spark helpers


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the cluster's shared folder: the lineage ends
    here, and a lost executor loses nothing. The shuffle files behind it are
    removed at once (Spark's own setting, put back afterwards)."""
    spark = df.sparkSession
    shared_dir(spark)
    saved = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        # the setting is read when a DataFrame is made
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(_CLEAN_UP, saved)


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Shuffle partitions so that a task gets about ``per_task`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // per_task))


def crc_mod5(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5 (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def chunk_names() -> Iterator[int]:
    """Names for the chunks of this task that no other task of its stage
    gives, whatever the chunks hold, and that a retry gives again: partition id
    and running number."""
    task = TaskContext.get()
    return itertools.count((task.partitionId() if task else 0) << 32)


def frugal(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``rows`` as a function for mapInArrow that gives its memory back when
    the task ends. Python workers are used again by later stages, and what
    their allocators keep adds up over a long application."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


# ---------------------------------------------------------- whole texts, numpy


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece has about ``limit`` bytes of text
    (a longer document is a piece of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def lengths(col: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts as empty."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and the offset of each (one more at the
    end); null is empty."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    width = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def ids_of(col: pa.Array) -> np.ndarray:
    return col.cast(pa.int64()).to_numpy(zero_copy_only=False)


_SEP = np.zeros(256, bool)
_SEP[list(SEPARATORS)] = True


class Words:
    """Word positions of some texts: ``start``/``end`` (byte offsets),
    ``first`` (index of each document's first word, one more at the end)."""

    def __init__(self, col: pa.Array):
        self.data, self.offsets = text_bytes(col)
        inside = ~_SEP[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        edge = self.offsets[:-1][np.diff(self.offsets) > 0]
        before[edge] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edge[edge > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool) -> np.ndarray:
        return word_hashes(self.data, self.start, self.end, lower)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z, all other bytes unchanged."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    exact = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
    lower = exact.copy()
    lower[65:91] = exact[97:123]
    step = np.full(1 << 12, 0x9E3779B97F4A7C15 | 1, np.uint64)
    step[0] = 1
    return exact, lower, np.cumprod(step)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool, piece: int = 1 << 18) -> np.ndarray:
    """64-bit hash of every word, in pieces of words so that scratch memory
    stays bounded however long the texts are."""
    out = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), piece):
        s, e = start[lo : lo + piece], end[lo : lo + piece]
        size = np.minimum(e - s, _SHORT + 1).astype(np.uint8)
        # the longest first: the words that have a j-th byte are the first ones
        order = np.argsort(_SHORT + 1 - size, kind="stable")
        counts = np.bincount(size, minlength=_SHORT + 2)
        long, left = order[: counts[-1]], order[counts[-1] :]
        some = out[lo : lo + piece]
        some[long] = _long_hashes(data, s[long], e[long], lower)
        some[left] = _short_hashes(data, s[left], size[left], np.cumsum(counts[_SHORT:0:-1])[::-1], lower)
    return out


_SHORT = 24  # bytes of a word that is hashed byte by byte with the others


def _short_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, live: np.ndarray, lower: bool) -> np.ndarray:
    """Words of at most ``_SHORT`` bytes; the first ``live[j]`` have a j-th."""
    exact, folded, powers = _tables()
    table = folded if lower else exact
    total = size.astype(np.uint64)
    for j, n in enumerate(live.tolist()):
        if not n:
            break
        total[:n] += (table * powers[j])[data[start[:n] + j]]
    return mix(total)


def _long_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    exact, folded, powers = _tables()
    table, size = folded if lower else exact, end - start
    at = np.concatenate(([0], np.cumsum(size)))
    within = np.arange(at[-1]) - np.repeat(at[:-1], size)
    chars = data[within + np.repeat(start, size)]
    # beyond the table of powers the position is folded into the byte's term
    power = powers[within & 4095] if size.max() <= 4096 else powers[within & 4095] + (within >> 12).astype(np.uint64) * U64(0x2545F4914F6CDD1D)
    return mix(np.add.reduceat(table[chars] * power, at[:-1]) + size.astype(np.uint64))


_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words starting at each position (the last k-1 positions
    are left out; documents are not told apart here)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= len(_SPREAD):
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += words[j : j + n] * _SPREAD[j]
        return mix(total)
    return mix(_poly_windows(words, k))


def _poly_windows(words: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each window of k words, by doubling: windows of
    2m words from windows of m."""
    base = 0x9E3779B97F4A7C15
    have, size, out, done = words, 1, None, 0
    n = len(words) - k + 1
    left = k
    while left:
        if left & 1:
            part = have[done : done + n] * U64(pow(base, done, 1 << 64))
            out = part if out is None else out + part
            done += size
        left >>= 1
        if left:
            have = have[:-size] + have[size:] * U64(pow(base, size, 1 << 64))
            size *= 2
    return out


def spread(key: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order that puts equal ``group`` together, and the group bounds."""
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(groups + 1))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + size)``."""
    at = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(at - starts, sizes)


# ------------------------------------------------------- connected components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); component is
    the smallest node reachable. Alternating large and small stars: each step
    is a grouped minimum (combined map-side) and a join back, so no node's
    neighbours are collected; each step ends in a checkpoint. It goes on as long
    as a step changes an edge: every change replaces a node by a smaller one of
    its component, so that the steps come to an end."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e)
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        e = cut(small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct())
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


# -------------------------------------------------------------- heavy hitters

HOT_SHARE = 1 << 18
HOT_LOCAL = 16


def local_heavy(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys found at least ``HOT_LOCAL`` times in a chunk, with their counts."""
    k, c = np.unique(keys, return_counts=True)
    hot = c >= HOT_LOCAL
    return k[hot], c[hot].astype(np.int64)


def hot_keys(reported: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts), sorted by key, of the keys that hold over one
    2^18th of ``total`` entries, from the per-chunk reports (key, count).

    The counts of one key add up to at most ``total``, so there are at most
    2^18 such keys, whatever the input: 4 MB at the driver and in each task.
    A chunk that saw a key fewer than ``HOT_LOCAL`` times does not report it;
    a key that is missed for this has under ``HOT_LOCAL`` entries a chunk.
    """
    least = max(4 * HOT_LOCAL, -(-total // HOT_SHARE))
    rows = reported.groupBy("key").agg(F.sum("count").alias("n")).where(F.col("n") >= least).toPandas()
    rows = rows.sort_values("key") if len(rows) else rows
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


def member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def unblob(col, dtype) -> np.ndarray:
    """All blobs of an Arrow binary column end to end."""
    data, _ = text_bytes(col)
    return np.frombuffer(data.tobytes(), dtype)
