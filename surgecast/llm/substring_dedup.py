"""Operator 10 - substring de-duplication by relative Lempel-Ziv parsing.

Documents are factored against the whole collection, held as indexed
reference blocks. A factor is a stretch of words copied from one place of a
document with a smaller id. Every word of a factor of at least ``width``
words is a duplicate.

* Seeds. Every window of ``width`` words has a minimiser: the smallest hash
  among its ``SEED``-word grams. Equal windows have equal minimisers, so the
  minimiser's hash names the reference block that holds all places of a
  window, and neighbouring windows mostly go to one block together (a
  segment). Minimisers that hold over 2^-18 of all windows, found in a first
  pass, are split by the window's own hash.
* Map side. In each chunk of documents only the first owner (smallest id) of
  a window goes to its block; the chunk's later owners become factors at
  once. A passage that a third of all documents hold costs its block one
  entry a chunk.
* Block. The index maps each window to its first owner and place. The
  parse takes the windows of a document in order and lets a factor run while
  the next window's first owner is the next place of the same document; there
  is no choice of the longest match, and no factor under ``width`` words.
* Factor boundaries. Where a factor ends, the next window is looked up anew,
  so factors may overlap, come from other sources and cross segments and
  blocks; per document, overlapping and touching factors are united.

Defined results: null text has no words; null doc_id takes no part (nothing
is removed, nothing is copied from it); rows with equal doc_id do not remove
words of one another; documents of fewer than ``width`` words keep all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C

WIDTH = 50
SEED = 25
CHUNK = 1 << 20  # windows a map task combines at once
PER_TASK = 1_000_000  # windows a block task gets, about

_SEGMENTS = "kind int, block long, head binary, body binary"
_FACTORS = "doc long, th long, start int, size int, src_doc long, src_start int"
_NONE = np.zeros(0, np.uint64)


def _windows(batch: pa.RecordBatch, width: int, seed: int):
    """Windows of the documents that have an id, one document after the other:
    (hash, minimiser, number of windows of each row)."""
    words = C.Words(batch.column("text"))
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    n = np.where(known, np.maximum(words.counts - width + 1, 0), 0)
    if not n.sum():
        return None
    h = words.hashes(lower=False)
    whole = C.gram_hashes(h, width)
    low = C.gram_hashes(h, seed)
    span = width - seed + 1  # grams of a window
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    at = C.ranges(words.first[:-1], n)
    return whole[at], low[at], n


def _report(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Per chunk: the number of windows (key null) and its heavy minimisers."""
    held, n = [], 0

    def flush():
        k, c = C.local_heavy(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array([None, *k.view(np.int64).tolist()], pa.int64()), pa.array([n, *c.tolist()], pa.int64())], ["key", "count"])

    for piece in C.text_slices(batches):
        if got := _windows(piece, width, seed):
            held.append(got[1])
            n += len(got[1])
            if n >= CHUNK:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def _segments(batches: Iterator[pa.RecordBatch], width: int, seed: int, hot: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Chunk by chunk: factors found in the chunk itself (kind 0), and the
    segments of first owners for each block (kind 1)."""
    held, size = [], 0

    def flush():
        n, doc, th = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
        order = np.lexsort((th, doc))
        at = C.ranges((np.cumsum(n) - n)[order], n[order])
        whole = np.concatenate([x[0] for x in held])[at]
        low = np.concatenate([x[1] for x in held])[at]
        held.clear()
        n, doc, th = n[order], doc[order], th[order]
        del order, at
        pos = C.ranges(np.zeros(len(n), np.int64), n).astype(np.int32)
        number = np.repeat(np.arange(len(n), dtype=np.int32), n)
        src = _first_owner(whole)
        mine = doc[number[src]] == doc[number]
        found = _parse(number, doc, th, pos, src, ~mine, width)
        del src
        if len(found[0]):
            yield 0, np.array([0]), [C.blob(_pack(found))], [b""]
        whole, low, pos, number = whole[mine], low[mine], pos[mine], number[mine]
        if not len(whole):
            return
        key = np.where(C.member(low, hot) >= 0, whole, low)
        cut = np.ones(len(key), bool)
        cut[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1]) | (pos[1:] != pos[:-1] + 1)
        at = np.flatnonzero(cut)
        size = np.diff(np.append(at, len(key)))
        block = (C.mix(key[at]) % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        at, size, block = at[order], size[order], block[order]
        head = np.zeros(len(at), _HEAD)
        head["doc"], head["th"], head["start"], head["n"] = doc[number[at]], th[number[at]], pos[at], size
        body = whole[C.ranges(at, size)]
        names, lo = np.unique(block, return_index=True)
        hi = np.append(lo[1:], len(block))
        words = np.concatenate(([0], np.cumsum(size)))
        yield 1, names, [C.blob(head[a:b]) for a, b in zip(lo, hi)], [C.blob(body[words[a] : words[b]]) for a, b in zip(lo, hi)]

    def rows(kind, names, heads, bodies):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(names), kind, np.int32)), pa.array(names, pa.int64()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], ["kind", "block", "head", "body"])

    for piece in C.text_slices(batches):
        if got := _windows(piece, width, seed):
            has = got[2] > 0
            ids, ths = (C.ids_of(piece.column(c).fill_null(0))[has] for c in ("doc_id", "th"))
            held.append((*got[:2], got[2][has], ids, ths))
            size += len(got[0])
            if size >= CHUNK:
                for part in flush():
                    yield rows(*part)
                size = 0
    if size:
        for part in flush():
            yield rows(*part)


_HEAD = np.dtype([("doc", "<i8"), ("th", "<i8"), ("start", "<i4"), ("n", "<i4")])
_FOUND = np.dtype([("doc", "<i8"), ("th", "<i8"), ("start", "<i4"), ("size", "<i4"), ("src_doc", "<i8"), ("src_start", "<i4")])


def _pack(found) -> np.ndarray:
    out = np.zeros(len(found[0]), _FOUND)
    for name, a in zip(_FOUND.names, found):
        out[name] = a
    return out


def _first_owner(whole: np.ndarray) -> np.ndarray:
    """The index: for each window the entry of the smallest document that
    holds it, at its first place there. Entries come sorted by document and
    position."""
    order = np.argsort(whole, kind="stable")
    ordered = whole[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    del ordered
    src = np.empty_like(order)
    src[order] = np.repeat(order[new], np.diff(np.append(np.flatnonzero(new), len(order))))
    return src


def _parse(number, docs, ths, pos, src, copied, width):
    """Greedy factors over the windows (sorted by document and position;
    ``number`` points into ``docs`` and ``ths``): one runs while the next
    window is copied from the next place of its source."""
    at = np.flatnonzero(copied)
    src = src[at]
    doc, th, src_doc, src_pos, pos = docs[number[at]], ths[number[at]], docs[number[src]], pos[src], pos[at]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (pos[1:] != pos[:-1] + 1) | (src_doc[1:] != src_doc[:-1]) | (src_pos[1:] != src_pos[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at))) + width - 1
    return doc[first], th[first], pos[first], size, src_doc[first], src_pos[first]


def _factor_rows(found) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(a.astype(k.to_pandas_dtype()), k) for a, k in zip(found, kinds)], list(_FOUND.names))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """One task's reference blocks: index their windows, parse, emit factors."""
    heads, bodies = [], []
    for batch in batches:
        local = batch.column("kind").to_numpy(zero_copy_only=False) == 0
        if local.any():
            found = C.unblob(batch.column("head").filter(pa.array(local)), _FOUND)
            yield _factor_rows([found[k] for k in _FOUND.names])
        if (~local).any():
            heads.append(C.unblob(batch.column("head").filter(pa.array(~local)), _HEAD))
            bodies.append(C.unblob(batch.column("body").filter(pa.array(~local)), np.uint64))
    if not heads:
        return
    head, whole = np.concatenate(heads), np.concatenate(bodies)
    del heads, bodies
    at = np.cumsum(head["n"].astype(np.int64)) - head["n"]
    order = np.lexsort((head["start"], head["th"], head["doc"]))
    head, at = head[order], at[order]
    size = head["n"].astype(np.int64)
    whole = whole[C.ranges(at, size)]
    number = np.repeat(np.arange(len(head), dtype=np.int32), size)
    pos = C.ranges(head["start"].astype(np.int64), size).astype(np.int32)
    docs, ths = head["doc"].copy(), head["th"].copy()
    src = _first_owner(whole)
    found = _parse(number, docs, ths, pos, src, docs[number[src]] < docs[number], width)
    if len(found[0]):
        yield _factor_rows(found)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("th"))


def factors(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, th, start, size, src_doc, src_start): the factors of at least
    ``width`` words of each document, in words; ``th`` is the text's hash.
    A factor's source is a document with a smaller id."""
    spark = docs.sparkSession
    seed = max(1, width // 2)
    rows = _keyed(docs)
    report = C.cut(rows.select("doc_id", "text").mapInArrow(C.frugal(lambda b: _report(b, width, seed)), "key long, count long"))
    total = report.where("key is null").agg(F.sum("count")).first()[0] or 0
    hot, _ = C.hot_keys(report.where("key is not null"), total)
    tasks = C.partitions(spark, total, PER_TASK)
    blocks = 8 * tasks
    sent = rows.mapInArrow(C.frugal(lambda b: _segments(b, width, seed, hot, blocks)), _SEGMENTS)
    # factors found in a chunk are spread over all tasks; blocks go by name
    key = F.when(F.col("kind") == 0, F.xxhash64("head")).otherwise(F.col("block"))
    return sent.repartition(tasks, key).mapInArrow(C.frugal(lambda b: _blocks(b, width)), _FACTORS)


def covered(start: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """Which of n words the factors cover."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, start + size, -1)
    return np.cumsum(delta[:n]) > 0


def _cut_words(batches: Iterator[pa.RecordBatch], lines: bool, text: str = "text", at: str = "spans") -> Iterator[pa.RecordBatch]:
    for piece in C.text_slices(batches, text):
        words = C.Words(piece.column(text))
        spans = piece.column(at).to_pylist()
        n_removed, kept, digest = [], [], []
        for i, spanned in enumerate(spans):
            lo, hi = int(words.first[i]), int(words.first[i + 1])
            gone = np.zeros(hi - lo, bool)
            if spanned:
                pairs = np.array([(x["start"], x["size"]) for x in spanned], np.int64)
                gone = covered(pairs[:, 0], pairs[:, 1], hi - lo)
            n_removed.append(int(gone.sum()))
            left = lo + np.flatnonzero(~gone)
            if lines:
                # the separators before a kept word stay as they are
                if not n_removed[-1]:
                    kept.append(piece.column(text)[i].as_py())
                else:
                    d0, d1 = int(words.offsets[i]), int(words.offsets[i + 1])
                    drop = np.zeros(d1 - d0 + 1, np.int64)
                    cut = lo + np.flatnonzero(gone)
                    np.add.at(drop, words.start[cut] - d0, 1)
                    np.add.at(drop, np.append(words.start, len(words.data))[cut + 1].clip(max=d1) - d0, -1)
                    kept.append(words.data[d0:d1][np.cumsum(drop[:-1]) == 0].tobytes().decode("utf-8", "replace").strip(" \t\n\v\f\r"))
            else:
                digest.append(hashlib.sha256(b" ".join(_tokens(words, left))).hexdigest())
        cols = {f: piece.column(f) for f in piece.schema.names if f not in (text, at)}
        if lines:
            cols[text] = pa.array(kept, pa.string())
        else:
            cols |= {"n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        yield pa.RecordBatch.from_pydict(cols)


def _tokens(words: C.Words, at: np.ndarray) -> list[bytes]:
    raw, s, e = words.data.tobytes(), words.start[at].tolist(), words.end[at].tolist()
    return [raw[a:b] for a, b in zip(s, e)]


def _spans(docs: DataFrame, width: int) -> DataFrame:
    """(doc, th, spans): the factors of each document with any. The array is
    bounded by the text's own length, however often the row is repeated: of
    factors that start at one word the longest counts, once."""
    longest = factors(docs, width).groupBy("doc", "th", "start").agg(F.max("size").alias("size"))
    return C.cut(longest.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "size")).alias("spans")))


def _with_spans(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the array of its factors (``spans``, null if none)."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    per = _spans(named, width)
    on = (docs[doc_id].cast("long") == per["doc"]) & (F.xxhash64(docs[text].cast("string")) == per["th"])
    return docs.join(per, on, "left").drop("doc", "th")


def removed_words(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_spans(slim, width).mapInArrow(C.frugal(lambda b: _in_order(_cut_words(b, False), schema)), schema)


def remove_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the duplicate words cut out of ``text``; the separators
    before each kept word stay. Other columns are unchanged."""
    schema, names = docs.schema, [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = _with_spans(docs.toDF(*names), width, doc_id, text)  # no name clashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_order(_cut_words(batches, True, text), None, names):
            yield batch.rename_columns(schema.names)

    return rows.mapInArrow(C.frugal(run), schema)


def _in_order(batches, schema: str | None, names: list[str] | None = None):
    names = names or [x.split()[0] for x in schema.split(", ")]
    for batch in batches:
        yield batch.select(names)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(C.read(spark, sf_dir, "documents"))


ORACLE = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), g AS (
  SELECT doc_id, len(ws) AS n, i, list_aggregate(ws[i : i + 49], 'string_agg', ' ') AS win
  FROM w, unnest(range(1, len(ws) - 48)) AS t(i) WHERE len(ws) >= 50
), f AS (SELECT win, min(doc_id) AS first_doc FROM g GROUP BY win
), s AS (SELECT g.doc_id, g.i FROM g JOIN f USING (win) WHERE f.first_doc < g.doc_id
), c AS (SELECT DISTINCT doc_id, i + j AS p FROM s, unnest(range(0, 50)) AS t(j)
), r AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(list_aggregate(list_filter(ws, lambda x, k: ps IS NULL OR NOT list_contains(ps, k)), 'string_agg', ' '), '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
"""
