"""Operator 12 - divergence audit of sources over a K-squared quadtree.

Per language, the matrix has a row for each source and a column for each kept
term; a cell holds how often the source uses the term. All pairs of rows are
compared over all columns, and each row's most telling terms are reported.

* Counting. Tasks take whole texts in slices, cut them into terms (numpy) and
  count them per (language, source) through an Arrow dictionary, which compares
  the terms themselves; Spark adds the slices up, partially before its
  shuffle. A hot source or term costs a row per task.
* Blocks. The matrix of a language is dealt out in blocks of columns (by hash
  of the term) and, beyond ``ROWS`` sources, pairs of row blocks, so many that
  cells times rows of a block are about ``WORK``. Every block has a row for each
  of its sources, also for those without a cell in it; with several row blocks
  every block also has each of its terms that only other row blocks use.
* Quadtree. A block's cells make a tree of bitmaps, each of a quarter of the
  bits of the next. A pair of rows is traversed jointly: where both quadrants
  are all zero, every pair of rows in them has the value of two zero counts, so
  their width is added to the pairs' zero columns and nothing below is
  visited; at the leaves, cells that at least one of the two has are priced
  one by one. Zero columns times the zero value complete a pair's sum.

Shares are integers, floor(10^9 (count + 2) / (N + 2 V)) + 1, by long division
in 64 bits (exact while N + 2 V is under 9 * 10^15).

Defined results: null text, lang and source are ''; sources without any kept
term take part (all counts 0); a language without kept terms gives pairs of
value 0; a single source has no pairs; repeated rows are documents of their
own; an empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgecast.llm import common as C
from surgecast.operators.joins import as_side

K = 2
ROWS = 256  # sources of a row block, about
WORK = 1 << 20  # cells times rows of a block, about
PIECE = 1 << 17  # quadrants expanded at once
MIN_DOCS = 10
TOP = 10
SLICE = 4 << 20

_COUNTS = "lang string, source string, term string, c long, d long"
_VALUES = "lang string, source string, part string, item string, value long"
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


# ------------------------------------------------------------------- counting


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts, A-Z lower-cased, and the row each is from."""
    data, offsets = C.text_bytes(column)
    low = C.fold(data)
    inside = _LETTER[low]
    edge = offsets[:-1][np.diff(offsets) > 0]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[edge] = inside[edge]
    start = np.flatnonzero(starts)
    size = np.add.reduceat(inside, start, dtype=np.int64) if len(start) else np.zeros(0, np.int64)
    # reduceat runs up to the next term's start: only letters count, and no
    # letters lie between two terms
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(low[inside]))
    return terms, np.searchsorted(offsets, start, "right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: occurrences and documents of each (lang, source, term)."""
    for piece in C.text_slices(batches, limit=SLICE):
        terms, row = terms_of(piece.column("text"))
        if not len(terms):
            continue
        coded = terms.dictionary_encode()
        names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        width = len(names)
        lang, source = piece.column("lang").dictionary_encode(), piece.column("source").dictionary_encode()
        many = len(source.dictionary)
        group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * many + source.indices.to_numpy(zero_copy_only=False)
        once, times = np.unique(row * width + code, return_counts=True)
        key = group[once // width] * width + once % width
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key = key[at]
        of, docs = key // width, np.diff(np.append(at, len(times)))
        cols = [lang.dictionary.take(pa.array(of // many)), source.dictionary.take(pa.array(of % many)), names.take(pa.array(key % width)).cast(pa.string()), pa.array(np.add.reduceat(times, at)), pa.array(docs)]
        yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "c", "d"])


def kept_cells(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, c, total, new) of the kept terms; ``total`` is the
    language's count, ``new`` is 1 in one cell of each term."""
    counts = docs.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    seen = counts.withColumn("docs", F.sum("d").over(term)).withColumn("total", F.sum("c").over(term))
    seen = seen.withColumn("new", (F.row_number().over(term.orderBy("source")) == 1).cast("long"))
    return seen.where(F.col("docs") >= min_docs).select("lang", "source", "term", "c", "total", "new")


# ------------------------------------------------------------------- quadtree


def share(count: np.ndarray, n, v) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), digit groups at a time."""
    whole = np.asarray(n, np.int64) + 2 * np.asarray(v, np.int64)
    rest, out = np.asarray(count, np.int64) + 2, np.int64(0)
    out, rest = rest // whole, rest % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Quadtree:
    """Bitmaps of a 0/1 matrix: level h is the matrix, level l - 1 has a bit
    for each K x K quadrant of level l that is not all zero."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, shape: tuple[int, int]):
        self.shape = shape
        self.height = 0
        while K**self.height < max(*shape, 1):
            self.height += 1
        self.bits = []
        for level in range(self.height + 1):
            s = self.side(level)
            bits = np.zeros((-(-shape[0] // s), -(-shape[1] // s)), bool)
            bits[rows // s, cols // s] = True
            self.bits.append(bits)

    def side(self, level: int) -> int:
        return K ** (self.height - level)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Joint traversal of all pairs of rows i <= j: (zero, i, j, col) with
        ``zero[i, j]`` the number of columns where both are zero, and the
        cells where at least one of them is not."""
        rows, cols = self.shape
        i = j = c = np.zeros(1 if self.bits[0].any() else 0, np.int32)
        zero = np.full((1, 1), 0 if len(i) else cols, np.int64)
        for level in range(1, self.height + 1):
            bits, side = self.bits[level], self.side(level)
            zero = np.repeat(np.repeat(zero, K, 0), K, 1)[: bits.shape[0], : bits.shape[0]]
            alive = [(i[:0], j[:0], c[:0])]
            for lo in range(0, len(i), PIECE):
                a, b, q = (np.repeat(x[lo : lo + PIECE] * K, K**3).reshape(-1, K, K, K) for x in (i, j, c))
                step = np.arange(K, dtype=np.int32)
                a, b, q = ((a + step[:, None, None]).ravel(), (b + step[:, None]).ravel(), (q + step).ravel())
                real = (a <= b) & (b < bits.shape[0]) & (q < bits.shape[1])
                a, b, q = a[real], b[real], q[real]
                live = bits[a, q] | bits[b, q]
                none = ~live
                width = np.minimum((q[none].astype(np.int64) + 1) * side, cols) - q[none].astype(np.int64) * side
                np.add.at(zero, (a[none], b[none]), width)
                alive.append((a[live], b[live], q[live]))
            i, j, c = (np.concatenate(x) for x in zip(*alive))
        return zero, i, j, c


def _price(table: pa.Table, top: int) -> pa.Table:
    """One block: partial sums of its pairs of sources, and its sources' best
    terms."""
    groups, cells = table.filter(pc.is_null(table["term"])), table.filter(pc.is_valid(table["c"]))
    unused = table.filter(pc.and_(pc.is_valid(table["term"]), pc.is_null(table["c"])))["term"]
    groups = groups.sort_by([("rb", "ascending"), ("source", "ascending")])
    names = groups["source"].combine_chunks()
    ints = {k: groups[k].to_numpy().astype(np.int64) for k in ("rb", "n", "v", "whole", "a", "b")}
    n, rb, first, second = ints["n"], ints["rb"], int(ints["a"][0]), int(ints["b"][0])
    v, whole = int(ints["v"][0]), int(ints["whole"][0])
    terms = pa.chunked_array([*cells["term"].chunks, *unused.chunks], pa.string())
    coded = terms.combine_chunks().dictionary_encode()
    row = pc.index_in(cells["source"], value_set=names).to_numpy().astype(np.int64)
    col = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[: len(cells)]
    count = cells["c"].to_numpy().astype(np.int64)
    width = len(coded.dictionary)
    r, j = np.triu_indices(len(names), 1)
    value = np.zeros((len(names), len(names)), np.int64)
    if width:
        none = share(np.zeros(len(names), np.int64), n, v)
        p = np.repeat(none[:, None], width, 1)
        p[row, col] = share(count, n[row], v)
        zero, a, b, q = Quadtree(row, col, (len(names), width)).pairs()
        np.add.at(value, (a, b), apart(p[a, q], p[b, q]))
        value[r, j] += zero[r, j] * apart(none[r], none[j])
    if first != second:
        use = (rb[r] == first) & (rb[j] == second)
        r, j = r[use], j[use]
    out = {"source": [names.take(pa.array(r)), names.take(pa.array(j))], "item": [names.take(pa.array(j)), names.take(pa.array(r))]}
    values, parts = [value[r, j], value[r, j]], ["pair"] * (2 * len(r))
    if width and first == second:
        q = share(cells["total"].to_numpy().astype(np.int64), whole, v)
        mine = p[row, col]
        over = np.flatnonzero(mine > q)
        worth = apart(mine[over], q[over])
        place = np.empty(width, np.int64)
        place[pc.sort_indices(coded.dictionary.cast(pa.large_binary())).to_numpy()] = np.arange(width)
        order = np.lexsort((place[col[over]], -worth, row[over]))
        over, worth = over[order], worth[order]
        from_ = np.searchsorted(row[over], row[over])
        best = np.arange(len(over)) - from_ < top
        over, worth = over[best], worth[best]
        out["source"].append(names.take(pa.array(row[over])))
        out["item"].append(coded.dictionary.take(pa.array(col[over])))
        values.append(worth)
        parts += ["term"] * len(over)
    source, item = (pa.chunked_array(x, pa.string()) for x in (out["source"], out["item"]))
    lang = pa.array([table["lang"][0].as_py()] * len(parts), pa.string())
    return pa.table({"lang": lang, "source": source, "part": pa.array(parts, pa.string()), "item": item, "value": pa.array(np.concatenate(values))})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows hold each other
    source of the language and the summed divergence, ``term`` rows the ``top``
    terms that the source uses more than its language does."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang), ("source", source), ("text", text))])
    cells = C.cut(kept_cells(rows, min_docs))
    langs = cells.groupBy("lang").agg(F.sum("new").alias("v"), F.sum("c").alias("whole"), F.count(F.lit(1)).alias("cells"))
    used = cells.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    many = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    groups = rows.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("s", many)
    groups = groups.na.fill(0, ["n", "v", "whole", "cells"])
    blocks = F.ceil(F.col("s") / ROWS).cast("long")
    groups = groups.withColumn("row_blocks", blocks).withColumn("rb", F.pmod(F.xxhash64("source"), F.col("row_blocks")))
    columns = F.ceil(F.col("cells") * F.least(F.col("s"), F.lit(ROWS)) / WORK).cast("long")
    groups = C.cut(groups.withColumn("col_blocks", F.greatest(columns, F.lit(1))).drop("s", "cells"))

    pairs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)).alias("x")
    block = [F.least("rb", "x").alias("a"), F.greatest("rb", "x").alias("b")]
    shape = ["lang", "source", "rb", "n", "v", "whole"]
    every = groups.select(*shape, "row_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("col_blocks") - 1)).alias("cb"))
    empty = [F.lit(None).cast(t).alias(k) for k, t in (("term", "string"), ("c", "long"), ("total", "long"))]
    every = every.select("*", pairs).select(*shape, "cb", *block, *empty)
    full = cells.join(as_side(groups, "sources").for_join(), ["lang", "source"]).withColumn("cb", F.pmod(F.xxhash64("term"), F.col("col_blocks")))
    # a term that neither of two row blocks uses is a zero column of their pairs
    ranks = F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)
    unused = full.where((F.col("new") == 1) & (F.col("row_blocks") > 1)).select("*", F.explode(ranks).alias("a")).select("*", F.explode(ranks).alias("b")).where("a <= b")
    unused = unused.select(*shape, "cb", "a", "b", "term", *empty[1:])
    full = full.select("*", pairs).select(*shape, "cb", *block, "term", "c", "total")
    priced = full.unionByName(every).unionByName(unused).groupBy("lang", "cb", "a", "b").applyInArrow(lambda t: _price(t, top), _VALUES)
    found = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(C.read(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents
), w AS (SELECT r, lang, source, unnest(ts) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10
), vs AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang
), counts AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (SELECT DISTINCT lang, source FROM d
), ns AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL
), p AS (
  SELECT lang, g.source, term, coalesce(c, 0) AS c, total, v, whole,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2)) // CAST(coalesce(n, 0) + 2 * v AS HUGEINT) AS p
  FROM grp AS g JOIN kept USING (lang) JOIN vs USING (lang) LEFT JOIN ns USING (lang, source) LEFT JOIN counts USING (lang, source, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), allpairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), q AS (SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (total + 2)) // CAST(whole + 2 * v AS HUGEINT) AS q FROM p WHERE c > 0
), term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM q WHERE p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM allpairs UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
