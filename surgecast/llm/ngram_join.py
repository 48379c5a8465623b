"""Operator 1 - n-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word k-grams (k = 5; fewer words: the
whole sequence; A-Z lower-cased). Two documents link when 100 * intersection
>= 80 * union. All tokens have one global order, rare first.

* Prefix rule. A pair of sizes m and n links with an intersection of at
  least a = ceil(80 (m + n) / 180), and then shares at least l tokens within
  the first m - a + l and n - a + l tokens, for every l up to a. A document
  keeps the prefix for its smallest a, ceil(0.8 n); the join cuts both
  prefixes to the a of the pair. Each document picks its own l: a longer
  prefix costs the sum of the document frequencies of its tokens, but a pair
  must then share l of them before it is verified, which leaves about (sum of
  frequencies) / l candidates; the l with the smallest estimate wins. A pair
  is held to the smaller l of its two documents. A match also counts only
  if the intersection can still reach a: one, the fewer of the two documents'
  shared tokens before it, and the fewer of their tokens after it.
* Hot prefix tokens. Documents that hold a token in their prefix differ, for
  the conditions on a match, in four numbers only (size, l, and the token's
  place). Where over ``HOT_TOKEN`` documents hold a token, the conditions are
  tried between these shapes, of which there are few, and only pairs of shapes
  that can match are filled with their documents: a boilerplate that all
  documents have, too short to link them, costs its shapes and no pairs.
* Frequencies. Chunks of documents send (hash, document) to hash blocks;
  only hashes with two or more documents come back. A document whose unshared
  tokens already fill its prefix links with nothing and drops out here. The
  few hashes that hold over 2^-18 of all entries (found in a first pass) are
  never sent: their counts are broadcast and they stand last in the order.
* Hot groups. Equal sets are one class, named by its smallest doc_id. Near
  copies are first compared with a few hubs (members of the same min-hash
  group: the most central one, then random ones); verified links join them
  into components. The prefix join then only looks for links between
  different components, leaving out each token's largest component on one
  side. Pairs inside a component are never listed, and no link between
  components is lost.

Defined results: null or blank text has an empty set, n_shingles 0, and its
own id as component; rows with null doc_id get a null component and take no
part; rows with equal doc_id and different texts are linked with whatever any
of them is linked with only through their text classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C

K = 5
PERCENT = 80
CHUNK = 1 << 21  # shingles a map task combines at once
CHUNK_DOCS = 65_000  # a document's number within its chunk has 16 bits
PER_TASK = 1_500_000  # shingles a block task gets, about
LONGEST = 4  # largest l
VERIFY_COST = 8.0  # of one verification, in postings read
CENTRAL_KEYS, RANDOM_KEYS = 4, 24

_ROWS = "kind int, key long, chunk long, a binary, b binary, c binary"


def _sets(piece: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    words = C.Words(piece.column("text"))
    h = words.hashes(lower=True)
    grams = C.gram_hashes(h, k)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= k:
            out.append(np.unique(grams[lo : hi - k + 1]))
        elif hi > lo:
            out.append(C.mix(C.gram_hashes(h[lo:hi], hi - lo) + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """64 bits that name a set: the wrapped sum of its mixed hashes, with its size."""
    n = np.array([len(s) for s in sets], np.int64)
    at = np.concatenate(([0], np.cumsum(n)))
    # 64-bit integers throughout: the sums wrap, and a set's part of them does
    # not depend on the sets before it
    total = np.zeros(int(at[-1]) + 1, np.uint64)
    if len(sets):
        np.cumsum(C.mix(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    return C.mix((total[at[1:]] - total[at[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64)).view(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Per document (doc_id, n, fp); per chunk its heavy shingles (key, count)."""
    held, size = [], 0
    empty = lambda n: pa.nulls(n, pa.int64())

    def flush():
        keys, counts = C.local_heavy(np.concatenate(held))
        return pa.RecordBatch.from_arrays([*[empty(len(keys))] * 3, pa.array(keys.view(np.int64)), pa.array(counts)], ["doc_id", "n", "fp", "key", "count"])

    for piece in C.text_slices(batches):
        sets = _sets(piece, k)
        n = np.array([len(s) for s in sets], np.int64)
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), pa.array(_fingerprints(sets)), *[empty(len(n))] * 2], ["doc_id", "n", "fp", "key", "count"])
        held += sets
        size += int(n.sum())
        if size >= CHUNK:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _postings(batches: Iterator[pa.RecordBatch], k: int, hot: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Chunk by chunk: the chunk's documents with their hot tokens (kind 0)
    and, per block, hashes with the document's number in the chunk (kind 1)."""
    held, seen, size = [], {}, 0
    names_of_chunks = C.chunk_names()

    def flush():
        sets = held
        fps = np.fromiter(seen, np.int64, len(seen))
        n = np.array([len(s) for s in sets], np.int64)
        chunk = next(names_of_chunks)
        tokens = np.concatenate(sets)
        number = np.repeat(np.arange(len(n)), n)
        at = C.member(tokens, hot)
        is_hot = at >= 0
        hots = np.bincount(number[is_hot], minlength=len(n)).astype(np.int32)
        yield [0], [chunk], chunk, [C.blob(fps)], [C.blob(n.astype(np.int32))], [C.blob(np.concatenate((hots, at[is_hot].astype(np.int32))))]
        tokens, number = tokens[~is_hot], number[~is_hot].astype(np.uint16)
        if not len(tokens):
            return
        block = ((tokens >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        block, tokens, number = block[order], tokens[order], number[order]
        names, lo = np.unique(block, return_index=True)
        cuts = list(zip(lo, np.append(lo[1:], len(block))))
        yield np.ones(len(names), np.int32), names, chunk, [C.blob(tokens[x:y]) for x, y in cuts], [C.blob(number[x:y]) for x, y in cuts], [b""] * len(names)

    def rows(kind, key, chunk, a, b, c):
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array([chunk] * len(a), pa.int64()), *(pa.array(x, pa.binary()) for x in (a, b, c))], ["kind", "key", "chunk", "a", "b", "c"])

    for piece in C.text_slices(batches):
        sets = _sets(piece, k)
        known = piece.column("doc_id").is_valid().to_pylist()
        for s, fp, has_id in zip(sets, _fingerprints(sets).tolist(), known):
            if has_id and len(s) and fp not in seen:
                seen[fp] = True
                held.append(s)
                size += len(s)
                if size >= CHUNK or len(held) >= CHUNK_DOCS:
                    for part in flush():
                        yield rows(*part)
                    held, seen, size = [], {}, 0
    if held:
        for part in flush():
            yield rows(*part)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block: hashes with two or more documents, back to each chunk with their
    document frequency (kind 1: a = hashes, b = numbers, c = frequencies)."""
    chunks, tokens, numbers = [], [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        if (kind == 0).any():
            yield batch.filter(pa.array(kind == 0))
        rest = batch.filter(pa.array(kind == 1))
        if rest.num_rows:
            chunks.append(np.repeat(C.ids_of(rest.column("chunk")), C.lengths(rest.column("a")) // 8))
            tokens.append(C.unblob(rest.column("a"), np.uint64))
            numbers.append(C.unblob(rest.column("b"), np.uint16))
    if not tokens:
        return
    chunk, token, number = np.concatenate(chunks), np.concatenate(tokens), np.concatenate(numbers)
    del chunks, tokens, numbers
    order = np.argsort(token)
    ordered = token[order]
    new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    df = np.diff(np.append(new, len(order)))
    df = np.repeat(df, df)
    order, df = order[df >= 2], df[df >= 2].astype(np.int32)
    back = np.argsort(chunk[order], kind="stable")
    order, df = order[back], df[back]
    chunk, token, number = chunk[order], token[order], number[order]
    names, lo = np.unique(chunk, return_index=True)
    cuts = list(zip(lo, np.append(lo[1:], len(chunk))))
    for i in range(0, len(names), 256):
        part = cuts[i : i + 256]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(part), np.int32)), pa.nulls(len(part), pa.int64()), pa.array(names[i : i + 256])]
            + [pa.array([C.blob(x[a:b]) for a, b in part], pa.binary()) for x in (token, number, df)],
            ["kind", "key", "chunk", "a", "b", "c"],
        )


def prefix_length(n: int, level: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + level


def choose_level(n: int, unshared: int, df: np.ndarray, percent: int = PERCENT) -> int:
    """The l with the smallest estimated cost, for frequencies in token order."""
    most = min(LONGEST, -(-percent * n // 100))
    sums = np.concatenate(([0], np.cumsum(df)))
    costs = []
    for level in range(1, most + 1):
        reach = min(max(prefix_length(n, level, percent) - unshared, 0), len(df))
        costs.append(sums[reach] + VERIFY_COST * sums[reach] / level)
    return 1 + int(np.argmin(costs))


_SEEDS = C.mix(np.arange(1, 1 + CENTRAL_KEYS + RANDOM_KEYS, dtype=np.uint64))
_PROFILE = "fp long, n int, ell int, central double, toks binary, pre array<long>, pos array<int>, hubs array<long>"


def _profiles(batches: Iterator[pa.RecordBatch], hot: np.ndarray, hot_df: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Per chunk: documents that may have a partner, with their shared tokens
    (``toks``, sorted), the prefix (``pre``, with each token's place among all
    tokens of the document from 1, ``pos``), the chosen l and the keys of their hub groups."""
    tables: dict[int, tuple] = {}
    parts: dict[int, list] = {}
    for batch in batches:
        for kind, chunk, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "chunk", "a", "b", "c"))):
            if kind == 0:
                tables[chunk] = (a, b, c)
            else:
                parts.setdefault(chunk, []).append((a, b, c))
    for chunk, (a, b, c) in tables.items():
        fps, ns, hots = np.frombuffer(a, np.int64), np.frombuffer(b, np.int32), np.frombuffer(c, np.int32)
        per, ids = hots[: len(fps)], hots[len(fps) :]
        got = parts.pop(chunk, [])
        token = np.concatenate([np.frombuffer(x[0], np.uint64) for x in got] + [hot[ids]])
        number = np.concatenate([np.frombuffer(x[1], np.uint16) for x in got] + [np.repeat(np.arange(len(fps)), per).astype(np.uint16)])
        df = np.concatenate([np.frombuffer(x[2], np.int32).astype(np.int64) for x in got] + [hot_df[ids]])
        is_hot = np.arange(len(token)) >= len(token) - len(ids)
        need = -(-percent * ns.astype(np.int64) // 100)
        live = np.flatnonzero(np.bincount(number, minlength=len(fps)) >= need)
        mask = np.zeros(len(fps), bool)
        mask[live] = True
        keep = mask[number]
        token, number, df, is_hot = token[keep], number[keep], df[keep], is_hot[keep]
        order = np.lexsort((token, df, is_hot, number))
        token, number, df = token[order], number[order], df[order]
        bounds = np.searchsorted(number, np.append(live, len(fps)))
        out = {name: [] for name in ("fp", "n", "ell", "central", "toks", "pre", "pos", "hubs")}
        for i, lo, hi in zip(live.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            n, toks, freq = int(ns[i]), token[lo:hi], df[lo:hi]
            unshared = n - len(toks)
            ell = choose_level(n, unshared, freq, percent)
            reach = min(max(prefix_length(n, ell, percent) - unshared, 0), len(toks))
            out["fp"].append(int(fps[i]))
            out["n"].append(n)
            out["ell"].append(ell)
            out["central"].append(float(freq.sum()) / n)
            out["toks"].append(C.blob(np.unique(toks)))
            out["pre"].append(toks[:reach].view(np.int64))
            out["pos"].append(np.arange(unshared + 1, unshared + reach + 1, dtype=np.int32))
            out["hubs"].append(C.mix(np.array([C.mix(toks ^ s).min() for s in _SEEDS], np.uint64) ^ _SEEDS).view(np.int64))
        if live.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["fp"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["ell"], pa.int32()), pa.array(out["central"], pa.float64()), pa.array(out["toks"], pa.binary())]
                + [pa.array(out["pre"], pa.list_(pa.int64())), pa.array(out["pos"], pa.list_(pa.int32())), pa.array(out["hubs"], pa.list_(pa.int64()))],
                list(out),
            )
    if parts:
        raise RuntimeError("frequencies came back for a chunk that is not there")


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        cols = [batch.column(x).to_pylist() for x in ("n_a", "n_b", "toks_a", "toks_b")]
        for n_a, n_b, x, y in zip(*cols):
            both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            keep.append(100 * both >= percent * (n_a + n_b - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, profile: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; the intersection is exact, since a token
    of both is a shared token."""
    side = profile.select("rep", "n", "toks")
    both = pairs.join(side.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("toks").alias("toks_a")), "a")
    both = both.join(side.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("toks").alias("toks_b")), "b")
    return both.mapInArrow(C.frugal(lambda it: _verify(it, percent)), "a long, b long")


def _similar_size(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _hub_pairs(members: DataFrame, hub, percent: int, apart: bool) -> DataFrame:
    """Pairs of each member (key, rep, n, comp, ...) with the hub of its key.
    ``apart``: only keys of several components and pairs across them."""
    aggs = [F.max_by(F.struct("rep", "n", "comp"), hub).alias("h")]
    groups = members.groupBy("key").agg(*aggs, F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    groups = groups.where("lo <> hi").drop("lo", "hi")
    pairs = members.join(groups, "key").where("rep <> h.rep" + (" and comp <> h.comp" if apart else ""))
    pairs = pairs.select(F.least("rep", "h.rep").alias("a"), F.greatest("rep", "h.rep").alias("b"), "n", F.col("h.n").alias("hn"))
    return pairs.where(_similar_size("n", "hn", percent)).select("a", "b").distinct()


def _labelled(profile: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return profile.withColumn("comp", F.col("rep"))
    joined = profile.join(comps, profile["rep"] == comps["node"], "left")
    return joined.withColumn("comp", F.coalesce("component", "rep")).drop("node", "component")


HOT_TOKEN = 256  # documents of different components that hold a token
_SHAPE = ["n", "ell", "before", "rest"]


def _can_match(percent: int, left: str = "l_"):
    """The conditions on a match between two shapes; the second one's columns
    begin with ``left``."""
    n, ell, before, rest = ((F.col(c), F.col(left + c)) for c in _SHAPE)
    both = F.ceil((n[0] + n[1]).cast("long") * percent / (100 + percent))  # least intersection
    return (F.greatest(*rest) + both <= F.least(*ell)) & (F.least(*before) + 1 - F.greatest(*rest) >= both) & _similar_size("n", left + "n", percent)


def _across(profile: DataFrame, percent: int) -> DataFrame:
    """The multi-match prefix join between different components."""
    post = profile.select("rep", "n", "ell", "comp", F.posexplode(F.arrays_zip("pre", "pos")).alias("before", "x"))
    # before: the document's shared tokens ahead of this one;
    # rest: how far from the document's end the token stands (negative)
    post = post.select("rep", "n", "ell", "comp", "before", F.col("x.pre").alias("tok"), (F.col("x.pos") - F.col("n")).alias("rest"))
    per = post.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("size"))
    stat = per.groupBy("tok").agg(F.max_by("comp", "size").alias("most"), F.count(F.lit(1)).alias("comps"), F.sum("size").alias("docs")).where("comps > 1")
    hot = F.col("docs") > HOT_TOKEN
    post = post.join(stat.select("tok", "most", hot.alias("hot")), "tok").withColumn("big", F.col("comp") == F.col("most")).drop("most")
    apart = (F.col("comp") != F.col("l_comp")) & (F.col("big") | (F.col("l_rep") < F.col("rep")))
    every = ["rep", "n", "ell", "comp", "before", "rest"]

    def pairs_of(rows: DataFrame, key: list[str], condition) -> DataFrame:
        left = rows.where(~F.col("big")).select(*key, *[F.col(c).alias(f"l_{c}") for c in every])
        right = rows.select(*[F.col(k).alias(f"r_{k}") for k in key], "big", *every)
        on = [F.col(k) == F.col(f"r_{k}") for k in key]
        found = left.join(right, reduce(and_, on, condition))
        return found.select("rep", "l_rep", "ell", "l_ell")

    few = pairs_of(post.where(~F.col("hot")).drop("hot"), ["tok"], apart & _can_match(percent))
    # hot tokens: shapes first, then the documents of those that can match
    many = post.where("hot").drop("hot")
    shapes = many.groupBy("tok", *_SHAPE).agg(F.max((~F.col("big")).cast("int")).alias("small"))
    l_shapes = shapes.where("small = 1").select(F.col("tok").alias("l_tok"), *[F.col(c).alias(f"l_{c}") for c in _SHAPE])
    able = l_shapes.join(shapes.drop("small"), (F.col("l_tok") == F.col("tok")) & _can_match(percent)).drop("l_tok")
    left = many.where(~F.col("big")).select("tok", *[F.col(c).alias(f"l_{c}") for c in every])
    left = left.join(able, ["tok", *[f"l_{c}" for c in _SHAPE]])
    found = left.join(many, ["tok", *_SHAPE]).where(apart).select("rep", "l_rep", "ell", "l_ell")
    pairs = few.unionByName(found)
    pairs = pairs.groupBy(F.least("rep", "l_rep").alias("a"), F.greatest("rep", "l_rep").alias("b"))
    pairs = pairs.agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("ell", "l_ell")).alias("need"))
    return pairs.where("shared >= need").select("a", "b")


def join_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = C.cut(slim.mapInArrow(C.frugal(lambda b: _scan(b, k)), "doc_id long, n long, fp long, key long, count long"))
    rows = scan.where("fp is not null").select("doc_id", "n", "fp")
    total = rows.agg(F.sum("n")).first()[0] or 0
    hot, hot_df = C.hot_keys(scan.where("key is not null").select("key", "count"), total)
    tasks = C.partitions(spark, total, PER_TASK)
    blocks = 8 * tasks
    classes = rows.where("n > 0 and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))

    # rows with null doc_id are left out inside: both passes cut the same slices
    post = slim.mapInArrow(C.frugal(lambda b: _postings(b, k, hot, blocks)), _ROWS)
    freq = post.repartition(tasks, "key").mapInArrow(C.frugal(_frequencies), _ROWS)
    found = freq.repartition(tasks, "chunk").mapInArrow(C.frugal(lambda b: _profiles(b, hot, hot_df, percent)), _PROFILE)
    # one row per class; its copies in other chunks are the same
    found = found.groupBy("fp").agg(F.first(F.struct(*[c for c in found.columns if c != "fp"])).alias("x")).select("fp", "x.*")
    profile = C.cut(found.join(classes, "fp").drop("fp"))

    keyed = _labelled(profile, None).select("rep", "n", "comp", "central", F.explode(F.slice("hubs", 1, CENTRAL_KEYS)).alias("key"))
    central = F.struct("central", -F.col("rep"))
    edges = C.cut(verified(_hub_pairs(keyed, central, percent, False), profile, percent))
    comps = C.components(edges)
    keyed = _labelled(profile, comps).select("rep", "n", "comp", F.explode(F.slice("hubs", CENTRAL_KEYS + 1, RANDOM_KEYS)).alias("key"))
    chance = F.struct(F.xxhash64("rep", "key"), "rep")
    edges = C.cut(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(verified(_hub_pairs(keyed, chance, percent, True), profile, percent)))
    comps = C.components(edges)
    more = verified(_across(_labelled(profile, comps), percent), profile, percent)
    edges = C.cut(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    comps = C.components(edges)

    named = classes.join(comps, classes["rep"] == comps["node"], "left").select("fp", F.coalesce("component", "rep").alias("class_component"))
    out = rows.join(named, "fp", "left")
    component = F.when(F.col("n") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def keep_one(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their
    component; of rows that repeat a doc_id one stays. Rows without doc_id
    stay. All columns unchanged."""
    found = C.cut(join_components(docs, k, percent))
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_twice"))
    if twice.isEmpty():
        return kept
    twice = C.cut(twice)
    once = kept.join(twice, kept["doc_id"] == twice["_twice"], "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, kept["doc_id"] == twice["_twice"], "left_anti").unionByName(once)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(C.read(spark, sf_dir, "documents"))
