"""Operator 9 - exact top-k inner-product search, term at a time.

Dimensions are the terms. Candidates stay where the scan put them; a task
holds them in blocks of ``BLOCK`` vectors as weighted postings (term ->
members of the block that are not zero there, with their components). The
queries are sparse rows (terms with non-zero weight). For every term of a
query its postings are scattered, times the query's weight, into the dense
score array of the block; partition selection then keeps the k best of the
block, a task merges its blocks, and a last step merges the tasks.

The queries are the stated set (``vec_id`` divisible by ``every``). They are
written in groups of about ``GROUP`` (by hash), a folder each, and the groups
are run one after the other: a group's vectors are read, broadcast, compared
with all rows, its results written to the shared folder, the broadcast removed.
Driver and tasks so hold one group at a time, however many queries there are.
The work is queries x rows by definition.

Defined results: components are floor(1024 * x) of x as double, scores are
64-bit integers; vectors that are null or hold null or non-finite components
take no part, nor do rows without vec_id; a missing dimension counts as 0; a
query is compared with every row of another vec_id; repeated rows each count
as candidates, a repeated query is asked once (the smallest vector).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.llm import common as C
from surgecast.session import work_path

K = 10
EVERY = 100
SCALE = 1024
BLOCK = 8192
GROUP = 2048

_OUT = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * F.lit(float(scale)))).alias("v"))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components as triples: member, term, weight (non-zero ones)."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    weight = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    member = np.repeat(np.arange(len(size)), size)
    term = C.ranges(np.zeros(len(size), np.int64), size.astype(np.int64))
    some = weight != 0
    return member[some], term[some], weight[some]


def _postings(member: np.ndarray, term: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(term, kind="stable")
    names, lo = np.unique(term[order], return_index=True)
    hi = np.append(lo[1:], len(order))
    return {int(t): (member[order[a:b]], weight[order[a:b]]) for t, a, b in zip(names, lo, hi)}


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: a partition,
    then a sort of what may still be among the k."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _sparse(batch: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query_id, terms, weights) of each row of (vec_id, v)."""
    ids = batch.column("vec_id").to_pylist()
    member, term, weight = _matrix(batch.column("v").combine_chunks())
    at = np.searchsorted(member, np.arange(len(ids) + 1))
    return [(i, term[a:b], weight[a:b]) for i, a, b in zip(ids, at[:-1], at[1:])]


def _search(batches: Iterator[pa.RecordBatch], queries: list, k: int) -> Iterator[pa.RecordBatch]:
    """A task's k best rows for each query (query_id, terms, weights)."""
    tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            ids = C.ids_of(part.column("vec_id"))
            index = _postings(*_matrix(part.column("v")))
            for i, (query_id, terms, weights) in enumerate(queries):
                scores = np.zeros(len(ids), np.int64)
                for t, w in zip(terms.tolist(), weights.tolist()):
                    if t in index:
                        docs, values = index[t]
                        if len(docs) == len(ids):
                            scores += values * w
                        else:
                            scores[docs] += values * w
                other = np.flatnonzero(ids != query_id)
                at = other[best(ids[other], scores[other], k)]
                have = np.append(tops[i][0], ids[at]), np.append(tops[i][1], scores[at])
                keep = best(*have, k)
                tops[i] = have[0][keep], have[1][keep]
    n = [len(t[0]) for t in tops]
    if sum(n):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([q[0] for q in queries], np.int64), n)), pa.array(np.concatenate([t[0] for t in tops])), pa.array(np.concatenate([t[1] for t in tops]))],
            ["query_id", "vec_id", "score"],
        )


def _group(spark: SparkSession, path: str, asked: DataFrame, g: int) -> pa.Table:
    """The queries of one group, in order; only its folder is read."""
    rows = spark.read.schema(T.StructType([*asked.schema.fields, T.StructField("g", T.LongType())])).parquet(path)
    return rows.where(F.col("g") == g).select("vec_id", "v").orderBy("vec_id").toArrow()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for
    each row of ``queries`` (both: vec_id, v array<long>)."""
    spark = vectors.sparkSession
    work = work_path(spark, "top-k")
    asked = C.cut(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    groups = -(-max(1, asked.count()) // GROUP)
    # GROUP rows on average (by hash), bounded, whatever the table's size
    named = asked.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
    named.repartition("g").write.partitionBy("g").parquet(f"{work}/queries")
    for g in range(groups):
        sent = spark.sparkContext.broadcast(_sparse(_group(spark, f"{work}/queries", asked, g)))
        part = vectors.mapInArrow(C.frugal(lambda it, sent=sent: _search(it, sent.value, k)), _OUT)
        part.write.mode("append").parquet(f"{work}/found")
        sent.destroy()
    found = spark.read.schema(_OUT).parquet(f"{work}/found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(C.read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
), e AS (SELECT vec_id, unnest(range(len(c))) AS d, unnest(c) AS x FROM v
), s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(sum(q.x * e.x) AS BIGINT) AS score
  FROM e JOIN e AS q USING (d) WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id GROUP BY ALL
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
