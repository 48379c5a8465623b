"""Operator 5 - chat formatting with cumulative-snapshot collapse (DataFrame
functions only).

Loggers write a conversation again after each turn; only the last snapshot is
wanted. Each turn has a hash of its place, role and text; the running sum of
these (two halves of 64 bits) names the prefix that ends there. A
conversation whose whole hash is the prefix of a longer one is dropped by an
anti-join; equal conversations keep the smallest conv_id. What remains is
rendered.

A hot conversation is not one task's work: turns fall into buckets of
``SPAN`` numbers; places and sums are taken within (conversation, bucket) and
moved on by the totals of the buckets before. A first turn that a third of
all conversations share is grouped (map-side) before the anti-join, which has
one row per different prefix on either side. Rendering gives one row per
(conversation, bucket): one for any conversation under SPAN turns, and
otherwise parts in order. Buckets go by the value of turn: the rows of a
conversation that share one turn number, or have none, stay in one bucket and
one task, however many they are.

Order within a conversation: turn (null last), then role, then text. Repeated
turns are kept. Null role renders as ``unknown``, null text as empty; rows
with null conv_id are one conversation of their own. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgecast.llm import common as C

SPAN = 1024

_HALF = 0xFFFFFFFF


def _placed(conv: DataFrame) -> DataFrame:
    """Rows with ``place`` (from 0) in their conversation."""
    bucket = F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(1 << 53))
    rows = conv.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    # turns are equal as they render; a bare hash would skip nulls
    th = F.xxhash64(F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit("")))
    return rows.withColumns({"bucket": bucket.cast("long"), "th": th})


def _offsets(per_bucket: DataFrame, columns: list[str]) -> DataFrame:
    """Totals of the buckets before each bucket of a conversation."""
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select("conv_id", "bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in columns])


def _same(a: DataFrame, b: DataFrame, names: list[str]):
    on = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        on = on & a[n].eqNullSafe(b[n])
    return on


def _add_offsets(rows: DataFrame, per_bucket: DataFrame, columns: list[str]) -> DataFrame:
    off = _offsets(per_bucket, columns).withColumnsRenamed({"conv_id": "_c", "bucket": "_b"})
    on = rows["conv_id"].eqNullSafe(off["_c"]) & (rows["bucket"] == off["_b"])
    return rows.join(off, on).drop("_c", "_b")


def prefixes(conv: DataFrame) -> DataFrame:
    """(conv_id, place, hi, lo, n): the hash of each prefix of each
    conversation of n turns. Texts stay behind, only hashes are shuffled."""
    rows = _placed(conv).select("conv_id", "turn", "bucket", "role", "th")
    within = Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_last(), "role", "th")
    rows = rows.withColumn("place", F.row_number().over(within) - 1).withColumn("one", F.lit(1))
    sizes = rows.groupBy("conv_id", "bucket").agg(F.sum("one").alias("one"))
    rows = _add_offsets(rows, sizes, ["one"]).withColumn("place", F.col("place") + F.col("one_before")).drop("one_before")
    h = F.xxhash64(F.lit("turn"), "place", "th")
    rows = rows.withColumns({"h1": h.bitwiseAND(F.lit(_HALF)), "h2": F.shiftrightunsigned(h, 32)}).drop("role", "th")
    sums = rows.groupBy("conv_id", "bucket").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"), F.sum("one").alias("one"))
    running = Window.partitionBy("conv_id", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"s1": F.sum("h1").over(running), "s2": F.sum("h2").over(running)}).drop("h1", "h2", "one")
    rows = _add_offsets(rows, sums, ["h1", "h2"])
    whole = sums.groupBy("conv_id").agg(F.sum("one").alias("n")).withColumnRenamed("conv_id", "_c")
    rows = rows.join(whole, rows["conv_id"].eqNullSafe(whole["_c"])).drop("_c")
    return rows.select("conv_id", "place", (F.col("s1") + F.col("h1_before")).alias("lo"), (F.col("s2") + F.col("h2_before")).alias("hi"), "n")


def maximal(conv: DataFrame) -> DataFrame:
    """(conv_id, n): the conversations that are no proper prefix of another
    one, equal ones by their smallest id."""
    p = C.cut(prefixes(conv))
    last = F.col("place") == F.col("n") - 1
    whole = p.where(last).groupBy("n", "lo", "hi").agg(F.min("conv_id").alias("conv_id"))
    proper = p.where(~last).groupBy((F.col("place") + 1).alias("n"), "lo", "hi").agg(F.lit(1).alias("longer"))
    return whole.join(proper, ["n", "lo", "hi"], "left_anti").select("conv_id", "n")


def rendered(turn_rows: Column) -> Column:
    """Turns (struct role, text), in order, as one training text."""
    return F.array_join(
        F.transform(turn_rows, lambda x: F.concat(F.lit("<|"), F.coalesce(x["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(x["text"], F.lit("")), F.lit("<|end|>\n"))),
        "",
    )


def chat_texts(conv: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, turns_in_part, text) of the maximal conversations."""
    kept = maximal(conv).withColumnsRenamed({"conv_id": "_c", "n": "n_turns"})
    rows = _placed(conv)
    rows = rows.join(kept, rows["conv_id"].eqNullSafe(kept["_c"])).drop("_c")
    groups = rows.groupBy("conv_id", "bucket", "n_turns").agg(F.collect_list(F.struct(F.coalesce("turn", F.lit((1 << 63) - 1)).alias("turn"), "role", "th", "text")).alias("turns"))
    groups = groups.withColumn("turns", F.array_sort("turns"))
    # parts are numbered over the few buckets of a conversation
    part = F.row_number().over(Window.partitionBy("conv_id").orderBy("bucket")) - 1
    return groups.select("conv_id", "n_turns", F.size("turns").alias("turns_in_part"), rendered(F.col("turns")).alias("text"), "bucket").withColumn("part", part).select(
        "conv_id", "part", "n_turns", "turns_in_part", "text"
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_texts(C.read(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
    count(*) OVER (PARTITION BY conv_id) AS n,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS seg
  FROM conversations
), p AS (
  SELECT conv_id, place, n, string_agg(seg, '') OVER (PARTITION BY conv_id ORDER BY place) AS pre FROM t
), w AS (SELECT n, pre, min(conv_id) AS conv_id FROM p WHERE place = n - 1 GROUP BY n, pre
)
SELECT conv_id, CAST(0 AS INTEGER) AS part, n AS n_turns, CAST(n AS INTEGER) AS turns_in_part, pre AS text
FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.place + 1 = w.n AND p.n > w.n AND p.pre = w.pre)
"""
