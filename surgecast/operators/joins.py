"""Stream/batch joins against static tables, with a measured broadcast.

A static side is broadcast only after its size has been measured and found
under a bound. The measurement is one small aggregate over the table (row
count and the bytes of its values), run once when a plan is built; for a
stream, once at query start (the same pass reports the row counts).
Beyond the bound the side is joined by a shuffle (sort-merge) join, where
adaptive execution may still pick a broadcast from run-time sizes and split
skewed partitions.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# per-row overhead of a broadcast hash relation (pointers, headers, key copy)
ROW_OVERHEAD_BYTES = 48

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _value_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    for typ, width in _FIXED_WIDTH.items():
        if isinstance(field.dataType, typ):
            return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def _parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", str(text).lower())
    if not m:
        return -1
    n = int(m.group(1))
    return n * {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}[m.group(2)]


def broadcast_limit(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    return _parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


@dataclass(frozen=True)
class StaticSide:
    """A static table with its measured size and the join strategy chosen."""

    df: DataFrame
    name: str
    rows: int
    bytes: int
    limit: int

    @property
    def broadcastable(self) -> bool:
        return 0 <= self.bytes <= self.limit and self.limit > 0

    def for_join(self) -> DataFrame:
        return F.broadcast(self.df) if self.broadcastable else self.df


def measure(df: DataFrame, name: str = "table", limit: int | None = None) -> StaticSide:
    """Measure a static table (rows, bytes) in one aggregate job."""
    spark = df.sparkSession
    lim = broadcast_limit(spark, limit)
    row_bytes = F.lit(ROW_OVERHEAD_BYTES)
    for f in df.schema.fields:
        row_bytes = row_bytes + _value_bytes(f)
    got = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()
    side = StaticSide(df=df, name=name, rows=int(got["rows"]), bytes=int(got["bytes"]), limit=lim)
    log.warning(
        "[static] %s: %d rows, %d bytes -> %s join",
        name,
        side.rows,
        side.bytes,
        "broadcast" if side.broadcastable else "shuffle",
    )
    return side


def bounded(df: DataFrame, name: str, rows: int, max_row_bytes: int, limit: int | None = None) -> StaticSide:
    """A static table whose size is known by construction (e.g. built from
    a formula over ``spark.range``): no job is needed to bound it."""
    lim = broadcast_limit(df.sparkSession, limit)
    side = StaticSide(df=df, name=name, rows=rows, bytes=rows * (ROW_OVERHEAD_BYTES + max_row_bytes), limit=lim)
    log.info("[static] %s: <= %d rows, <= %d bytes (by construction)", name, side.rows, side.bytes)
    return side


def as_side(table: DataFrame | StaticSide, name: str, limit: int | None = None) -> StaticSide:
    return table if isinstance(table, StaticSide) else measure(table, name, limit)


def colocated(side: StaticSide, key: str, partitions: int | None = None) -> StaticSide:
    """For a long-running stream, where every micro-batch re-plans its joins:

    * a broadcastable side (bounded by the check above) is persisted, so each
      batch builds its broadcast from memory instead of re-reading the table;
    * a side too large to broadcast is hash-partitioned on the join key once
      and persisted, so each micro-batch shuffles only its own rows and reads
      the static side in place.

    Lost blocks are recomputed from the table."""
    if side.broadcastable:
        df = side.df.persist(StorageLevel.MEMORY_AND_DISK)
        return StaticSide(df=df, name=side.name, rows=side.rows, bytes=side.bytes, limit=side.limit)
    spark = side.df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = side.df.repartition(n, key).persist(StorageLevel.MEMORY_AND_DISK)
    log.warning("[static] %s: hash-partitioned on %s into %d partitions and persisted", side.name, key, n)
    return StaticSide(df=df, name=side.name, rows=side.rows, bytes=side.bytes, limit=side.limit)


def semi_filter(df: DataFrame, side: StaticSide, key: str, keep: Column | None = None) -> DataFrame:
    """Keep rows of ``df`` whose ``key`` appears in ``side`` (rows passing
    ``keep``); the result does not depend on the side's size, only the plan:

    * a broadcastable side is a map-side filter that never moves ``df``;
    * a larger one is a shuffled semi-join. Spark puts a Bloom filter of the
      side's keys in front of that shuffle (``runtime_filter_conf``), so rows
      without a partner are mostly dropped where they are read, and adaptive
      execution splits a hot key's rows. In a stream the side is partitioned
      on the key beforehand (``colocated``) and only the micro-batch moves.
    """
    keys = side.df if keep is None else side.df.where(keep)
    keys = keys.select(key)
    return df.join(F.broadcast(keys) if side.broadcastable else keys, on=key, how="left_semi")


def runtime_filter_conf(side_bytes: int = 1 << 30, input_bytes: int = 10 << 30) -> dict[str, str]:
    """Settings that let Spark build a Bloom filter from the smaller side of a
    shuffled semi-join: sides of up to ``side_bytes`` (its own default of
    10 MB is near the broadcast bound), inputs of at least ``input_bytes``.
    The filter itself has at most 8 MB."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    return {
        f"{prefix}.enabled": "true",
        f"{prefix}.creationSideThreshold": str(side_bytes),
        f"{prefix}.applicationSideScanSizeThreshold": str(input_bytes),
    }
