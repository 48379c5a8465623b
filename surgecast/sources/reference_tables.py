"""Static reference tables: client consents and cell configuration.

The builders express the reference's generating formulas as column
expressions over ``spark.range`` (no driver-side sequences). The tables are
written as versions so the setup job can be re-run while they are in use, and
are read back with declared schemas.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast import schemas
from surgecast.functions import fixed_values as FV
from surgecast.operators.joins import StaticSide, bounded
from surgecast.session import delete_path, list_names, path_exists, read_text, replace_path, write_text

log = logging.getLogger(__name__)


def _all_cells(n_cells: int):
    """array('CELL_001', ..., 'CELL_<n>')"""
    return F.transform(F.sequence(F.lit(1), F.lit(n_cells)), lambda x: F.format_string("CELL_%03d", x))


def build_consents(
    spark: SparkSession, n_clients: int = FV.CONSENT_CLIENTS, n_cells: int = FV.CELL_COUNT
) -> DataFrame:
    """Consent table, one row per client i = 1..n_clients.

    segment cycles with i % 6; a client targets 8/5/3 consecutive cells by
    segment, starting at offset (3 i) mod (n_cells - count); campaignsSent = i % 4;
    every tenth client has no consent.
    """
    i = F.col("id")
    cycle = F.array(*[F.lit(s) for s in FV.CONSENT_SEGMENT_CYCLE])
    seg = F.col("segment")
    n = F.col("n_cells")
    offset = ((i * 3) % (F.lit(n_cells) - n)).cast("int")
    return (
        spark.range(1, n_clients + 1)
        .withColumn("segment", F.element_at(cycle, (i % len(FV.CONSENT_SEGMENT_CYCLE) + 1).cast("int")))
        .withColumn("n_cells", _cells_for_segment(seg))
        .select(
            F.format_string("CLIENT_%04d", i).alias("clientId"),
            (i % 10 != 0).alias("hasConsent"),
            seg,
            F.array_join(F.slice(_all_cells(n_cells), offset + 1, n), ",").alias("targetCells"),
            (i % 4).cast("int").alias("campaignsSent"),
        )
    )


def _cells_for_segment(seg):
    return (
        F.when(seg == "PREMIUM", F.lit(FV.CELLS_PER_SEGMENT["PREMIUM"]))
        .when(seg == "STANDARD", F.lit(FV.CELLS_PER_SEGMENT["STANDARD"]))
        .otherwise(F.lit(FV.CELLS_PER_SEGMENT["BASIC"]))
    )


def build_cells(spark: SparkSession, n_cells: int = FV.CELL_COUNT) -> DataFrame:
    """Cell table, one row per cell index i = 0..n_cells-1.

    cellId CELL_<i+1>; every fifth cell (i % 5 = 0) has no active campaign;
    threshold 60/70/80 by i % 3; city and zone from the fixed location list.
    """
    i = F.col("id")
    locs = FV.CELL_LOCATIONS
    loc_idx = (i % len(locs) + 1).cast("int")
    cities = F.array(*[F.lit(c) for c, _ in locs])
    zones = F.array(*[F.lit(z) for _, z in locs])
    return spark.range(0, n_cells).select(
        F.format_string("CELL_%03d", i + 1).alias("cellId"),
        (i % 5 != 0).alias("campaignActive"),
        (F.lit(60) + (i % 3) * 10).cast("int").alias("congestionThreshold"),
        F.element_at(cities, loc_idx).alias("city"),
        F.element_at(zones, loc_idx).alias("zone"),
    )


def consents_side(
    spark: SparkSession, n_clients: int = FV.CONSENT_CLIENTS, n_cells: int = FV.CELL_COUNT, limit: int | None = None
) -> StaticSide:
    """The consent table with its size bound derived from the formula."""
    cell_id = len(f"CELL_{n_cells:03d}")
    row = (
        len(f"CLIENT_{n_clients:04d}")
        + 1
        + max(len(s) for s in FV.CONSENT_SEGMENT_CYCLE)
        + max(FV.CELLS_PER_SEGMENT.values()) * (cell_id + 1)
        + 4
    )
    return bounded(build_consents(spark, n_clients, n_cells), "consents", n_clients, row, limit)


def cells_side(spark: SparkSession, n_cells: int = FV.CELL_COUNT, limit: int | None = None) -> StaticSide:
    """The cell table with its size bound derived from the formula."""
    text = max(len(c.encode()) + len(z.encode()) for c, z in FV.CELL_LOCATIONS)
    row = len(f"CELL_{n_cells:03d}") + 1 + 4 + text
    return bounded(build_cells(spark, n_cells), "cells", n_cells, row, limit)


_VERSION = "_version"


def write_table(df: DataFrame, path: str) -> None:
    """Re-runnable write: a second run replaces, never duplicates or fails.

    The rows go to a folder of their own (``version=<id>``), and one small
    file then names it: readers see the old table or the new one, never a part
    of either. The version before stays for plans that still read it; older
    ones are removed."""
    spark = df.sparkSession
    before, version = table_version(spark, path), uuid.uuid4().hex
    df.write.parquet(f"{path}/version={version}")
    staged = f"{path}/{_VERSION}-{version}"
    write_text(spark, staged, version)
    replace_path(spark, staged, f"{path}/{_VERSION}")
    for name in list_names(spark, path):
        if name not in (f"version={version}", f"version={before}", _VERSION):
            delete_path(spark, f"{path}/{name}")


def table_version(spark: SparkSession, path: str) -> str | None:
    """The id of the table's present version, None if it was written by other
    means (or not at all)."""
    return read_text(spark, f"{path}/{_VERSION}").strip() if path_exists(spark, f"{path}/{_VERSION}") else None


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The present version of a table; a folder of plain Parquet files if it
    has no versions."""
    version = table_version(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path if version is None else f"{path}/version={version}")


def read_consents(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CONSENT)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CELL)


DAY_MS = 86_400_000


def write_replies(replies: DataFrame, path: str) -> None:
    """Append to the reply table, a folder per day of the windows. The rows of
    a day are brought together first (in parts, if many), so that the files do
    not grow with days times tasks: every micro-batch lists them."""
    day = F.floor(F.col("windowStart") / DAY_MS).cast("int")
    replies.select(*schemas.REPLY.names, day.alias("day")).hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").parquet(path)


def read_replies(spark: SparkSession, path: str, first_ms: int | None = None, last_ms: int | None = None) -> DataFrame:
    """The replies for windows that start between two times; only the folders
    of those days are read. No table yet: no replies."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.REPLY)
    rows = spark.read.schema(T.StructType([*schemas.REPLY.fields, T.StructField("day", T.IntegerType())])).parquet(path)
    if first_ms is not None:
        rows = rows.where(F.col("day").between(first_ms // DAY_MS, last_ms // DAY_MS) & F.col("windowStart").between(first_ms, last_ms))
    return rows.drop("day")


def setup_tables(spark: SparkSession, base: str) -> dict[str, str]:
    """The setup job: build and write both tables, report their row counts."""
    paths = {"consents": f"{base.rstrip('/')}/consents", "cells": f"{base.rstrip('/')}/cells"}
    write_table(build_consents(spark), paths["consents"])
    write_table(build_cells(spark), paths["cells"])
    for name, p in paths.items():
        log.warning("[setup] %s: %d rows at %s", name, read_table(spark, p).count(), p)
    return paths
