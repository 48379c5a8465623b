"""Reusable column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surgecast.functions import fixed_values as FV


# Spark's timestamps run from year 1 to year 9999
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def representable_time(millis: str | Column = "timestamp") -> Column:
    """Is the epoch millisecond value a timestamp at all? (null: null)"""
    c = F.col(millis) if isinstance(millis, str) else millis
    return c.between(FIRST_MILLIS, LAST_MILLIS)


def event_time(millis: str | Column = "timestamp") -> Column:
    """Epoch milliseconds -> TIMESTAMP (exact to the millisecond); null for
    values outside the timestamp range, which would overflow."""
    c = F.col(millis) if isinstance(millis, str) else millis
    return F.when(representable_time(c), F.timestamp_millis(c))


def epoch_millis(ts: str | Column) -> Column:
    """TIMESTAMP -> epoch milliseconds (BIGINT); zone independent."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c)


def truncated_int(c: Column) -> Column:
    """double -> int truncated toward zero (the reference casts averages)."""
    return c.cast("int")


def congestion_band(congestion: str | Column = "congestion") -> Column:
    c = F.col(congestion) if isinstance(congestion, str) else congestion
    return (
        F.when(c >= FV.BAND_HIGH_MIN, F.lit("high"))
        .when(c >= FV.BAND_MEDIUM_MIN, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def in_comma_list(item: str | Column, comma_list: str | Column) -> Column:
    """Is ``item`` one of the entries of a comma separated text?"""
    i = F.col(item) if isinstance(item, str) else item
    lst = F.col(comma_list) if isinstance(comma_list, str) else comma_list
    return F.coalesce(F.array_contains(F.split(lst, ","), i), F.lit(False))
