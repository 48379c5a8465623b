"""Cleaning (data quality) and the reject table.

A row is valid when its client id is present and not blank, its signal is
present, its congestion is within 0..100 (a null congestion counts as -1 and
is dropped), the fields needed downstream (cellId, timestamp) are present
(the schema's ``nullable=false`` is not enforced by ``from_json``), the
timestamp is one (a value beyond the timestamp range, such as nanoseconds in
place of milliseconds, would stop the query on every restart), and, where a
bound ``ahead`` is given, it is at most that far beyond the processing time: a
single event of a far future would move the watermark there, and every later
event would be dropped as late. In a stream the processing time is the
micro-batch's own, which a replay keeps.

All predicates are plain column expressions, so Catalyst can push them into
scans and keep them in whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.functions.columns import representable_time
from surgecast.operators.windows import duration_ms
from surgecast.sources.wire import CORRUPT_COL

# reject reasons, in the order they are tested
R_EMPTY = "empty_message"
R_MALFORMED = "malformed_json"
R_NULL_CLIENT = "null_client"
R_BLANK_CLIENT = "blank_client"
R_NULL_SIGNAL = "null_signal"
R_NULL_CONGESTION = "null_congestion"
R_CONGESTION_RANGE = "congestion_out_of_range"
R_MISSING_FIELD = "missing_required_field"
R_BAD_TIMESTAMP = "bad_timestamp"
R_FUTURE = "future_timestamp"
REJECT_REASONS = [
    R_EMPTY,
    R_MALFORMED,
    R_NULL_CLIENT,
    R_BLANK_CLIENT,
    R_NULL_SIGNAL,
    R_NULL_CONGESTION,
    R_CONGESTION_RANGE,
    R_MISSING_FIELD,
    R_BAD_TIMESTAMP,
    R_FUTURE,
]


def valid_client() -> Column:
    c = F.col("clientId")
    return c.isNotNull() & (c != F.lit(""))


def valid_signal() -> Column:
    return F.col("signalDbm").isNotNull()


def valid_congestion() -> Column:
    # null -> -1 -> out of range: coalesce keeps the predicate null-free
    return F.coalesce(F.col("congestion"), F.lit(-1)).between(0, 100)


def required_present() -> Column:
    return F.col("cellId").isNotNull() & F.col("timestamp").isNotNull()


def not_ahead(ahead: str) -> Column:
    """Is the event at most ``ahead`` beyond the processing time?"""
    bound = duration_ms(ahead)
    if bound is None:
        raise ValueError(f"not a duration: {ahead!r}")
    return F.col("timestamp") <= F.unix_millis(F.current_timestamp()) + F.lit(bound)


def is_valid(ahead: str | None = None) -> Column:
    valid = valid_client() & valid_signal() & valid_congestion() & required_present() & representable_time()
    return valid & not_ahead(ahead) if ahead else valid


def clean(events: DataFrame, ahead: str | None = None) -> DataFrame:
    """Keep valid events only."""
    return events.where(is_valid(ahead))


def reject_reason(value_col: str | None = None, ahead: str | None = None) -> Column:
    """First failed rule, or null for a valid row.

    ``value_col`` names the raw message text (decoded input only); without it
    the two message-level reasons are skipped.
    """
    all_fields_null = F.col("clientId").isNull() & F.col("cellId").isNull() & F.col("timestamp").isNull()
    chain = None
    if value_col is not None:
        v = F.col(value_col)
        chain = F.when(v.isNull() | (F.trim(v.cast("string")) == F.lit("")), F.lit(R_EMPTY))
        malformed = all_fields_null & F.col(CORRUPT_COL).isNotNull()
        chain = chain.when(malformed, F.lit(R_MALFORMED))

    def nxt(cond, reason):
        nonlocal chain
        chain = F.when(cond, F.lit(reason)) if chain is None else chain.when(cond, F.lit(reason))

    nxt(F.col("clientId").isNull(), R_NULL_CLIENT)
    nxt(F.col("clientId") == F.lit(""), R_BLANK_CLIENT)
    nxt(F.col("signalDbm").isNull(), R_NULL_SIGNAL)
    nxt(F.col("congestion").isNull(), R_NULL_CONGESTION)
    nxt(~F.col("congestion").between(0, 100), R_CONGESTION_RANGE)
    nxt(~required_present(), R_MISSING_FIELD)
    nxt(~representable_time(), R_BAD_TIMESTAMP)
    if ahead:
        nxt(~not_ahead(ahead), R_FUTURE)
    return chain


def with_reject_reason(events: DataFrame, value_col: str | None = None, ahead: str | None = None) -> DataFrame:
    return events.withColumn("rejectReason", reject_reason(value_col, ahead))


def rejects(events: DataFrame, value_col: str | None = None, ahead: str | None = None) -> DataFrame:
    """The reject table: every input row that fails cleaning, with its reason."""
    return with_reject_reason(events, value_col, ahead).where(F.col("rejectReason").isNotNull())


def reject_summary(events: DataFrame, value_col: str | None = None) -> DataFrame:
    """Rows per reason, including the kept rows (reason 'valid'), in one pass.

    A global aggregate with partial (map-side) counting: the shuffle carries
    one row per reason per task, whatever the input size.
    """
    reason = F.coalesce(reject_reason(value_col), F.lit("valid"))
    return events.groupBy(reason.alias("rejectReason")).agg(F.count(F.lit(1)).alias("rows"))


def cleaning_metric(events: DataFrame, value_col: str | None = None) -> DataFrame:
    """Rows before and after the filters (one row)."""
    ok = is_valid() if value_col is None else (reject_reason(value_col).isNull())
    return events.agg(
        F.count(F.lit(1)).alias("rowsIn"),
        F.count_if(ok).alias("rowsKept"),
        F.count_if(~ok).alias("rowsDropped"),
    )
