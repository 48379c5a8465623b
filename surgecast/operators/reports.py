"""Alert projection, console lines, summaries and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast import schemas
from surgecast.session import path_exists
from surgecast.functions import fixed_values as FV
from surgecast.functions.columns import congestion_band

ISO_INSTANT_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
CSV_NULL = "\\N"  # null marker of the CSV feed (an empty text stays "")


def processing_stamp() -> Column:
    """ISO-8601 UTC text of the current time (constant within one query)."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), ISO_INSTANT_UTC)


def alerts(decisions: DataFrame, stamp: Column | None = None, with_stamp: bool = True, extra: list[str] | None = None) -> DataFrame:
    """The 10-column campaign alert (``timestamp`` is processing time text),
    followed by the ``extra`` columns."""
    cols = [
        F.col("clientId"),
        F.col("cellId"),
        F.col("city"),
        F.col("avgCongestion").cast("int").alias("congestion"),
        F.col("technology"),
        F.col("segment"),
        F.col("aiDecision"),
        F.col("aiReasoning"),
        F.col("smsText"),
    ]
    if with_stamp:
        cols.append((stamp if stamp is not None else processing_stamp()).alias("timestamp"))
    return decisions.select(*cols, *(extra or []))


def sent_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("aiDecision") == F.lit(FV.DECISION_SEND))


def alert_lines(alerts_df: DataFrame) -> DataFrame:
    """Console view of alerts: header line (segment padded to 8), reason and
    SMS cut to 80 characters; the SMS line only for SEND."""
    return alerts_df.select(
        "clientId",
        "cellId",
        F.format_string(
            "%s | %-8s | %s (%s) | %d%%",
            F.col("aiDecision"),
            F.col("segment"),
            F.col("cellId"),
            F.col("city"),
            F.col("congestion"),
        ).alias("headline"),
        F.substring(F.col("aiReasoning"), 1, 80).alias("reasonLine"),
        F.when(F.col("aiDecision") == F.lit(FV.DECISION_SEND), F.substring(F.col("smsText"), 1, 80)).alias("smsLine"),
    )


def alert_summary(df: DataFrame) -> DataFrame:
    """Alerts per (segment, decision)."""
    return df.groupBy("segment", "aiDecision").agg(F.count(F.lit(1)).alias("alerts"))


def tally(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Candidates, SEND and SKIP in one pass (optionally per group)."""
    aggs = [
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("aiDecision") == F.lit(FV.DECISION_SEND)).alias("sent"),
        F.count_if(F.col("aiDecision") == F.lit(FV.DECISION_SKIP)).alias("skipped"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def with_congestion_band(df: DataFrame, col: str = "congestion") -> DataFrame:
    return df.withColumn("congestionBand", congestion_band(col))


_WITH_BATCH = T.StructType(list(schemas.ALERT.fields) + [T.StructField("batch", T.LongType(), True)])


def _published(spark, path: str, sink: str) -> list[str] | None:
    """The files of a sink to read: those its commit log names, the whole
    folder where there is no log, None if there is nothing."""
    from surgecast.streaming.commits import CommitLog

    if not path_exists(spark, path):
        return None
    log = CommitLog.at(spark, path)
    if log is None:
        return [path]
    return [f"{path}/{name}" for name in log.files(sink)] or None


def read_sent(spark, path: str) -> DataFrame:
    """Read all published ``batch=<id>`` partitions of the SEND sink (none: 0
    rows); the partition column ``batch`` is kept."""
    files = _published(spark, path, "sent")
    if files is None:
        return spark.createDataFrame([], _WITH_BATCH)
    return spark.read.schema(_WITH_BATCH).option("basePath", path).parquet(*files)


def read_feed(spark, path: str) -> DataFrame:
    """Read the CSV dashboard feed (header, declared schema). Nulls are
    written as ``\\N``, so empty texts and nulls both read back as written.
    Published batches only."""
    files = _published(spark, path, "feed")
    if files is None:
        return spark.createDataFrame([], _WITH_BATCH)
    return spark.read.option("header", "true").option("nullValue", CSV_NULL).option("basePath", path).schema(_WITH_BATCH).csv(files)
