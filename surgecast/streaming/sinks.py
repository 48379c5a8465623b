"""Micro-batch sinks for campaign decisions.

Each micro-batch is written under ``batch=<id>`` and published through a commit
log (``commits.py``): feed and SEND table of a batch become visible together.
A batch replayed after a failure replaces its own output instead of appending
a second copy, so the file sinks are idempotent although ``foreachBatch`` is
at-least-once; a replay without rows (or without SENDs) removes what the first
attempt wrote. The batch frame is persisted once and used for the tally, the
CSV feed, the Parquet SEND table and the optional topic. A topic cannot be
overwritten: its records carry the window and the batch id, by which a
consumer tells a replayed alert from the next window's.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.functions import fixed_values as FV
from surgecast.operators import clean as C
from surgecast.operators import reports as R
from surgecast.session import delete_path, list_names, make_path, rename_path
from surgecast.streaming.commits import CommitLog

log = logging.getLogger(__name__)


def kafka_alert_records(alerts: DataFrame, **identity: Column) -> DataFrame:
    """(key, value) records for the alerts topic: key = clientId, value =
    the alert as JSON, followed by the ``identity`` fields."""
    return alerts.select(
        F.col("clientId").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in alerts.columns if c not in identity], *[v.alias(k) for k, v in identity.items()])).alias("value"),
    )


def utc_now_iso() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


@dataclass
class DecisionSink:
    """``foreachBatch`` writer: decisions of one micro-batch -> sinks."""

    feed_path: str
    sent_path: str
    cfg: CampaignConfig = field(default_factory=CampaignConfig)
    kafka_enabled: bool = False
    console_rows: int = 0
    # recent (batch_id, candidates, sent, skipped); bounded for long-running streams
    tallies: deque = field(default_factory=lambda: deque(maxlen=1000))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        decisions = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one row per segment of the consent table and decision
            summary = [r.asDict() for r in R.alert_summary(decisions).collect()]
            n = sum(r["alerts"] for r in summary)
            sent = sum(r["alerts"] for r in summary if r["aiDecision"] == FV.DECISION_SEND)
            spark = batch_df.sparkSession
            log_ = CommitLog.of_sinks(spark, self.feed_path, self.sent_path)
            if not n and log_.last(batch_id) is None:
                self._remove_others(spark, batch_id, [], [])
                return
            stamp = F.lit(utc_now_iso())
            alerts = R.alerts(decisions, stamp=stamp)
            feed_files = self._stage(self._sized(alerts, n), self.feed_path, batch_id, self._write_feed) if n else []
            sent_files = self._stage(self._sized(R.sent_only(alerts), sent), self.sent_path, batch_id, self._write_sent) if sent else []
            log_.publish(batch_id, feed_files, sent_files, summary)
            self._remove_others(spark, batch_id, feed_files, sent_files)
            if n == 0:
                return
            if sent and self.kafka_enabled:
                windows = [c for c in ("windowStart", "windowEnd") if c in decisions.columns]
                identity = {c: F.col(c) for c in windows} | {"batchId": F.lit(batch_id)}
                records = R.alerts(R.sent_only(decisions), stamp=stamp, extra=windows)
                (
                    kafka_alert_records(records, **identity)
                    .write.format("kafka")
                    .option("kafka.bootstrap.servers", self.cfg.kafka_bootstrap)
                    .option("topic", self.cfg.alerts_topic)
                    .save()
                )
            if self.console_rows:
                R.alert_lines(alerts).show(self.console_rows, truncate=False)
            self.tallies.append((batch_id, n, sent, n - sent))
            log.info("[batch %d] candidates %d | SEND %d | SKIP %d", batch_id, n, sent, n - sent)
        finally:
            decisions.unpersist()

    def _write_feed(self, df: DataFrame, path: str) -> None:
        df.write.option("header", "true").option("nullValue", R.CSV_NULL).csv(path)

    def _write_sent(self, df: DataFrame, path: str) -> None:
        df.write.parquet(path)

    def _stage(self, df: DataFrame, root: str, batch_id: int, write: Callable[[DataFrame, str], None]) -> list[str]:
        """Write to a staged folder, move its files into the batch's folder;
        returns their names (Spark's part files have unique ones)."""
        spark, staged, folder = df.sparkSession, f"{root}/_staged-{uuid.uuid4().hex}", f"{root}/batch={batch_id}"
        write(df, staged)
        make_path(spark, folder)
        names = list_names(spark, staged, "part-*")
        for name in names:
            rename_path(spark, f"{staged}/{name}", f"{folder}/{name}")
        delete_path(spark, staged)
        return names

    def _remove_others(self, spark, batch_id: int, feed_files: list[str], sent_files: list[str]) -> None:
        """Remove what other attempts of the batch left."""
        for root, files in ((self.feed_path, feed_files), (self.sent_path, sent_files)):
            folder = f"{root}/batch={batch_id}"
            if not files:
                delete_path(spark, folder)
                continue
            for name in set(list_names(spark, folder)) - set(files):
                delete_path(spark, f"{folder}/{name}")

    def _sized(self, df: DataFrame, rows: int) -> DataFrame:
        """As many files as the rows need, at most one per partition."""
        return df.coalesce(max(1, -(-rows // self.cfg.rows_per_file)))


@dataclass
class RejectSink:
    """``foreachBatch`` writer of the reject table: decoded messages (with
    their ``value``) of one micro-batch -> Parquet under ``batch=<id>``."""

    path: str
    cfg: CampaignConfig = field(default_factory=CampaignConfig)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        rejected = C.rejects(batch_df, "value", self.cfg.max_ahead).select("value", "rejectReason").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = rejected.count()
            folder = f"{self.path}/batch={batch_id}"
            if n:
                files = max(1, -(-n // self.cfg.rows_per_file))
                rejected.coalesce(files).write.mode("overwrite").parquet(folder)
            else:
                delete_path(batch_df.sparkSession, folder)
        finally:
            rejected.unpersist()
