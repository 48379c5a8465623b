"""Replays of the events as bounded micro-batches: a larger table makes more of
them, not larger ones, and the stream's state partitions follow their size."""

import glob

import pytest
from pyspark.sql import functions as F

from surgecast.plans import catalog
from surgecast.operators import reports as R
from surgecast.sources.reference_tables import DAY_MS, read_replies, write_replies
from surgecast.streaming import replay as RP
from tests.helpers import spark_rows

EVENTS, BOUND = 700, 100


@pytest.fixture()
def events(spark, scratch, monkeypatch):
    """700 events, seven micro-batches' worth, in mixed order, one without id."""
    monkeypatch.setattr(RP, "EVENTS_PER_BATCH", BOUND)
    monkeypatch.setattr(RP, "EVENTS_PER_STATE_PARTITION", BOUND // 2)
    i = F.col("id")
    rows = spark.range(EVENTS).select(F.when(i != 350, i).alias("event_id"), (i * 7 % 50).alias("user_id"), F.format_string('{"k": %d}', i % 100).alias("props"))
    rows.orderBy(F.xxhash64("event_id")).coalesce(3).write.parquet(f"{scratch}/events.parquet")
    return scratch


def _bounded(run):
    read = [p["numInputRows"] for p in run.progress if p["numInputRows"]]
    assert len(read) >= EVENTS // BOUND and max(read) <= 1.5 * BOUND  # extra messages, inexact quantiles
    assert {op["numShufflePartitions"] for p in run.progress for op in p["stateOperators"]} == {2}


def test_stream_batches_are_bounded(spark, events):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run = RP.replay_events_stream(spark, events, reuse=False)
    _bounded(run)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    alerts = spark_rows(R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP))
    assert alerts and alerts == spark_rows(catalog.q_alerts(spark, events))


def test_full_run_batches_are_bounded(spark, events):
    """Alerts and rejects of one run, all micro-batches of it."""
    alerts, rejects = spark_rows(catalog.q_stream_reply_alerts(spark, events)), spark_rows(catalog.q_intake_rejects(spark, events))
    _bounded(catalog._full_run(spark, events))
    assert alerts and alerts == spark_rows(catalog.q_reply_alerts(spark, events).select(*catalog.ALERT_NO_STAMP))
    assert rejects and rejects == spark_rows(catalog.q_guarded_rejects(spark, events).select("value", "rejectReason"))


def test_reply_files_do_not_grow_with_days_times_tasks(spark, scratch):
    day = F.col("id") % 6
    rows = spark.range(0, 600, 1, 5).select(
        (day * DAY_MS + F.col("id")).alias("windowStart"), F.lit("CLIENT_0001").alias("clientId"), F.lit("CELL_001").alias("cellId"), F.lit("x").alias("reply"), F.col("id").alias("repliedAt")
    )
    write_replies(rows, f"{scratch}/replies")
    assert len(glob.glob(f"{scratch}/replies/day=*/*.parquet")) == 6
    assert spark_rows(read_replies(spark, f"{scratch}/replies")) == spark_rows(rows)
