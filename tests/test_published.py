"""Published batches: both sinks of a micro-batch become visible together; the
running summary follows the commit log."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from surgecast.operators import reports as R
from surgecast.plans import catalog
from surgecast.sources.reference_tables import read_table
from surgecast.streaming.commits import CommitLog
from surgecast.streaming.runner import start_summary
from surgecast.streaming.sinks import DecisionSink
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows


@pytest.fixture(scope="module")
def decisions(spark):
    found = catalog.flat(catalog.plan_for(spark, SF_SMALL).decisions).cache()
    yield found
    found.unpersist()


def _counts(spark, sink):
    return R.read_feed(spark, sink.feed_path).count(), R.read_sent(spark, sink.sent_path).count()


class Broken(DecisionSink):
    """A sink whose second write fails."""

    def _write_sent(self, df, path):
        super()._write_sent(df, path)
        raise OSError("no room")


class Unpublished(DecisionSink):
    """Both writes are done, then the run ends."""

    def _remove_others(self, *args):
        raise OSError("killed")


def test_a_fault_between_the_writes_shows_neither(spark, scratch, decisions):
    feed, sent = f"{scratch}/feed", f"{scratch}/sent"
    with pytest.raises(OSError):
        Broken(feed, sent)(decisions, 0)
    assert glob.glob(f"{feed}/batch=0/part-*")  # the feed's files are there, but nothing names them
    whole = DecisionSink(feed, sent)
    assert _counts(spark, whole) == (0, 0)
    whole(decisions, 0)  # the replay
    assert _counts(spark, whole) == (14, 9)
    assert len(glob.glob(f"{feed}/batch=0/part-*")) == 1  # what the first attempt left is gone
    # a replay of a published batch that fails: the first attempt still counts, in both
    with pytest.raises(OSError):
        Broken(feed, sent)(decisions.where("aiDecision = 'SEND'"), 0)
    assert _counts(spark, whole) == (14, 9)


def test_a_published_batch_counts_though_cleaning_up_failed(spark, scratch, decisions):
    feed, sent = f"{scratch}/feed", f"{scratch}/sent"
    DecisionSink(feed, sent)(decisions, 3)
    with pytest.raises(OSError):
        Unpublished(feed, sent)(decisions.where("aiDecision = 'SEND'"), 3)
    sink = DecisionSink(feed, sent)
    assert _counts(spark, sink) == (9, 9)  # files of both attempts lie there
    assert len(glob.glob(f"{feed}/batch=3/part-*")) == 2
    sink(decisions, 3)
    assert _counts(spark, sink) == (14, 9)
    assert len(glob.glob(f"{feed}/batch=3/part-*")) == 1


def test_two_runs_cannot_publish_one_attempt(spark, scratch):
    log = CommitLog.of_sinks(spark, f"{scratch}/feed", f"{scratch}/sent")
    log.publish(1, ["a"], [], [])
    log.publish(1, ["b"], [], [])
    assert [os.path.basename(p) for p in sorted(glob.glob(f"{log.path}/*.json"))] == ["000000000001.0000.json", "000000000001.0001.json"]
    assert log.files("feed") == ["batch=1/b"] and log.files("sent") == []
    assert CommitLog.at(spark, f"{scratch}/sent").path == log.path


def test_folders_without_a_log_are_read_whole(spark, scratch, decisions):
    R.alerts(decisions).write.parquet(f"{scratch}/old/batch=4")
    assert R.read_sent(spark, f"{scratch}/old").where("batch = 4").count() == 14
    assert R.read_sent(spark, f"{scratch}/none").count() == 0


def test_texts_with_quotes_and_breaks_survive_the_log(spark, scratch, decisions):
    odd = decisions.withColumn("segment", F.lit('a "b"\n\\c, é'))
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    sink(odd, 0)
    log = CommitLog.at(spark, sink.feed_path)
    assert {a["segment"] for a in log.last(0)["alerts"]} == {'a "b"\n\\c, é'}


def _summary(spark, scratch, feed):
    q = start_summary(spark, feed, f"{scratch}/summary", f"{scratch}/summary-checkpoint", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return read_table(spark, f"{scratch}/summary")


def test_running_summary_over_batches_and_replays(spark, scratch, decisions):
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    sink(decisions, 0)
    sink(decisions.where("aiDecision = 'SKIP'"), 1)
    assert spark_rows(_summary(spark, scratch, sink.feed_path)) == spark_rows(R.alert_summary(R.read_feed(spark, sink.feed_path)))
    # a third batch, and the first one again with other rows: its first
    # attempt is taken back, in the same running query
    sink(decisions, 2)
    sink(decisions.where("segment = 'STANDARD'"), 0)
    assert spark_rows(_summary(spark, scratch, sink.feed_path)) == spark_rows(R.alert_summary(R.read_feed(spark, sink.feed_path)))
    sink(decisions.limit(0), 2)
    assert spark_rows(_summary(spark, scratch, sink.feed_path)) == spark_rows(R.alert_summary(R.read_feed(spark, sink.feed_path)))


def test_summary_before_the_first_batch(spark, scratch):
    q = start_summary(spark, f"{scratch}/feed", f"{scratch}/summary", f"{scratch}/ckpt", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
