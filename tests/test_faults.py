"""Faults that must not stop, lose or keep: unrepresentable timestamps,
replays with fewer rows, second runs, empty results, a stop during a batch."""

import glob
import threading
import time

import pytest
from pyspark.sql import functions as F

from surgecast import cli
from surgecast.config import CampaignConfig
from surgecast.operators import clean as C
from surgecast.operators import reports as R
from surgecast.plans import catalog
from surgecast.session import batch_ids, shared_dir
from surgecast.sources import fixtures as FX
from surgecast.sources import wire
from surgecast.sources.reference_tables import setup_tables
from surgecast.streaming.replay import replay_events_stream, write_inbox
from surgecast.streaming.runner import start_pipeline, start_rejects, stop_after_batch
from surgecast.streaming.sinks import DecisionSink
from surgecast.streaming.sources import file_messages
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows

BAD_TIMES = [(1 << 63) - 1, -(1 << 63), 1704067260000000000, 253402300800000]


def _message(ts):
    return f'{{"clientId":"CLIENT_0001","cellId":"CELL_003","latitude":40.0,"longitude":-3.0,"signalDbm":-80,"congestion":90,"technology":"5G","timestamp":{ts}}}'


def test_bad_timestamps_are_rejected_not_fatal(spark):
    df = spark.createDataFrame([(_message(t),) for t in BAD_TIMES + [1704067260000]], "value string")
    dec = wire.decode(df, keep=["value"])
    assert C.clean(dec).count() == 1
    assert {r.rejectReason for r in C.rejects(dec, "value").collect()} == {C.R_BAD_TIMESTAMP}
    assert C.rejects(dec, "value").count() == len(BAD_TIMES)


def _start(spark, base, inbox, **kw):
    tables = setup_tables(spark, f"{base}/tables")
    args = {"available_now": True, "cfg": CampaignConfig(), **kw}
    checkpoint = args.pop("checkpoint", f"{base}/checkpoint")
    return start_pipeline(spark, file_messages(spark, f"{inbox}/*"), tables["consents"], tables["cells"], f"{base}/feed", f"{base}/sent", checkpoint, **args)


def test_stream_survives_bad_timestamps_and_restarts(spark, scratch):
    inbox = f"{scratch}/inbox"
    rows = [_message(1704067200000), *map(_message, BAD_TIMES)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{inbox}/a")
    for _ in range(2):
        q, _s = _start(spark, scratch, inbox)
        q.awaitTermination()
        assert q.exception() is None


def _decisions(spark, n_send, n_skip):
    d = catalog.flat(catalog.plan_for(spark, SF_SMALL).decisions)
    send, skip = d.where("aiDecision = 'SEND'").limit(n_send), d.where("aiDecision = 'SKIP'").limit(n_skip)
    return send.unionByName(skip)


def test_replay_leaves_exactly_its_own_rows(spark, scratch):
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    assert R.read_feed(spark, sink.feed_path).count() == 0 and R.read_sent(spark, sink.sent_path).count() == 0
    for send, skip in ((5, 3), (2, 1), (0, 2), (0, 0), (1, 0)):
        sink(_decisions(spark, send, skip), 5)
        assert R.read_feed(spark, sink.feed_path).count() == send + skip
        assert R.read_sent(spark, sink.sent_path).count() == send
    assert R.read_sent(spark, sink.sent_path).columns[-1] == "batch"


def test_one_file_for_few_rows(spark, scratch):
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    sink(catalog.flat(catalog.plan_for(spark, SF_SMALL).decisions).repartition(64), 0)
    assert len(glob.glob(f"{scratch}/feed/*/part-*")) == 1 and len(glob.glob(f"{scratch}/sent/*/part-*")) == 1
    many = DecisionSink(f"{scratch}/feed2", f"{scratch}/sent2", CampaignConfig(rows_per_file=4))
    many(catalog.flat(catalog.plan_for(spark, SF_SMALL).decisions).repartition(64), 0)
    assert len(glob.glob(f"{scratch}/feed2/*/part-*")) == 4  # 14 rows


def test_second_batch_and_new_checkpoint_replace_nothing(spark, scratch):
    base = f"{scratch}/c"
    cli.main(["setup", "--base", base], spark=spark)
    cli.main(["produce", "--events", SF_SMALL, "--out", f"{base}/inbox", "--files", "2"], spark=spark)
    for _ in range(2):
        cli.main(["batch", "--base", base, "--messages", f"{base}/inbox/*", "--rejects"], spark=spark)
    assert batch_ids(spark, f"{base}/dashboard-feed") == [0, 1]
    assert R.read_feed(spark, f"{base}/dashboard-feed").count() == 28
    with pytest.raises(SystemExit):
        cli.main(["batch", "--base", base, "--messages", f"{base}/inbox/*", "--batch-id", "1"], spark=spark)
    cli.main(["batch", "--base", base, "--messages", f"{base}/inbox/*", "--batch-id", "1", "--replace"], spark=spark)
    assert R.read_feed(spark, f"{base}/dashboard-feed").count() == 28
    with pytest.raises(ValueError):
        cli.main(["stream", "--base", base, "--source", "files", "--path", f"{base}/inbox/*", "--available-now"], spark=spark)
    want = C.rejects(wire.decode(FX.wire_messages(FX.read_events(spark, SF_SMALL)), keep=["value"]), "value").count()
    assert spark.read.parquet(f"{base}/rejects").where("batch = 0").count() == want


def test_stream_rejects_equal_batch_rejects(spark, scratch):
    write_inbox(spark, SF_SMALL, f"{scratch}/inbox", n_slices=3)
    q = start_rejects(spark, file_messages(spark, f"{scratch}/inbox/*"), f"{scratch}/rejects", f"{scratch}/ckpt", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/rejects").select(F.coalesce("value", F.lit("")).alias("value"), "rejectReason")
    assert spark_rows(got) == spark_rows(catalog.q_reject_reasons(spark, SF_SMALL).select("value", "rejectReason"))


def test_empty_run_reads_back_as_no_rows(spark, scratch):
    spark.createDataFrame([(_message(1704067200000),)], "value string").coalesce(1).write.text(f"{scratch}/inbox/a")
    q, _s = _start(spark, scratch, f"{scratch}/inbox")
    q.awaitTermination()
    assert R.read_sent(spark, f"{scratch}/sent").count() == 0 and R.read_feed(spark, f"{scratch}/feed").count() == 0


def test_stop_lets_the_running_batch_commit(spark, scratch):
    spark.createDataFrame([("a",)], "value string").coalesce(1).write.text(f"{scratch}/in/a")
    begun, done = threading.Event(), []

    def slow(df, batch_id):
        begun.set()
        time.sleep(4)
        done.append(df.count())

    q = spark.readStream.format("text").load(f"{scratch}/in/*").writeStream.option("checkpointLocation", f"{scratch}/ck").foreachBatch(slow).start()
    assert begun.wait(60)
    asked = threading.Event()
    asked.set()
    cli.wait_for([q], asked)
    assert done == [1] and glob.glob(f"{scratch}/ck/commits/0")
    assert not q.isActive
    stop_after_batch(q)  # nothing runs any more


def test_every_setting_is_an_option(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(cli, "cmd_batch", lambda spark, args: seen.update(cfg=cli._config(args)))
    cli.main(
        ["batch", "--base", "x", "--messages", "y", "--window-duration", "1 minute", "--kafka-bootstrap", "h:1", "--max-offsets-per-trigger", "7",
         "--no-colocate-windows", "--target-cells", "--signal-floor", "-95", "--rows-per-file", "9"], spark=spark)
    want = CampaignConfig(
        window_duration="1 minute", kafka_bootstrap="h:1", max_offsets_per_trigger=7, colocate_windows=False, require_target_cell=True, signal_floor_dbm=-95, rows_per_file=9
    )
    assert seen["cfg"] == want


def test_replay_keeps_null_ids_and_leaves_the_session_alone(spark, scratch):
    FX.read_events(spark, SF_SMALL).unionByName(FX.read_events(spark, SF_SMALL).limit(1).withColumn("event_id", F.lit(None).cast("long"))).coalesce(1).write.parquet(f"{scratch}/events.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    write_inbox(spark, scratch, f"{scratch}/inbox", n_slices=4)
    plain = FX.wire_messages(FX.read_events(spark, SF_SMALL)).count()
    assert spark.read.text(f"{scratch}/inbox/*").count() == plain + 2  # the null id's message and the sentinel
    replay_events_stream(spark, SF_SMALL)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
