"""Structured Streaming behaviour: late data, cross-batch duplicates,
restart from checkpoint, batch = stream, table refresh, sinks."""

import glob
import os

from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.operators import reports as R
from surgecast.plans import catalog
from surgecast.sources import wire
from surgecast.sources.reference_tables import build_cells, build_consents, setup_tables, write_table
from surgecast.streaming.runner import RefreshingSink, start_pipeline
from surgecast.streaming.replay import replay_events_stream
from surgecast.streaming.sinks import DecisionSink, kafka_alert_records
from surgecast.streaming.sources import file_messages
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows

T0 = 1704067200000  # 2024-01-01T00:00:00Z


def _msg(client, cell, sec, congestion):
    return (client, cell, 40.0, -3.0, -80, congestion, "5G", T0 + sec * 1000)


def _write_file(spark, folder, rows):
    df = spark.createDataFrame(
        rows,
        "clientId string, cellId string, latitude double, longitude double, signalDbm int, congestion int, technology string, timestamp long",
    )
    wire.encode(df).select("value").coalesce(1).write.mode("overwrite").text(folder)


def _run(spark, base, inbox, refresh=False):
    tables = setup_tables(spark, f"{base}/tables")
    q, sink = start_pipeline(
        spark,
        file_messages(spark, f"{inbox}/*", max_files_per_trigger=1),
        tables["consents"],
        tables["cells"],
        f"{base}/feed",
        f"{base}/sent",
        f"{base}/checkpoint",
        CampaignConfig(),
        available_now=True,
        refresh_tables=refresh,
    )
    assert q.awaitTermination(300)
    assert q.exception() is None
    return q, sink


def test_late_and_duplicate_events(spark, scratch):
    inbox = f"{scratch}/inbox"
    a, cell = "CLIENT_0001", "CELL_003"  # PREMIUM, consenting, 1 sent; cell threshold 80
    _write_file(spark, f"{inbox}/f0", [_msg(a, cell, 0, 90), _msg(a, cell, 300, 90)])
    # same key as an event of the previous batch, different value: must be dropped
    _write_file(spark, f"{inbox}/f1", [_msg(a, cell, 310, 90), _msg(a, cell, 300, 0)])
    # 10 s is behind the watermark (310 - 30 = 280): dropped; 285 s is in time
    _write_file(spark, f"{inbox}/f2", [_msg(a, cell, 10, 0), _msg(a, cell, 285, 90)])
    _write_file(spark, f"{inbox}/f3", [_msg("SENTINEL", "CELL_001", 2000, 0)])

    q, sink = _run(spark, scratch, inbox)
    progress = q.recentProgress
    dropped = [sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"]) for p in progress]
    assert sum(dropped) == 1
    assert dropped[2] == 1  # at the third file
    alerts = R.read_feed(spark, f"{scratch}/feed").collect()
    # windows of the 0 s event: 4 (avg 90); windows with 285/300/310: 5 (avg 90)
    assert len(alerts) == 9
    assert {(r.clientId, r.cellId, r.aiDecision, r.congestion) for r in alerts} == {(a, cell, "SEND", 90)}
    cleaning = [p["observedMetrics"]["cleaning"] for p in progress if p.get("observedMetrics")]
    assert sum(m["rowsIn"] for m in cleaning) == 7


def test_stream_equals_batch_and_restart_emits_nothing(spark):
    run = replay_events_stream(spark, SF_SMALL, reuse=False)
    stream = R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP)
    batch = catalog.q_alerts(spark, SF_SMALL)
    assert spark_rows(stream) == spark_rows(batch)
    # malformed messages are counted, not fatal: observed metrics of the
    # stream equal the batch cleaning metric (plus the sentinel message)
    observed = [p["observedMetrics"]["cleaning"] for p in run.progress if p.get("observedMetrics")]
    want = catalog.q_cleaning_metric(spark, SF_SMALL).first()
    assert sum(m["rowsIn"] for m in observed) == want["rowsIn"] + 1
    assert sum(m["rowsKept"] for m in observed) == want["rowsKept"] + 1
    # SEND table holds SENDs only, one folder per batch with any SEND
    sent = R.read_sent(spark, run.sent_path)
    assert "batch" in sent.columns
    assert sent.where(F.col("aiDecision") != "SEND").count() == 0
    assert sent.count() == batch.where(F.col("aiDecision") == "SEND").count()
    # restart from the same checkpoint: nothing new to emit
    files_before = sorted(glob.glob(f"{run.feed_path}/**/*.csv", recursive=True))
    consents, cells = f"{run.work}/tables/consents", f"{run.work}/tables/cells"
    q, sink = start_pipeline(
        spark,
        file_messages(spark, f"{run.inbox}/*", max_files_per_trigger=1),
        consents,
        cells,
        run.feed_path,
        run.sent_path,
        run.checkpoint,
        available_now=True,
    )
    assert q.awaitTermination(300)
    assert len(sink.tallies) == 0
    assert sorted(glob.glob(f"{run.feed_path}/**/*.csv", recursive=True)) == files_before


def test_refreshing_tables_in_stream(spark):
    run = replay_events_stream(spark, SF_SMALL, refresh_tables=True, reuse=False)
    stream = R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(stream) == spark_rows(catalog.q_alerts(spark, SF_SMALL))


def test_refreshing_sink_sees_new_table(spark, scratch):
    agg = catalog.flat(catalog.W.window_aggregate(catalog.deduped_for(spark, SF_SMALL)))
    tables = setup_tables(spark, f"{scratch}/tables")
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    fn = RefreshingSink(tables["consents"], tables["cells"], sink, CampaignConfig())
    fn(agg, 0)
    assert sink.tallies[-1][1] == 14
    fn(agg, 1)
    assert sink.tallies[-1][1] == 14 and fn.measurements == 2  # unchanged tables: not measured again
    write_table(build_consents(spark).withColumn("hasConsent", F.lit(False)), tables["consents"])
    fn(agg, 2)
    assert len(sink.tallies) == 2  # batch 2: no consent -> no candidates, nothing written
    assert fn.measurements == 3
    assert not os.path.exists(f"{scratch}/feed/batch=2")


def test_sink_is_idempotent_and_writes_csv_properly(spark, scratch):
    decisions = catalog.flat(catalog.plan_for(spark, SF_SMALL).decisions)
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    sink(decisions, 7)
    sink(decisions, 7)  # replayed batch: replaced, not appended
    feed = R.read_feed(spark, f"{scratch}/feed")
    assert feed.count() == 14
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{scratch}/feed/batch=7/*.csv"))
    assert text.startswith("clientId,cellId,city,congestion")
    assert '"Segmento STANDARD, congestión' in text  # reasons with commas are quoted
    sent = R.read_sent(spark, f"{scratch}/sent")
    assert sent.count() == 9 and {r.batch for r in sent.select("batch").collect()} == {7}
    # a batch without SEND writes no Parquet folder
    sink(decisions.where(F.col("aiDecision") == "SKIP"), 8)
    assert os.path.exists(f"{scratch}/feed/batch=8") and not os.path.exists(f"{scratch}/sent/batch=8")


def test_kafka_alert_records(spark):
    alerts = catalog.q_sent_alerts(spark, SF_SMALL)
    recs = kafka_alert_records(alerts)
    assert recs.columns == ["key", "value"]
    back = recs.select("key", F.from_json("value", alerts.schema).alias("a")).select("key", "a.*")
    assert back.where(F.col("key") != F.col("clientId")).count() == 0
    assert spark_rows(back.drop("key")) == spark_rows(alerts)


def test_reference_builders_parallel_to_tables(spark):
    # stream tables written by setup equal the in-memory builders
    assert build_cells(spark).count() == 20 and build_consents(spark).count() == 50


def _agg_stream(spark, inbox, out, build):
    from surgecast.operators import clean as C
    from surgecast.operators import dedup as DD
    from surgecast.plans.chain import with_event_time
    from surgecast.streaming.runner import decoded_stream

    ev = DD.dedup(DD.with_watermark(C.clean(with_event_time(decoded_stream(file_messages(spark, f"{inbox}/*", 1)))), "30 seconds"))
    agg = catalog.flat(build(ev))
    q = (
        agg.writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}/ckpt")
        .trigger(availableNow=True)
        .format("parquet")
        .option("path", f"{out}/data")
        .start()
    )
    assert q.awaitTermination(300) and q.exception() is None
    return spark.read.parquet(f"{out}/data")


def test_stream_tumbling_and_approx_distinct(spark, scratch):
    """O-32 and O-36 on a stream: equal to the batch results."""
    from surgecast.operators import windows as W
    from surgecast.streaming.replay import write_inbox

    inbox = f"{scratch}/inbox"
    write_inbox(spark, SF_SMALL, inbox, n_slices=3)
    # the sentinel's own windows never close, so only the data windows are emitted
    tumbling = _agg_stream(spark, inbox, f"{scratch}/t", W.tumbling_aggregate)
    assert spark_rows(tumbling) == spark_rows(catalog.q_window_tumbling(spark, SF_SMALL))
    approx = _agg_stream(spark, inbox, f"{scratch}/a", W.clients_per_cell)
    assert spark_rows(approx) == spark_rows(W.flatten_window(W.clients_per_cell(catalog.deduped_for(spark, SF_SMALL))))


def test_stream_with_large_static_tables(spark):
    """Static sides over the broadcast bound: shuffle joins against tables
    partitioned once on the join key; results equal the batch chain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = CampaignConfig(broadcast_max_bytes=16)
        run = replay_events_stream(spark, SF_SMALL, cfg=cfg, reuse=False)
        stream = R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP)
        assert spark_rows(stream) == spark_rows(catalog.q_alerts(spark, SF_SMALL))
        plans = [p for p in run.progress if p["numInputRows"] > 0]
        assert plans  # data batches ran
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_on_rocksdb_state_store(spark):
    from surgecast.config import ROCKSDB_STATE_STORE

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    run = replay_events_stream(spark, SF_SMALL, cfg=CampaignConfig(state_store_provider=ROCKSDB_STATE_STORE), reuse=False)
    assert spark.conf.get(key, None) == before  # the session keeps its own store
    assert glob.glob(f"{run.checkpoint}/state/0/*/*.zip") or glob.glob(f"{run.checkpoint}/state/0/*/*.changelog") or glob.glob(
        f"{run.checkpoint}/state/0/*/SSTs"
    )
    stream = R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(stream) == spark_rows(catalog.q_alerts(spark, SF_SMALL))


def test_stream_from_typed_parquet_events(spark, scratch):
    """A stream of typed events (Parquet) takes the same chain without JSON."""
    from surgecast.sources import fixtures as FX
    from surgecast.streaming.sources import table_events

    ev = FX.geo_events(FX.read_events(spark, SF_SMALL))
    for i, (a, z) in enumerate([(0, 499), (500, 999)]):
        part = FX.geo_events(FX.read_events(spark, SF_SMALL).where(F.col("event_id").between(a, z)))
        part.coalesce(1).write.mode("overwrite").parquet(f"{scratch}/events/p{i}")
    sentinel = FX.sentinel_message(FX.read_events(spark, SF_SMALL)).select(
        F.from_json("value", ev.schema).alias("e")
    ).select("e.*")
    sentinel.coalesce(1).write.mode("overwrite").parquet(f"{scratch}/events/p9")
    tables = setup_tables(spark, f"{scratch}/tables")
    q, sink = start_pipeline(
        spark,
        table_events(spark, f"{scratch}/events/*", max_files_per_trigger=1),
        tables["consents"],
        tables["cells"],
        f"{scratch}/feed",
        f"{scratch}/sent",
        f"{scratch}/checkpoint",
        available_now=True,
    )
    assert q.awaitTermination(300) and q.exception() is None
    stream = R.read_feed(spark, f"{scratch}/feed").select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(stream) == spark_rows(catalog.q_alerts(spark, SF_SMALL))


def test_stream_with_spark_dedup_operator(spark):
    cfg = CampaignConfig(combine_copies=False)
    run = replay_events_stream(spark, SF_SMALL, cfg=cfg, reuse=False)
    assert "StreamingDeduplicate" in run.plan
    stream = R.read_feed(spark, run.feed_path).select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(stream) == spark_rows(catalog.q_alerts(spark, SF_SMALL))
