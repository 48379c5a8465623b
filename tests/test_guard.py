"""Events of a far future, and unequal copies of one event."""

import random
import time

import pytest
from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.functions.columns import event_time
from surgecast.operators import clean as C
from surgecast.operators import dedup as DD
from surgecast.operators import reports as R
from surgecast.operators import windows as W
from surgecast.plans import catalog
from surgecast.sources import wire
from surgecast.sources.reference_tables import setup_tables
from surgecast.streaming.runner import start_pipeline, start_rejects
from surgecast.streaming.sources import file_messages
from tests.helpers import spark_rows

T0 = 1704067200000
FIELDS = "clientId string, cellId string, latitude double, longitude double, signalDbm int, congestion int, technology string, timestamp long"


def event(sec, congestion=90, client="CLIENT_0001", cell="CELL_003", signal=-80, tech="5G", ts=None):
    return (client, cell, 40.0, -3.0, signal, congestion, tech, T0 + sec * 1000 if ts is None else ts)


def write_file(spark, folder, rows):
    wire.encode(spark.createDataFrame(rows, FIELDS)).select("value").coalesce(1).write.text(folder)


def run(spark, base, inbox, **kw):
    tables = setup_tables(spark, f"{base}/tables")
    q, _ = start_pipeline(
        spark, file_messages(spark, f"{inbox}/*"), tables["consents"], tables["cells"], f"{base}/feed", f"{base}/sent", f"{base}/checkpoint", available_now=True, **kw
    )
    assert q.awaitTermination(300) and q.exception() is None
    return R.read_feed(spark, f"{base}/feed").select(*catalog.ALERT_NO_STAMP), q


FAR = 190_000_000_000_000  # the year 7990


def files(spark, inbox, extra):
    write_file(spark, f"{inbox}/f0", [event(0), event(40, 85)] + extra)
    write_file(spark, f"{inbox}/f1", [event(300), event(310, 95)])
    write_file(spark, f"{inbox}/f2", [event(600), event(630, 88)])
    write_file(spark, f"{inbox}/f3", [event(2000, 0, "SENTINEL", "CELL_001")])


def test_a_far_future_event_changes_no_other_alert(spark, scratch):
    files(spark, f"{scratch}/a/in", [])
    soon = int(time.time() * 1000) + 2 * 3_600_000
    files(spark, f"{scratch}/b/in", [event(0, client="CLIENT_0002", ts=FAR), event(0, client="CLIENT_0003", ts=soon)])
    plain, _ = run(spark, f"{scratch}/a", f"{scratch}/a/in")
    guarded, q = run(spark, f"{scratch}/b", f"{scratch}/b/in")
    assert plain.count() > 12 and spark_rows(guarded) == spark_rows(plain)
    kept = sum(p["observedMetrics"]["cleaning"]["rowsKept"] for p in q.recentProgress if p.get("observedMetrics"))
    assert kept == 7  # the two are counted out
    # without a bound the watermark goes there and later events are lost
    lost, _ = run(spark, f"{scratch}/c", f"{scratch}/b/in", cfg=CampaignConfig(max_ahead=None))
    assert lost.count() < plain.count()
    rejects = start_rejects(spark, file_messages(spark, f"{scratch}/b/in/*"), f"{scratch}/rejects", f"{scratch}/rc", available_now=True)
    rejects.awaitTermination()
    assert [r["rejectReason"] for r in spark.read.parquet(f"{scratch}/rejects").collect()] == [C.R_FUTURE] * 2


def test_the_bound_is_a_setting(spark):
    now = int(time.time() * 1000)
    df = spark.createDataFrame([event(0, ts=now + h * 3_600_000) for h in (-1, 0, 2, 30)], FIELDS)
    assert C.clean(df).count() == 4
    assert [C.clean(df, x).count() for x in ("1 hour", "3 hours", "2 days")] == [2, 3, 4]
    assert C.rejects(df, ahead="1 hour").select("rejectReason").distinct().collect()[0][0] == C.R_FUTURE
    with pytest.raises(ValueError):
        C.clean(df, "soon")


def copies(seed=5, n=60):
    """Each event several times, with other values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        base = event(i * 3, rng.randint(40, 100), f"CLIENT_{1 + i % 4:04d}", f"CELL_{2 + i % 3:03d}")
        for _ in range(rng.randint(1, 5)):
            rows.append((*base[:4], rng.randint(-100, -60), rng.randint(0, 100), rng.choice(["4G", "5G", None]), base[7]))
    return rows


def test_unequal_copies_give_one_result_in_any_order(spark):
    rows = copies()
    want = None
    for seed in range(4):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, FIELDS).repartition(1 + seed * 3).withColumn("eventTime", event_time("timestamp"))
        agg = spark_rows(catalog.flat(W.window_aggregate(DD.dedup(df))))
        want = want or agg
        assert agg == want
    one = {}
    for r in rows:
        key = (r[0], r[1], r[7])
        order = (r[2], r[3], r[4], r[5], (r[6] is not None, r[6] or ""), r[7])
        one[key] = min(one.get(key, (order, r)), (order, r))
    kept = DD.dedup(df).select("clientId", "cellId", "timestamp", "signalDbm", "congestion", "technology").collect()
    assert {tuple(r) for r in kept} == {(k[0], k[1], k[2], r[4], r[5], r[6]) for k, (_, r) in one.items()}


def test_copies_in_micro_batches(spark, scratch):
    """Within a micro-batch the order of unequal copies is nothing to the
    result; those of an earlier one go first."""
    a, b = [event(0, 95), event(20, 90)], [event(0, 96, signal=-99), event(20, 99, tech="4G")]
    last = [event(2000, 0, "SENTINEL", "CELL_001")]
    results = {}
    for name, batches in {"ab": [a + b, last], "ba": [b + a, last], "a": [a, last], "a_then_b": [a, b, last]}.items():
        for i, rows in enumerate(batches):
            write_file(spark, f"{scratch}/{name}/in/f{i}", rows)
        alerts, _ = run(spark, f"{scratch}/{name}", f"{scratch}/{name}/in")
        results[name] = spark_rows(alerts)
    assert results["ab"] == results["ba"]
    assert results["a_then_b"] == results["a"] != results["ab"]


def test_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([event(0)] * 900 + [event(1)], FIELDS).repartition(4).withColumn("eventTime", event_time("timestamp"))
    text = DD.dedup(df)._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning(clientId")
    assert "partial_min(struct" in text[exchange:] and "partial_min" not in text[:exchange]
    assert DD.dedup(df).where(F.col("clientId") == "CLIENT_0001").count() == 2
