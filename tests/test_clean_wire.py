"""Decoding, malformed input, cleaning rules, truncation of averages."""

from pyspark.sql import functions as F

from surgecast.operators import clean as C
from surgecast.operators.windows import window_aggregate
from surgecast.plans.chain import campaign_plan, with_event_time
from surgecast.sources import fixtures as FX
from surgecast.sources import wire
from surgecast.sources.reference_tables import cells_side, consents_side
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows

GOOD = '{"clientId":"CLIENT_0012","cellId":"CELL_009","latitude":40.0,"longitude":-3.0,"signalDbm":-80,"congestion":45,"technology":"5G","timestamp":1704067200000}'


def test_malformed_messages_get_reasons_and_query_survives(spark):
    rows = [
        (GOOD,),
        ("{bad",),
        (GOOD.replace('"congestion":45', '"congestion":"abc"'),),
        (GOOD.replace('"congestion":45', '"congestion":55.5'),),
        ('{"clientId":null}',),
        ("",),
        (None,),
        (GOOD.replace('"congestion":45', '"congestion":101'),),
        (GOOD.replace('"CLIENT_0012"', '""'),),
        (GOOD.replace('"timestamp":1704067200000', '"timestamp":null'),),
    ]
    df = wire.decode(spark.createDataFrame(rows, "value string"), keep=["value"])
    reasons = [r.rejectReason for r in C.with_reject_reason(df, "value").collect()]
    assert reasons == [
        None,
        "malformed_json",
        "null_congestion",
        "null_congestion",
        "null_client",
        "empty_message",
        "empty_message",
        "congestion_out_of_range",
        "blank_client",
        "missing_required_field",
    ]
    # wrong-typed field: that field is null, the rest of the row is kept
    abc = df.collect()[2]
    assert abc.clientId == "CLIENT_0012" and abc.congestion is None and abc.signalDbm == -80
    assert C.clean(df).count() == 1
    summary = {r.rejectReason: r.rows for r in C.reject_summary(df, "value").collect()}
    assert summary["valid"] == 1 and sum(summary.values()) == len(rows)


def test_encode_decode_roundtrip(spark):
    ev = FX.geo_events(FX.read_events(spark, SF_SMALL))
    back = wire.decode(wire.encode(ev)).select(*ev.columns)
    assert spark_rows(back) == spark_rows(ev)
    keys = wire.encode(ev).where(F.col("key") == "null_key").count()
    assert keys == ev.where(F.col("clientId").isNull()).count() > 0


def test_single_json_parse_in_plan(spark):
    msgs = FX.wire_messages(FX.read_events(spark, SF_SMALL))
    plan = C.clean(with_event_time(wire.decode(msgs)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_average_is_truncated_before_threshold(spark):
    # 69, 70, 70 -> 69.67 -> 69: below a threshold of 70 (CELL_002: i=1 -> 70)
    t0 = 1704067200000
    rows = [("CLIENT_0002", "CELL_002", 40.0, -3.0, -80, c, "5G", t0 + i * 1000) for i, c in enumerate([69, 70, 70])]
    ev = spark.createDataFrame(
        rows,
        "clientId string, cellId string, latitude double, longitude double, signalDbm int, congestion int, technology string, timestamp long",
    )
    agg = window_aggregate(with_event_time(ev)).collect()
    assert {r.avgCongestion for r in agg} == {69}
    p = campaign_plan(ev, consents_side(spark), cells_side(spark))
    assert p.candidates.count() == 0
    # negative averages truncate toward zero
    neg = spark.createDataFrame([(-82.9,)], "x double").select(F.col("x").cast("int").alias("v")).first().v
    assert neg == -82


def test_technology_is_latest_in_window(spark):
    t0 = 1704067200000
    rows = [("CLIENT_0002", "CELL_002", 40.0, -3.0, -80, 50, tech, t0 + s * 1000) for s, tech in [(5, "5G"), (1, "4G"), (9, "4G"), (7, "5G")]]
    ev = spark.createDataFrame(
        rows,
        "clientId string, cellId string, latitude double, longitude double, signalDbm int, congestion int, technology string, timestamp long",
    )
    assert {r.technology for r in window_aggregate(with_event_time(ev)).collect()} == {"4G"}
