"""The sketch's estimate beside the exact count of clients per window and cell."""

from pyspark.sql import functions as F

from surgecast.operators import windows as W
from surgecast.plans import catalog
from tests.helpers import spark_rows


def _events(spark, path):
    rows = spark.range(400).select(
        F.col("id").alias("event_id"), (F.col("id") * 7 % 90).alias("user_id"), F.format_string('{"k": %d}', F.col("id") % 100).alias("props")
    )
    rows.write.parquet(f"{path}/events.parquet")


def test_estimate_and_exact_count(spark, scratch):
    _events(spark, scratch)
    got = catalog.q_clients_per_cell(spark, scratch)
    assert got.columns == ["windowStart", "windowEnd", "cellId", "approxClients", "clients", "eventCount", "withinError"]
    agg = catalog.flat(W.window_aggregate(catalog.deduped_for(spark, scratch)))
    want = agg.groupBy("windowStart", "windowEnd", "cellId").agg(F.countDistinct("clientId").alias("clients"), F.sum("eventCount").alias("eventCount"))
    want = want.withColumn("approxClients", F.col("clients")).withColumn("withinError", F.lit(True))
    assert want.count() > 0 and spark_rows(got) == spark_rows(want)


def test_an_estimate_far_off_is_flagged(spark, scratch, monkeypatch):
    """The flag compares: an estimate made three too large is not within."""
    _events(spark, scratch)
    estimates = W.clients_per_cell
    monkeypatch.setattr(W, "clients_per_cell", lambda events: estimates(events).withColumn("approxClients", F.col("approxClients") + 3))
    assert {r["withinError"] for r in catalog.q_clients_per_cell(spark, scratch).collect()} == {False}
