"""Decode once into a clean and a reject table; sketches; versioned tables;
state that the watermark bounds."""

import glob

import pytest
from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.operators import reports as R
from surgecast.operators import windows as W
from surgecast.plans import catalog
from surgecast.sources.reference_tables import build_cells, read_cells, read_table, setup_tables, table_version, write_table
from surgecast.streaming.replay import replay_events_stream, write_inbox
from surgecast.streaming.runner import RefreshingSink, clean_events, read_rejects, start_intake, start_pipeline
from surgecast.streaming.sinks import DecisionSink
from surgecast.streaming.sources import file_messages
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows


# ---------------------------------------------------------------------- intake
def test_one_parse_two_tables(spark):
    run = catalog._full_run(spark, SF_SMALL)
    assert run.intake_plan.count("from_json(") == 1
    parts = {p.split("rejected=")[1].split("/")[0] for p in glob.glob(f"{run.intake_path}/rejected=*/*.parquet")}
    assert parts == {"true", "false"}
    clean = spark.read.parquet(run.intake_path).where("not rejected")
    assert clean.where("value is not null or rejectReason is not null").count() == 0
    assert clean.count() == catalog.q_clean_events(spark, SF_SMALL).count() + 1  # the sentinel


def test_intake_resumes_and_pipeline_follows(spark, scratch):
    """Slice after slice through both hops: each run takes up where the last
    one ended, and the watermark moves between them."""
    write_inbox(spark, SF_SMALL, f"{scratch}/all", n_slices=3)
    tables = setup_tables(spark, f"{scratch}/tables")
    for folder in sorted(glob.glob(f"{scratch}/all/slice-*")):
        spark.read.text(folder).coalesce(1).write.text(f"{scratch}/in/{folder.rsplit('/', 1)[1]}")
        q = start_intake(spark, file_messages(spark, f"{scratch}/in/*"), f"{scratch}/intake", f"{scratch}/ic", available_now=True)
        assert q.awaitTermination(300) and q.exception() is None
        q, _ = start_pipeline(
            spark, clean_events(spark, f"{scratch}/intake"), tables["consents"], tables["cells"], f"{scratch}/feed", f"{scratch}/sent", f"{scratch}/pc", available_now=True
        )
        assert q.awaitTermination(300) and q.exception() is None
    assert spark_rows(R.read_feed(spark, f"{scratch}/feed").select(*catalog.ALERT_NO_STAMP)) == spark_rows(catalog.q_alerts(spark, SF_SMALL))
    want = catalog.q_reject_reasons(spark, SF_SMALL).select("value", "rejectReason")
    assert spark_rows(read_rejects(spark, f"{scratch}/intake").withColumn("value", F.coalesce("value", F.lit("")))) == spark_rows(want)


# -------------------------------------------------------------------- sketches
def test_merged_sketches_equal_a_sketch_of_the_union(spark, scratch):
    """5,000 clients, so the sketches estimate; stored and read back."""
    events = spark.range(40_000).select(
        F.concat(F.lit("C"), (F.col("id") % 5000)).alias("clientId"),
        F.format_string("CELL_%03d", F.col("id") % 2).alias("cellId"),
        F.timestamp_millis(F.lit(1704067200000) + F.col("id") * 200).alias("eventTime"),
    )
    cfg = CampaignConfig(slide_duration=CampaignConfig.window_duration)
    W.client_sketches(events, cfg).write.parquet(f"{scratch}/sketches")
    stored = spark.read.parquet(f"{scratch}/sketches")
    assert stored.agg(F.max(F.octet_length("clients"))).first()[0] < 10_000
    merged = {r["cellId"]: (r["approxClients"], r["eventCount"]) for r in W.merged_clients(stored, "cellId").collect()}
    whole = events.groupBy("cellId").agg(F.hll_sketch_agg("clientId", W.SKETCH_LG_K).alias("s"), F.count(F.lit(1)).alias("n"))
    union = whole.groupBy("cellId").agg(F.hll_union_agg("s").alias("s"), F.first("n").alias("n"))
    assert merged == {r["cellId"]: (r["e"], r["n"]) for r in union.select("cellId", F.hll_sketch_estimate("s").alias("e"), "n").collect()}
    assert all(abs(e - 2500) < 3 * 0.0163 * 2500 and n == 20_000 for e, n in merged.values())


# -------------------------------------------------------------------- versions
def test_a_table_is_replaced_in_one_step(spark, scratch):
    path = f"{scratch}/cells"
    write_table(build_cells(spark), path)
    first, old = table_version(spark, path), read_cells(spark, path)
    write_table(build_cells(spark, 30), path)
    assert table_version(spark, path) != first and read_cells(spark, path).count() == 30
    assert old.count() == 20  # a plan of the version before still reads it
    write_table(build_cells(spark, 5).repartition(3), path)
    assert read_table(spark, path).count() == 5
    assert len(glob.glob(f"{path}/version=*")) == 2  # the present one and the one before


def test_plain_folders_are_read_as_they_are(spark, scratch):
    build_cells(spark).write.parquet(f"{scratch}/plain")
    assert table_version(spark, f"{scratch}/plain") is None and read_cells(spark, f"{scratch}/plain").count() == 20


def test_an_unchanged_table_costs_no_listing(spark, scratch, monkeypatch):
    """However many files it has: per batch one small file is read, and
    neither the table's files are listed nor its rows measured."""
    tables = setup_tables(spark, f"{scratch}/tables")
    write_table(build_cells(spark).repartition(20), tables["cells"])
    agg = catalog.flat(W.window_aggregate(catalog.deduped_for(spark, SF_SMALL)))
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    fn = RefreshingSink(tables["consents"], tables["cells"], sink, CampaignConfig())
    fn(agg, 0)
    from surgecast.streaming import runner

    def never(*_):
        raise AssertionError("the table is read again")

    monkeypatch.setattr(runner, "read_cells", never)
    monkeypatch.setattr(runner, "read_consents", never)
    fn(agg, 1)
    assert [t[1] for t in sink.tallies] == [14, 14] and fn.measurements == 2
    write_table(build_cells(spark).withColumn("campaignActive", F.lit(False)), tables["cells"])
    with pytest.raises(AssertionError):
        fn(agg, 2)


# ----------------------------------------------------------------------- state
def test_state_holds_nothing_behind_the_watermark(spark):
    """Spark's state data source over the finished run's checkpoint."""
    run = replay_events_stream(spark, SF_SMALL)
    watermark = max(p["eventTime"]["watermark"] for p in run.progress if p.get("eventTime", {}).get("watermark"))
    assert watermark > "2024-01-01T00:10"
    operators = spark.read.format("state-metadata").load(run.checkpoint).select("operatorId", "operatorName").collect()
    assert len(operators) == 2  # de-duplication and windows
    kept = {}
    for o in operators:
        state = spark.read.format("statestore").option("operatorId", o["operatorId"]).load(run.checkpoint)
        fields = state.schema["key"].dataType.names
        if "eventTime" in fields:
            kept["dedup"] = state.where(F.col("key.eventTime") < F.lit(watermark).cast("timestamp")).count(), state.count()
        else:
            window = next(f for f in fields if f.startswith("window"))
            kept["windows"] = state.where(F.col(f"key.{window}.end") <= F.lit(watermark).cast("timestamp")).count(), state.count()
    assert kept["dedup"][0] == 0 and kept["dedup"][1] <= 1  # the sentinel at most
    assert kept["windows"][0] == 0 and kept["windows"][1] <= 4
