"""Scale guards on physical plans: pruning, map-side partial aggregation,
broadcast only under a size bound, and the shuffle-join path beyond it."""

from surgecast.config import CampaignConfig
from surgecast.operators.joins import as_side
from surgecast.plans import catalog
from surgecast.plans.chain import campaign_plan
from surgecast.sources.reference_tables import build_cells, build_consents
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    text = _plan_text(catalog.q_alerts(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,props:string>" in text


def test_partial_aggregation_before_each_shuffle(spark):
    text = _plan_text(catalog.q_window_agg(spark, SF_SMALL))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_min(struct" in text  # dedup collapses copies map-side
    assert "partial_sum" in text and "partial_count" in text and "partial_max_by" in text


def test_small_static_sides_broadcast(spark):
    text = _plan_text(catalog.q_alerts(spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_large_static_sides_use_shuffle_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = CampaignConfig(broadcast_max_bytes=16)  # below the tables' size
        consents = as_side(build_consents(spark), "consents", cfg.broadcast_max_bytes)
        cells = as_side(build_cells(spark), "cells", cfg.broadcast_max_bytes)
        assert not consents.broadcastable and not cells.broadcastable
        p = campaign_plan(catalog.events_for(spark, SF_SMALL), consents, cells, cfg)
        alerts = p.alerts(with_stamp=False)
        text = _final_plan(alerts)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert text.count("LeftSemi") == 2  # the pre-filter holds, as shuffled semi-joins
        assert spark_rows(alerts) == spark_rows(catalog.q_alerts(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_prefilter_does_not_change_candidates(spark):
    from surgecast.sources.reference_tables import cells_side, consents_side

    ev = catalog.events_for(spark, SF_SMALL)
    a = campaign_plan(ev, consents_side(spark), cells_side(spark), prefilter=True).decisions
    b = campaign_plan(ev, consents_side(spark), cells_side(spark), prefilter=False).decisions
    assert spark_rows(catalog.flat(a)) == spark_rows(catalog.flat(b))


def test_stream_dedup_combines_copies_before_its_shuffle(spark):
    from surgecast.streaming.replay import replay_events_stream

    run = replay_events_stream(spark, SF_SMALL, reuse=False)
    plan = run.plan
    assert "StreamingDeduplicate" not in plan
    assert plan.count("StateStoreSave") == 2  # dedup aggregation, window aggregation
    dedup_exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning(clientId" in line)
    below = plan[plan.index(dedup_exchange) :]
    assert "partial_min(struct" in below.split("Exchange", 2)[1]  # map-side combine under that exchange


def test_dedup_forms_agree(spark):
    from surgecast.operators import clean as C
    from surgecast.operators import dedup as DD

    ev = C.clean(catalog.events_for(spark, SF_SMALL))
    assert spark_rows(DD.dedup(ev)) == spark_rows(DD.dedup(ev, combine=False))


def test_colocated_windows_equal_standard_windows(spark):
    from surgecast.operators import windows as W
    from tests.conftest import SF_MID

    d = catalog.deduped_for(spark, SF_MID)
    for cfg in (CampaignConfig(), CampaignConfig(slide_duration="2 minutes"), CampaignConfig(window_duration="90 seconds")):
        a = W.window_aggregate(d, cfg)
        b = W.window_aggregate(d, cfg.with_(colocate_windows=False))
        assert spark_rows(catalog.flat(a)) == spark_rows(catalog.flat(b)), cfg


def test_colocated_windows_one_exchange_no_partial_shuffle(spark):
    text = _plan_text(catalog.q_window_agg(spark, SF_SMALL))
    exchanges = [l for l in text.splitlines() if "Exchange" in l and "Broadcast" not in l]
    # initial adaptive plan: dedup shuffle + the (client, cell, bucket) routing
    assert len(exchanges) == 2, exchanges
    assert any("REPARTITION_BY_COL" in l and "_bucket" in l for l in exchanges)
    routing = next(l for l in text.splitlines() if "REPARTITION_BY_COL" in l)
    above = text[: text.index(routing)]
    assert "partial_sum" in above and "Exchange" not in above  # windows finish in-task
