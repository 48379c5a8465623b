"""Named queries over the driver's tables: (spark, sf_dir) -> DataFrame.

Every query reads ``events`` (all of it) through the geo-event fixture view
or its JSON wire form, so its work grows with the table. The consent and cell
tables come from their generating formulas (50 and 20 rows); their size is
measured before they are broadcast.

Time columns leave as epoch milliseconds (``windowStart``, ``windowEnd``,
``eventTimeMs``) so results do not depend on a session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.functions.columns import congestion_band, epoch_millis, event_time
from surgecast.operators import clean as C
from surgecast.operators import decide as D
from surgecast.operators import dedup as DD
from surgecast.operators import reports as R
from surgecast.operators import windows as W
from surgecast.operators.enrich import with_cells, with_consents
from surgecast.plans.chain import CampaignPlan, campaign_plan
from surgecast.sources import fixtures as FX
from surgecast.sources import wire
from surgecast.sources.reference_tables import cells_side, consents_side

Query = Callable[[SparkSession, str], DataFrame]

ALERT_NO_STAMP = [
    "clientId",
    "cellId",
    "city",
    "congestion",
    "technology",
    "segment",
    "aiDecision",
    "aiReasoning",
    "smsText",
]


# ----------------------------------------------------------------- building blocks
def events_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.geo_events(FX.read_events(spark, sf_dir)).withColumn("eventTime", event_time("timestamp"))


def _tables(spark: SparkSession, cfg: CampaignConfig):
    return (
        consents_side(spark, limit=cfg.broadcast_max_bytes),
        cells_side(spark, limit=cfg.broadcast_max_bytes),
    )


def plan_for(spark: SparkSession, sf_dir: str, cfg: CampaignConfig | None = None) -> CampaignPlan:
    cfg = cfg or CampaignConfig()
    consents, cells = _tables(spark, cfg)
    return campaign_plan(events_for(spark, sf_dir), consents, cells, cfg)


def flat(df: DataFrame) -> DataFrame:
    return W.flatten_window(df)


def deduped_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DD.dedup(C.clean(events_for(spark, sf_dir)))


# ----------------------------------------------------------------- sources
def q_geo_events(spark, sf_dir):
    return FX.geo_events(FX.read_events(spark, sf_dir))


def q_encode_events(spark, sf_dir):
    return wire.encode(FX.geo_events(FX.read_events(spark, sf_dir)))


def q_decode_events(spark, sf_dir):
    msgs = FX.wire_messages(FX.read_events(spark, sf_dir))
    dec = wire.decode(msgs, keep=["key"])
    return dec.select("key", *[c for c in dec.columns if c not in ("key", wire.CORRUPT_COL, "eventTime")], epoch_millis("eventTime").alias("eventTimeMs"))


# ----------------------------------------------------------------- cleaning
def q_clean_events(spark, sf_dir):
    return C.clean(FX.geo_events(FX.read_events(spark, sf_dir)))


def q_guarded_rejects(spark, sf_dir):
    """The reject table with a bound on event times: messages of a far future
    are rejected beside the malformed ones."""
    events = FX.read_events(spark, sf_dir)
    messages = FX.wire_messages(events).select("key", "value").unionByName(FX.future_messages(events))
    decoded = wire.decode(messages, keep=["key", "value"])
    return C.rejects(decoded, "value", CampaignConfig.max_ahead).select("key", "value", "rejectReason")


def _decoded_wire(spark, sf_dir):
    return wire.decode(FX.wire_messages(FX.read_events(spark, sf_dir)), keep=["key", "value"])


def q_reject_reasons(spark, sf_dir):
    return C.rejects(_decoded_wire(spark, sf_dir), value_col="value").select("key", "value", "rejectReason")


def q_reject_summary(spark, sf_dir):
    return C.reject_summary(_decoded_wire(spark, sf_dir), value_col="value")


def q_cleaning_metric(spark, sf_dir):
    return C.cleaning_metric(_decoded_wire(spark, sf_dir), value_col="value")


def q_congestion_band(spark, sf_dir):
    ev = FX.geo_events(FX.read_events(spark, sf_dir))
    band = F.when(~C.is_valid(), F.lit("dirty")).otherwise(congestion_band("congestion"))
    return ev.groupBy(band.alias("congestionBand")).agg(F.count(F.lit(1)).alias("events"))


# ----------------------------------------------------------------- dedup / windows
def q_dedup_events(spark, sf_dir):
    d = deduped_for(spark, sf_dir)
    return d.select(
        "clientId", "cellId", epoch_millis("eventTime").alias("eventTimeMs"), "signalDbm", "congestion", "technology"
    )


def q_window_agg(spark, sf_dir):
    return flat(W.window_aggregate(deduped_for(spark, sf_dir)))


def q_window_tumbling(spark, sf_dir):
    return flat(W.tumbling_aggregate(deduped_for(spark, sf_dir)))


def q_dedup_conflicts(spark, sf_dir):
    """De-duplication where copies of a key differ."""
    events = FX.conflicting_events(FX.read_events(spark, sf_dir)).withColumn("eventTime", event_time("timestamp"))
    d = DD.dedup(C.clean(events))
    return d.select("clientId", "cellId", epoch_millis("eventTime").alias("eventTimeMs"), "signalDbm", "congestion", "technology")


def q_clients_per_cell(spark, sf_dir):
    """The sketch's estimate beside the exact count (one row per client in the
    window aggregate), with a flag: is the estimate within three standard
    errors? Of few clients (some hundreds) a sketch's estimate is exact."""
    deduped = deduped_for(spark, sf_dir)
    sketch = flat(W.clients_per_cell(deduped))
    exact = flat(W.window_aggregate(deduped)).groupBy("windowStart", "windowEnd", "cellId").agg(F.count(F.lit(1)).alias("clients"))
    both = sketch.join(exact, ["windowStart", "windowEnd", "cellId"])
    near = F.abs(F.col("approxClients") - F.col("clients")) <= F.greatest(F.lit(1.0), 3 * W.SKETCH_ERROR * F.col("clients"))
    return both.select("windowStart", "windowEnd", "cellId", "approxClients", "clients", "eventCount", near.alias("withinError"))


def q_clients_per_hour(spark, sf_dir):
    """Sketches of two-minute windows, merged to hours."""
    cfg = CampaignConfig(slide_duration=CampaignConfig.window_duration)
    sketches = W.client_sketches(deduped_for(spark, sf_dir), cfg)
    hour = F.floor(epoch_millis(F.col("window.start")) / 3_600_000).cast("long")
    return W.merged_clients(sketches, hour.alias("hour"), "cellId").select("hour", "cellId", "approxClients", "eventCount")


# ----------------------------------------------------------------- joins / candidates
def q_with_consent(spark, sf_dir):
    consents, _ = _tables(spark, CampaignConfig())
    return flat(with_consents(W.window_aggregate(deduped_for(spark, sf_dir)), consents))


def q_with_cells(spark, sf_dir):
    consents, cells = _tables(spark, CampaignConfig())
    return flat(with_cells(with_consents(W.window_aggregate(deduped_for(spark, sf_dir)), consents), cells))


def q_candidates(spark, sf_dir):
    return flat(plan_for(spark, sf_dir).candidates)


def q_candidates_min3(spark, sf_dir):
    return flat(plan_for(spark, sf_dir, CampaignConfig(min_events=3)).candidates)


def q_target_cell_candidates(spark, sf_dir):
    return flat(plan_for(spark, sf_dir, CampaignConfig(require_target_cell=True)).candidates)


# ----------------------------------------------------------------- decisions / alerts
def q_decisions(spark, sf_dir):
    return flat(plan_for(spark, sf_dir).decisions)


def q_alerts(spark, sf_dir):
    return plan_for(spark, sf_dir).alerts(with_stamp=False)


def q_sent_alerts(spark, sf_dir):
    return R.sent_only(q_alerts(spark, sf_dir))


def q_signal_floor_decisions(spark, sf_dir):
    from surgecast.functions.fixed_values import SIGNAL_FLOOR_DBM

    return flat(plan_for(spark, sf_dir, CampaignConfig(signal_floor_dbm=SIGNAL_FLOOR_DBM)).decisions)


def reply_kind() -> Column:
    """(windowStart / 30 s + client number) mod 8."""
    ws = epoch_millis(F.col("window.start"))
    return (F.floor(ws / 30000) + F.substring("clientId", 8, 4).cast("long")) % 8


def derived_reply() -> Column:
    """A decision-service reply derived from a candidate row (test input for
    the external-decision operator). By ``reply_kind``: 0 -> plain JSON in an
    API body, 1 -> fenced JSON, 2 -> text that is not JSON, 3 -> no reply
    (null), 4 -> an API body without content, 5 -> the text block comes second,
    6 -> plain JSON (sent twice, see ``derived_replies``), 7 -> an SMS that is
    too long. The reply's decision is SKIP on 4G, else SEND."""
    sel = reply_kind()
    decision = F.when(F.col("technology") == F.lit("4G"), F.lit("SKIP")).otherwise(F.lit("SEND"))
    reply = F.to_json(
        F.struct(
            decision.alias("decision"),
            F.format_string("Servicio: %s en %s", F.col("clientId"), F.col("cellId")).alias("reasoning"),
            F.when(decision == F.lit("SEND"), F.when(sel == 7, F.repeat(F.lit("x"), 200)).otherwise(F.lit("Activa 5G ``` prioritario"))).otherwise(F.lit("")).alias("smsText"),
        )
    )
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    return (
        F.when(sel == 0, F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("type"), reply.alias("text"))).alias("content"))))
        .when(sel == 1, F.concat(F.lit("```json\n"), reply, F.lit("\n```")))
        .when(sel == 2, F.lit("Lo siento, no puedo decidir."))
        .when(sel == 4, F.lit('{"content":[]}'))
        .when(sel == 5, F.to_json(F.struct(F.array(block("thinking", F.lit("...")), block("text", reply)).alias("content"))))
        .when(sel.isin(6, 7), reply)
    )


def derived_replies(candidates: DataFrame) -> DataFrame:
    """The same replies as a separate table keyed by (window, client, cell);
    kind 6 comes a second time, as a text that sorts after the first."""
    one = candidates.select("window", "clientId", "cellId", derived_reply().alias("reply"), reply_kind().alias("_kind"))
    twice = F.when(F.col("_kind") == 6, F.array("reply", F.lit("~ again"))).otherwise(F.array("reply"))
    return one.where(F.col("reply").isNotNull()).select("window", "clientId", "cellId", F.explode(twice).alias("reply"))


def reply_table(candidates: DataFrame) -> DataFrame:
    """The derived replies as a reply table (``schemas.REPLY``): a minute after
    the window's end, those of kind 6 too late (ten minutes)."""
    start = epoch_millis(F.col("window.start"))
    one = derived_replies(candidates).select(start.alias("windowStart"), "clientId", "cellId", "reply", epoch_millis(F.col("window.end")).alias("_end"), reply_kind().alias("_kind"))
    wait = F.when(F.col("_kind") == 6, F.lit(600_000)).otherwise(F.lit(60_000))
    return one.select("windowStart", "clientId", "cellId", "reply", (F.col("_end") + wait).alias("repliedAt"))


def _with_replies(spark, sf_dir) -> CampaignPlan:
    consents, cells = _tables(spark, CampaignConfig())
    replies = reply_table(plan_for(spark, sf_dir).candidates)
    return campaign_plan(events_for(spark, sf_dir), consents, cells, CampaignConfig(), replies=replies)


def q_reply_alerts(spark, sf_dir):
    """The chain with a reply table: replies in time decide, else the rules."""
    return R.alerts(_with_replies(spark, sf_dir).decisions, with_stamp=False, extra=["decisionSource"])


def q_external_decisions(spark, sf_dir):
    # a reply table of its own, joined; the two sides share the chain's
    # exchanges, which Spark reuses
    p = plan_for(spark, sf_dir)
    out = D.with_external_decisions(p.candidates, derived_replies(p.candidates), keys=["window", "clientId", "cellId"])
    return flat(out).select(
        "windowStart", "windowEnd", "clientId", "cellId", "segment", "avgCongestion", "technology",
        "decisionSource", "aiDecision", "aiReasoning", "smsText",
    )


def q_sms_length(spark, sf_dir):
    d = D.sms_quality(flat(plan_for(spark, sf_dir).decisions))
    return d.select("windowStart", "clientId", "cellId", "aiDecision", "smsLength", "smsFits")


def q_alert_lines(spark, sf_dir):
    return R.alert_lines(q_alerts(spark, sf_dir))


def q_alert_summary(spark, sf_dir):
    return R.alert_summary(q_alerts(spark, sf_dir))


def q_batch_tally(spark, sf_dir):
    return R.tally(plan_for(spark, sf_dir).decisions)


# ----------------------------------------------------------------- streaming
def q_stream_alerts(spark, sf_dir):
    from surgecast.streaming.replay import replay_events_stream

    run = replay_events_stream(spark, sf_dir)
    return R.read_feed(spark, run.feed_path).select(*ALERT_NO_STAMP)


def q_results_roundtrip(spark, sf_dir):
    from surgecast.streaming.replay import replay_events_stream

    run = replay_events_stream(spark, sf_dir)
    return R.read_sent(spark, run.sent_path).select(*ALERT_NO_STAMP)


def q_live_summary(spark, sf_dir):
    """The running summary (complete mode) after the stream's last batch."""
    from surgecast.session import path_exists, work_path
    from surgecast.sources.reference_tables import read_table
    from surgecast.streaming.replay import replay_events_stream
    from surgecast.streaming.runner import start_summary

    run = replay_events_stream(spark, sf_dir)
    path = f"{work_path(spark, 'summary')}/table"
    q = start_summary(spark, run.feed_path, path, f"{path}-checkpoint", available_now=True)
    q.awaitTermination()
    return read_table(spark, path) if path_exists(spark, path) else spark.createDataFrame([], "segment string, aiDecision string, alerts long")


def _full_run(spark, sf_dir):
    from surgecast.streaming.replay import replay_full

    return replay_full(spark, sf_dir, lambda: reply_table(plan_for(spark, sf_dir).candidates))


def q_stream_reply_alerts(spark, sf_dir):
    """Intake, pipeline and reply lookup as streams, with messages of a far
    future among the others."""
    return R.read_feed(spark, _full_run(spark, sf_dir).feed_path).select(*ALERT_NO_STAMP)


def q_intake_rejects(spark, sf_dir):
    """The reject part of the intake table; an empty message is ''."""
    from surgecast.streaming.runner import read_rejects

    rejected = read_rejects(spark, _full_run(spark, sf_dir).intake_path)
    return rejected.select(F.coalesce("value", F.lit("")).alias("value"), "rejectReason")


def q_stream_tally(spark, sf_dir):
    from surgecast.streaming.replay import replay_events_stream

    run = replay_events_stream(spark, sf_dir)
    return R.read_feed(spark, run.feed_path).transform(lambda d: R.tally(d))


QUERIES: dict[str, Query] = {
    "geo_events": q_geo_events,
    "encode_events": q_encode_events,
    "decode_events": q_decode_events,
    "clean_events": q_clean_events,
    "reject_reasons": q_reject_reasons,
    "reject_summary": q_reject_summary,
    "cleaning_metric": q_cleaning_metric,
    "congestion_band": q_congestion_band,
    "guarded_rejects": q_guarded_rejects,
    "dedup_events": q_dedup_events,
    "dedup_conflicts": q_dedup_conflicts,
    "window_agg": q_window_agg,
    "window_tumbling": q_window_tumbling,
    "clients_per_cell": q_clients_per_cell,
    "clients_per_hour": q_clients_per_hour,
    "with_consent": q_with_consent,
    "with_cells": q_with_cells,
    "candidates": q_candidates,
    "candidates_min3": q_candidates_min3,
    "target_cell_candidates": q_target_cell_candidates,
    "decisions": q_decisions,
    "alerts": q_alerts,
    "sent_alerts": q_sent_alerts,
    "signal_floor_decisions": q_signal_floor_decisions,
    "external_decisions": q_external_decisions,
    "reply_alerts": q_reply_alerts,
    "sms_length": q_sms_length,
    "alert_lines": q_alert_lines,
    "alert_summary": q_alert_summary,
    "batch_tally": q_batch_tally,
    "stream_alerts": q_stream_alerts,
    "results_roundtrip": q_results_roundtrip,
    "stream_tally": q_stream_tally,
    "live_summary": q_live_summary,
    "stream_reply_alerts": q_stream_reply_alerts,
    "intake_rejects": q_intake_rejects,
}
