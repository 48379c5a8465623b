"""The streaming campaign pipeline.

    messages -> decode -> clean -> watermark -> dedup -> sliding window
             -> consents -> cells -> threshold -> decide -> foreachBatch sinks

Everything up to the decision is the same DataFrame code as the batch chain;
the stream adds the source, the trigger, the checkpoint and the sinks.
State (dedup keys, open windows) is bounded by the watermark. The number of
shuffle partitions is frozen into the checkpoint, so it is set before the
first start.

With ``refresh_tables`` the static tables are re-read inside every
micro-batch (the stream stops at the window aggregate), so changed consent
and cell tables take effect at the next batch. With ``replies_path`` a reply
table is looked up inside every micro-batch (the stream stops at the
candidates).

Two further queries can run beside it: ``start_intake`` decodes messages once
into a clean and a reject table, of which the pipeline reads the clean one, and
``start_summary`` keeps a running summary of what has been published.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from surgecast.config import CampaignConfig
from surgecast.operators import clean as C
from surgecast.operators import decide as D
from surgecast.operators import dedup as DD
from surgecast.operators import enrich as E
from surgecast.operators import windows as W
from surgecast.operators.joins import StaticSide, as_side, colocated, measure
from surgecast.plans.chain import campaign_plan, with_event_time
from surgecast.schemas import GEO_EVENT, GEO_EVENT_FIELDS
from surgecast.sources import wire
from surgecast.sources.reference_tables import read_cells, read_consents, read_replies, table_version, write_table
from surgecast.session import batch_ids, make_path, path_exists
from surgecast.streaming.commits import LOG_FOLDER, CommitLog
from surgecast.streaming.sinks import DecisionSink, RejectSink

CLEANING_METRIC = "cleaning"


def decoded_stream(messages: DataFrame, observe: bool = True, ahead: str | None = None) -> DataFrame:
    """Decode messages (a ``value`` column of JSON), or take already typed
    events (the 8 geo fields, e.g. a Parquet stream) as they are; attach the
    cleaning metric (rows in / kept), read from
    ``query.lastProgress['observedMetrics']``."""
    typed = all(f in messages.columns for f in GEO_EVENT_FIELDS)
    dec = with_event_time(messages) if typed else wire.decode(messages)
    if observe:
        dec = dec.observe(
            CLEANING_METRIC,
            F.count(F.lit(1)).alias("rowsIn"),
            F.count_if(C.is_valid(ahead)).alias("rowsKept"),
        )
    return dec


def decision_stream(
    messages: DataFrame,
    consents: DataFrame | StaticSide,
    cells: DataFrame | StaticSide,
    cfg: CampaignConfig | None = None,
    decided: bool = True,
) -> DataFrame:
    """The chain up to the decisions, or up to the candidates."""
    cfg = cfg or CampaignConfig()
    plan = campaign_plan(decoded_stream(messages, ahead=cfg.max_ahead), consents, cells, cfg)
    # window bounds leave as plain epoch-ms columns: a persisted micro-batch
    # frame cannot carry the watermarked window attribute
    return W.flatten_window(plan.decisions if decided else plan.candidates)


@dataclass
class Decider:
    """foreachBatch writer from candidates to the sink: replies that have come
    in time decide, looked up for the batch's own windows only, the rules
    decide the rest."""

    sink: DecisionSink
    cfg: CampaignConfig
    replies_path: str | None = None

    def __call__(self, candidates: DataFrame, batch_id: int) -> None:
        if self.replies_path is None:
            self.sink(D.decide(candidates, self.cfg), batch_id)
            return
        candidates = candidates.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            span = candidates.agg(F.min("windowStart").alias("first"), F.max("windowStart").alias("last")).first()
            if span["first"] is None:
                decided = D.decide(candidates, self.cfg)
            else:
                replies = read_replies(candidates.sparkSession, self.replies_path, span["first"], span["last"])
                decided = D.decide_with_replies(candidates, replies, self.cfg)
            self.sink(decided, batch_id)
        finally:
            candidates.unpersist()


@dataclass
class RefreshingSink:
    """foreachBatch writer that joins each batch of window aggregates with
    freshly read static tables, then decides and writes.

    A table is read and measured again only when its version changed: one
    small file that ``write_table`` leaves is read per batch, so an unchanged
    table costs the same however many files it has. A table written by other
    means has no version and is read and measured in every batch."""

    consents_path: str
    cells_path: str
    sink: DecisionSink
    cfg: CampaignConfig
    replies_path: str | None = None

    def __post_init__(self):
        self._sides: dict[str, tuple[str, StaticSide]] = {}
        self.measurements = 0

    def _side(self, spark: SparkSession, name: str, path: str, read) -> StaticSide:
        version = table_version(spark, path)
        hit = self._sides.get(name)
        if hit is not None and version is not None and hit[0] == version:
            return hit[1]
        side = measure(read(spark, path), name, self.cfg.broadcast_max_bytes)
        self.measurements += 1
        self._sides[name] = (version, side)
        return side

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        consents = self._side(spark, "consents", self.consents_path, read_consents)
        cells = self._side(spark, "cells", self.cells_path, read_cells)
        enriched = E.with_cells(E.with_consents(batch_df, consents), cells)
        Decider(self.sink, self.cfg, self.replies_path)(E.candidates(enriched, self.cfg), batch_id)


def start_pipeline(
    spark: SparkSession,
    messages: DataFrame,
    consents_path: str,
    cells_path: str,
    feed_path: str,
    sent_path: str,
    checkpoint: str,
    cfg: CampaignConfig | None = None,
    available_now: bool = False,
    refresh_tables: bool = False,
    kafka_sink: bool = False,
    console_rows: int = 0,
    query_name: str | None = None,
    replies_path: str | None = None,
) -> tuple[StreamingQuery, DecisionSink]:
    """Start the streaming query; returns it with its sink (for tallies).
    ``replies_path``: a reply table (``write_replies``) that decides where a
    reply came in time."""
    cfg = cfg or CampaignConfig()
    if not path_exists(spark, f"{checkpoint}/offsets"):
        # batch ids start again at 0: they must not replace another run's output
        used = [p for p in (feed_path, sent_path) if batch_ids(spark, p)]
        if used:
            raise ValueError(f"a new checkpoint would overwrite the batches in {', '.join(used)}: use new sink folders or the old checkpoint")
    for path in (feed_path, sent_path):
        make_path(spark, path)
    sink = DecisionSink(feed_path, sent_path, cfg, kafka_enabled=kafka_sink, console_rows=console_rows)
    if refresh_tables:
        cleaned = C.clean(with_event_time(decoded_stream(messages, ahead=cfg.max_ahead)), cfg.max_ahead)
        deduped = DD.dedup(DD.with_watermark(cleaned, cfg.watermark_delay), combine=cfg.combine_copies)
        stream_df = W.flatten_window(W.window_aggregate(deduped, cfg))
        writer_fn = RefreshingSink(consents_path, cells_path, sink, cfg, replies_path)
    else:
        # static tables: read and measured once at start (row counts logged),
        # persisted, and partitioned on the join key when too large to broadcast
        consents = colocated(as_side(read_consents(spark, consents_path), "consents", cfg.broadcast_max_bytes), "clientId")
        cells = colocated(as_side(read_cells(spark, cells_path), "cells", cfg.broadcast_max_bytes), "cellId")
        stream_df = decision_stream(messages, consents, cells, cfg, decided=replies_path is None)
        writer_fn = sink if replies_path is None else Decider(sink, cfg, replies_path)
    writer = stream_df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(writer_fn)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)
    with _settings(spark, {STATE_STORE_KEY: cfg.state_store_provider, PARTITIONS_KEY: cfg.state_partitions}):
        return writer.start(), sink


STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"
SUMMARY_PARTITIONS = 1  # the summary has a row per segment and decision


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict) -> Iterator[None]:
    """Settings for the query started within: it runs on a copy of the session
    taken at start, and the session gets its own values back."""
    values = {k: str(v) for k, v in values.items() if v}
    saved = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_rejects(
    spark: SparkSession,
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: CampaignConfig | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """A second query over the same messages that keeps the reject table:
    every message that cleaning drops, with its reason."""
    cfg = cfg or CampaignConfig()
    if not path_exists(spark, f"{checkpoint}/offsets") and batch_ids(spark, path):
        raise ValueError(f"a new checkpoint would overwrite the batches in {path}")
    make_path(spark, path)
    text = messages.withColumn("value", wire.message_text("value"))
    writer = wire.decode(text, keep=["value"]).writeStream.option("checkpointLocation", checkpoint).foreachBatch(RejectSink(path, cfg))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()


_INTAKE = T.StructType([*GEO_EVENT.fields, T.StructField("value", T.StringType()), T.StructField("rejectReason", T.StringType()), T.StructField("rejected", T.BooleanType())])


def start_intake(
    spark: SparkSession,
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: CampaignConfig | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Decode every message once into a Parquet table with two parts: clean
    events (``clean_events``, the pipeline's input) and rejected messages with
    their reason (``read_rejects``). Spark's file sink publishes both parts of
    a micro-batch together and exactly once."""
    cfg = cfg or CampaignConfig()
    make_path(spark, path)
    text = messages.withColumn("value", wire.message_text("value"))
    reason = C.reject_reason("value", cfg.max_ahead)
    decoded = wire.decode(text, keep=["value"]).withColumn("rejectReason", reason).withColumn("rejected", F.col("rejectReason").isNotNull())
    decoded = decoded.observe(CLEANING_METRIC, F.count(F.lit(1)).alias("rowsIn"), F.count_if(~F.col("rejected")).alias("rowsKept"))
    rows = decoded.select(*GEO_EVENT_FIELDS, F.when(F.col("rejected"), F.col("value")).alias("value"), "rejectReason", "rejected")
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet").partitionBy("rejected").option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)).start()


def clean_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The clean part of an intake table as a stream of typed events."""
    reader = spark.readStream.schema(_INTAKE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path).where(~F.col("rejected")).select(*GEO_EVENT_FIELDS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected part of an intake table: the message and its reason."""
    return spark.read.schema(_INTAKE).parquet(path).where("rejected").select("value", "rejectReason")


def start_summary(
    spark: SparkSession,
    feed_path: str,
    path: str,
    checkpoint: str,
    cfg: CampaignConfig | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """A running summary of the published alerts per segment and decision, in
    complete mode: every trigger writes the whole table anew to ``path``. Its
    source is the commit log of the decision sinks, so it moves one small row
    per segment, decision and micro-batch, not the alerts."""
    cfg = cfg or CampaignConfig()
    log = CommitLog(spark, f"{feed_path}/{LOG_FOLDER}")
    make_path(spark, log.path)
    running = log.changes().groupBy("segment", "aiDecision").agg(F.sum("alerts").alias("alerts"))

    def write(table: DataFrame, batch_id: int) -> None:
        write_table(table.where("alerts > 0"), path)

    writer = running.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)
    with _settings(spark, {PARTITIONS_KEY: SUMMARY_PARTITIONS}):
        return writer.start()


def stop_after_batch(query: StreamingQuery, poll_s: float = 0.2) -> None:
    """Stop the query between micro-batches: a running one is completed and
    committed first."""
    running = (query.lastProgress or {}).get("batchId", -1)
    while query.isActive and query.status["isTriggerActive"]:
        if (query.lastProgress or {}).get("batchId", -1) != running:
            break  # that batch is committed; the next has hardly begun
        time.sleep(poll_s)
    query.stop()
