"""Bounded stream runs over the driver's ``events`` table.

The events are encoded as JSON messages (with the malformed extras) and
written as time-ordered slices, each by one parallel job; a final slice holds
the sentinel event that closes every open window. The streaming pipeline then
runs with ``availableNow`` and one slice per micro-batch, late-data rules and
state included, over the whole table. A slice holds about ``EVENTS_PER_BATCH``
events at most, so a larger table makes more micro-batches, not larger ones;
and the stream has as many state partitions as such a micro-batch needs, since
every task reports on all state partitions of its query to the driver.

``replay_full`` runs every optional part too: messages of a far future among
the others, the intake that decodes once, a reply table, the running summary.

Everything lives under the session's shared checkpoint folder.
"""

from __future__ import annotations

import contextlib
import io
import itertools
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surgecast.config import CampaignConfig
from surgecast.session import delete_path, file_states, work_path
from surgecast.sources import fixtures as FX
from surgecast.sources.reference_tables import build_cells, build_consents, write_replies, write_table
from surgecast.streaming.runner import clean_events, start_intake, start_pipeline, start_summary
from surgecast.streaming.sources import file_messages

log = logging.getLogger(__name__)

_RUNS: dict[tuple, "ReplayRun"] = {}


@dataclass
class ReplayRun:
    work: str
    inbox: str
    feed_path: str
    sent_path: str
    checkpoint: str
    tallies: list = field(default_factory=list)
    progress: list = field(default_factory=list)
    plan: str = ""
    intake_plan: str = ""

    @property
    def intake_path(self) -> str:
        return f"{self.work}/intake"

    @property
    def summary_path(self) -> str:
        return f"{self.work}/summary"


BYTES_PER_FILE = 128 << 20
MESSAGE_BYTES = 220  # of one event as JSON, about
EVENTS_PER_BATCH = 2_000_000
EVENTS_PER_STATE_PARTITION = 50_000


def write_inbox(spark: SparkSession, sf_dir: str, inbox: str, n_slices: int = 5, future: bool = False) -> int:
    """Write the event messages as at most ``n_slices`` time-ordered slices plus
    one with the sentinel; returns the files of a slice (see ``inbox_slices``)."""
    return max(inbox_slices(spark, sf_dir, inbox, n_slices, future))


def inbox_slices(spark: SparkSession, sf_dir: str, inbox: str, n_slices: int, future: bool = False) -> Iterator[int]:
    """Write the slices one by one, the sentinel's last; after each, give the
    files of a slice.

    Slices begin at quantiles of event_id, so each has rows, and about as many
    as the others, however sparse or repeated the ids are. The events are dealt
    to them in one pass over the table. A slice is one parallel job into the
    same number of files, sized by the table (``BYTES_PER_FILE``), so a
    micro-batch of that many files is one slice; the files' times put the slices
    in order. Rows without event_id go with the first slice. With ``future``
    every slice has messages of a far future, too.
    """
    events = FX.read_events(spark, sf_dir)
    n = events.count()
    known = events.where(F.col("event_id").isNotNull())
    cuts = sorted({int(q) for q in known.approxQuantile("event_id", [i / n_slices for i in range(n_slices)], min(0.01, 0.1 / n_slices))})
    files = max(1, -(-n * MESSAGE_BYTES // (n_slices * BYTES_PER_FILE)))
    later = F.array(*[F.lit(c).cast("long") for c in cuts[1:]]) if cuts[1:] else F.array().cast("array<bigint>")
    dealt = events.withColumn("_slice", F.size(F.filter(later, lambda c: c <= F.col("event_id"))))
    staged = work_path(spark, "slices")
    dealt.hint("rebalance", F.col("_slice")).write.partitionBy("_slice").parquet(staged)
    for i in range(max(1, len(cuts))):
        part = spark.read.schema(dealt.schema).parquet(staged).where(F.col("_slice") == i).drop("_slice")
        messages = FX.wire_messages(part).select("value")
        if future:
            messages = messages.unionByName(FX.future_messages(part).select("value"))
        messages.repartition(files).write.mode("overwrite").text(f"{inbox}/slice-{i:05d}")
        if i + 1 < len(cuts):
            yield files
    FX.sentinel_message(events).select("value").coalesce(1).write.mode("overwrite").text(f"{inbox}/slice-{n_slices:05d}-sentinel")
    delete_path(spark, staged)
    yield files


def _batches(spark: SparkSession, sf_dir: str, n_slices: int, cfg: CampaignConfig) -> tuple[int, int, CampaignConfig]:
    """How many slices the table makes, how many of them one micro-batch may
    hold, and the settings with the state partitions that such a one needs (at
    most the session's number of shuffle partitions)."""
    n = max(1, FX.read_events(spark, sf_dir).count())
    slices = max(n_slices, -(-n // EVENTS_PER_BATCH))
    together = max(1, EVENTS_PER_BATCH * slices // n)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-min(n, EVENTS_PER_BATCH) // EVENTS_PER_STATE_PARTITION)
    return slices, together, cfg if cfg.state_partitions else cfg.with_(state_partitions=min(most, needed))


def replay_events_stream(
    spark: SparkSession,
    sf_dir: str,
    n_slices: int = 5,
    cfg: CampaignConfig | None = None,
    refresh_tables: bool = False,
    reuse: bool = True,
) -> ReplayRun:
    """Run the streaming pipeline to completion over ``events``. A run is
    reused only while the table's files are the same (path, length, time).
    Fails if the watermark dropped an event: the slices are in order, so none
    may be late."""
    cfg = cfg or CampaignConfig()
    state = tuple(file_states(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    key = (spark.sparkContext.applicationId, sf_dir, state, n_slices, cfg, refresh_tables)
    if reuse and key in _RUNS:
        return _RUNS[key]
    work = work_path(spark, "replay")
    run = ReplayRun(
        work=work,
        inbox=f"{work}/inbox",
        feed_path=f"{work}/dashboard-feed",
        sent_path=f"{work}/sent",
        checkpoint=f"{work}/checkpoint",
    )
    tables = f"{work}/tables"
    write_table(build_consents(spark), f"{tables}/consents")
    write_table(build_cells(spark), f"{tables}/cells")
    slices, _, cfg = _batches(spark, sf_dir, n_slices, cfg)
    files = write_inbox(spark, sf_dir, run.inbox, slices)
    q, sink = _start(spark, run, tables, cfg, refresh_tables, files)
    _finish(q)
    run.tallies = list(sink.tallies)
    run.progress = list(q.recentProgress)  # one per slice and one or two more
    _none_late(run)
    run.plan = _explained(q)
    _RUNS[key] = run
    return run


def replay_full(spark: SparkSession, sf_dir: str, replies: Callable[[], DataFrame], n_slices: int = 5, reuse: bool = True) -> ReplayRun:
    """Run the pipeline with all its optional parts over ``events``; one hop
    after the other, each with ``availableNow``, over as many slices at a time
    as one micro-batch may hold (the pipeline takes all that the intake has
    added as one: of a slice no part may be read before another)."""
    cfg = CampaignConfig()
    state = tuple(file_states(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    key = (spark.sparkContext.applicationId, sf_dir, state, n_slices, "full")
    if reuse and key in _RUNS:
        return _RUNS[key]
    work = work_path(spark, "replay-full")
    run = ReplayRun(work=work, inbox=f"{work}/inbox", feed_path=f"{work}/dashboard-feed", sent_path=f"{work}/sent", checkpoint=f"{work}/checkpoint")
    tables = f"{work}/tables"
    write_table(build_consents(spark), f"{tables}/consents")
    write_table(build_cells(spark), f"{tables}/cells")
    write_replies(replies(), f"{work}/replies")
    slices, together, cfg = _batches(spark, sf_dir, n_slices, cfg)
    written = inbox_slices(spark, sf_dir, run.inbox, slices, future=True)
    while taken := list(itertools.islice(written, together)):
        intake = start_intake(spark, file_messages(spark, f"{run.inbox}/*", taken[0]), run.intake_path, f"{work}/intake-checkpoint", cfg, available_now=True)
        _finish(intake)
        q, sink = start_pipeline(
            spark,
            clean_events(spark, run.intake_path),
            f"{tables}/consents",
            f"{tables}/cells",
            run.feed_path,
            run.sent_path,
            run.checkpoint,
            cfg,
            available_now=True,
            replies_path=f"{work}/replies",
        )
        _finish(q)
        run.tallies.extend(sink.tallies)
        run.progress.extend(q.recentProgress)
        _none_late(run)
        run.intake_plan = _explained(intake)
    _finish(start_summary(spark, run.feed_path, run.summary_path, f"{work}/summary-checkpoint", cfg, available_now=True))
    _RUNS[key] = run
    return run


def _none_late(run: ReplayRun) -> None:
    late = sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in run.progress for op in p["stateOperators"])
    if late:
        raise RuntimeError(f"{late} events came after the watermark: the slices were read out of order")


def _finish(q: StreamingQuery) -> None:
    """Wait for a bounded run; raises what ended it."""
    try:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()


def _explained(q: StreamingQuery) -> str:
    """The physical plan of the last micro-batch."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        q.explain()
    return out.getvalue()


def _start(spark, run, tables, cfg, refresh_tables, files):
    return start_pipeline(
        spark,
        file_messages(spark, f"{run.inbox}/*", max_files_per_trigger=files),
        f"{tables}/consents",
        f"{tables}/cells",
        run.feed_path,
        run.sent_path,
        run.checkpoint,
        cfg,
        available_now=True,
        refresh_tables=refresh_tables,
    )
