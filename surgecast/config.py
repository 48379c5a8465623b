"""Pipeline parameters.

Defaults follow the reference program's code (not its comments): a 2-minute
window sliding by 30 s, a 30 s watermark, 1000 offsets per trigger, a 15 s
processing-time trigger and reading the topic from the earliest offset.
Every optional rule the reference only names as an exercise is off by default.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class CampaignConfig:
    # windowing / state
    window_duration: str = "2 minutes"
    slide_duration: str = "30 seconds"  # equal to window_duration -> tumbling
    watermark_delay: str = "30 seconds"
    # batch plans: aggregate windows where they start, behind one shuffle on
    # (client, cell, time bucket) instead of a shuffle of partial aggregates
    colocate_windows: bool = True
    # de-duplicate as a grouped aggregation (copies combine before the
    # shuffle, also in streams); False uses Spark's dropDuplicates operator
    combine_copies: bool = True

    # optional rules (all off by default, as in the reference's main program)
    min_events: int | None = None  # eventCount >= n in the window
    require_target_cell: bool = False  # cellId must be in the client's targetCells
    signal_floor_dbm: int | None = None  # no SMS when avgSignalDbm < floor

    # joins: broadcast a static side only when its measured size fits this bound.
    # None -> use spark.sql.autoBroadcastJoinThreshold of the session.
    broadcast_max_bytes: int | None = None
    # Filter events on eligible clients / cells before the stateful stages
    # (semantics preserving for the candidate chain, at any table size).
    prefilter_eligible: bool = True

    # events more than this ahead of the processing time are rejected before
    # the watermark sees them; empty: no bound
    max_ahead: str | None = "1 hour"

    # replies of an outside decision service count when they came at most this
    # long after their window's end
    reply_lateness: str = "5 minutes"

    # streaming
    trigger_interval: str = "15 seconds"
    max_offsets_per_trigger: int = 1000
    starting_offsets: str = "earliest"
    # the sinks write ceil(rows / this) files per micro-batch
    rows_per_file: int = 500_000
    kafka_bootstrap: str = "localhost:9092"
    events_topic: str = "geo-events"
    alerts_topic: str = "campaign-alerts"
    state_store_provider: str | None = None  # e.g. ROCKSDB_STATE_STORE for large key sets
    # shuffle and state partitions of the stream, frozen at its first start;
    # none: the session's number
    state_partitions: int | None = None

    def with_(self, **kw) -> "CampaignConfig":
        return replace(self, **kw)

    @property
    def is_tumbling(self) -> bool:
        return self.window_duration == self.slide_duration
