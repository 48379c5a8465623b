"""Watermark and de-duplication.

Duplicates are events with the same (clientId, cellId, eventTime), eventTime
at millisecond precision; one of them is kept, whole.

``dedup`` is written as a grouped aggregation keeping, of all copies, the row
that is smallest in the other columns (in their order, null first). Unequal
copies of a key so give the same row in whatever order tasks see them;
``first`` or ``dropDuplicates`` would keep whichever a task sees first. In a
stream a copy of an earlier micro-batch goes before those of later ones (the
batch's time comes first in that order, and a replay keeps it), as the first
to come does with ``dropDuplicates``. There it also combines partially before
its shuffle, so all copies of a key in
one input task collapse to one row there, while Spark's streaming
de-duplication operator ships every copy to the key's task. Even a group of
copies holding a large share of a micro-batch then costs one row per task.
Because event time is a grouping key, state is evicted (and the row passed
on) once the watermark passes it; windows downstream close on the same
watermark, so alerts are not delayed. ``combine=False`` uses
``dropDuplicates`` instead, which keeps any one of unequal copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUP_KEYS = ["clientId", "cellId", "eventTime"]


def with_watermark(events: DataFrame, delay: str = "30 seconds", time_col: str = "eventTime") -> DataFrame:
    """Declare the event-time watermark. Declare it once per plan: Spark
    refuses a second definition downstream."""
    return events.withWatermark(time_col, delay)


def dedup(events: DataFrame, keys: list[str] | None = None, combine: bool = True) -> DataFrame:
    keys = keys or DEDUP_KEYS
    if not combine:
        return events.dropDuplicates(keys)
    columns = events.columns
    others = [c for c in columns if c not in keys]
    order = others
    if events.isStreaming:
        events, order = events.withColumn("_arrived", F.current_timestamp()), ["_arrived", *others]
    least = events.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_least"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_least.{c}").alias(c) for c in columns])
