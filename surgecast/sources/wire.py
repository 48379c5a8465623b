"""JSON wire format of geo events: decode (bytes/text -> columns) and encode.

Decode parses each message exactly once. ``from_json(...)`` followed by
``select('e.*')`` is collapsed by the optimizer into one ``from_json`` per
referenced field, and every predicate pushed below the projection repeats
the parse. A one-element generator (``explode(array(from_json(...)))``) is an
optimizer barrier: one parse per message, and a message that cannot be parsed
still yields a row (all nulls) for the reject table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast import schemas
from surgecast.functions import fixed_values as FV
from surgecast.functions.columns import event_time

CORRUPT_COL = "_corrupt_record"

_DECODE_SCHEMA = T.StructType(schemas.GEO_EVENT.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
_DECODE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def message_text(value: str | Column = "value") -> Column:
    """Message payload as text (a Kafka value is binary)."""
    c = F.col(value) if isinstance(value, str) else value
    return c.cast("string")


def decode(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Messages -> the 8 event fields, ``eventTime`` and ``_corrupt_record``.

    ``keep`` lists extra input columns to carry along (e.g. the raw text for a
    reject table, or Kafka partition/offset).
    """
    keep = list(keep or [])
    parsed = messages.select(
        *[F.col(k) for k in keep],
        F.explode(F.array(F.from_json(message_text(value_col), _DECODE_SCHEMA, _DECODE_OPTIONS))).alias("e"),
    )
    return parsed.select(
        *[F.col(k) for k in keep],
        *[F.col(f"e.{f}").alias(f) for f in schemas.GEO_EVENT_FIELDS],
        F.col(f"e.{CORRUPT_COL}").alias(CORRUPT_COL),
    ).withColumn("eventTime", event_time("timestamp"))


def event_json() -> Column:
    """JSON text of the 8 event fields in declared order, explicit nulls."""
    return F.to_json(F.struct(*[F.col(f) for f in schemas.GEO_EVENT_FIELDS]), {"ignoreNullFields": "false"})


def message_key() -> Column:
    """Message key: the client id, or the fixed null key."""
    return F.coalesce(F.col("clientId"), F.lit(FV.NULL_KEY))


def encode(events: DataFrame) -> DataFrame:
    """Events -> (key, value) messages as the producer writes them."""
    return events.select(message_key().alias("key"), event_json().alias("value"))
