"""Geo events derived from the driver's ``events`` table.

Every row of ``events`` becomes one geo event (some twice), so all queries grow
with the table. Let k = int(props.k), cn = 1 + user_id % 50,
cell = 1 + (7 cn + 3 (event_id div 300)) % 20 and m = event_id % 40:

* clientId   m=7 -> null, m=17 -> '' , else CLIENT_<cn:04d>
* cellId     CELL_<cell:03d>; latitude 40.0, longitude -3.0
* signalDbm  m=7 -> null, else -70 - k % 30
* congestion m=27 -> 101 + k; event_id >= 300 in CELL_003 -> 75 + k % 20;
             event_id >= 300 in CELL_007 -> 70 + k % 25; else 20 + k % 50
* technology 5G when k % 5 < 3, else 4G
* timestamp  2024-01-01T00:00:00Z + 200 ms * event_id
* rows with m=37 appear twice (exact duplicates)

The wire view encodes those events as JSON messages and adds, for some
events, one extra message that must be rejected: cut-off JSON (m=39), a text
congestion (m=19), a fractional congestion (m=29), an empty message (m=9) or
a timestamp out of range (m=3: largest long, smallest long or nanoseconds).
Extras fail cleaning, so they change reject counts but never candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast import schemas
from surgecast.sources import wire

EPOCH_2024_MS = 1704067200000
STEP_MS = 200
SENTINEL_CLIENT = "SENTINEL"
SENTINEL_GAP_MS = 600_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _per_event(events: DataFrame) -> DataFrame:
    """One row per source event: event_id, m, the 8 geo fields."""
    eid = F.col("event_id")
    base = events.select(
        eid,
        F.get_json_object(F.col("props"), "$.k").cast("int").alias("k"),
        (F.lit(1) + F.col("user_id") % 50).alias("cn"),
        (eid % 40).alias("m"),
    ).withColumn("cell", F.lit(1) + (F.col("cn") * 7 + F.expr("event_id div 300") * 3) % 20)
    m, k, cell = F.col("m"), F.col("k"), F.col("cell")
    surge = eid >= 300
    congestion = (
        F.when(m == 27, F.lit(101) + k)
        .when(surge & (cell == 3), F.lit(75) + k % 20)
        .when(surge & (cell == 7), F.lit(70) + k % 25)
        .otherwise(F.lit(20) + k % 50)
    )
    return base.select(
        eid,
        m,
        F.when(m == 7, F.lit(None).cast("string"))
        .when(m == 17, F.lit(""))
        .otherwise(F.format_string("CLIENT_%04d", F.col("cn")))
        .alias("clientId"),
        F.format_string("CELL_%03d", cell).alias("cellId"),
        F.lit(40.0).alias("latitude"),
        F.lit(-3.0).alias("longitude"),
        F.when(m == 7, F.lit(None)).otherwise(F.lit(-70) - k % 30).cast("int").alias("signalDbm"),
        congestion.cast("int").alias("congestion"),
        F.when(k % 5 < 3, F.lit("5G")).otherwise(F.lit("4G")).alias("technology"),
        (F.lit(EPOCH_2024_MS) + eid * STEP_MS).cast("long").alias("timestamp"),
    )


def _bad_timestamp() -> Column:
    """By event_id div 40: largest long, smallest long, nanoseconds."""
    kind = F.expr("(event_id div 40) % 3")
    nanos = F.concat(F.col("timestamp").cast("string"), F.lit("000000"))
    return F.when(kind == 0, F.lit("9223372036854775807")).when(kind == 1, F.lit("-9223372036854775808")).otherwise(nanos)


def _copies(m: Column, item: Column) -> Column:
    """array of 1 or 2 copies of ``item`` (m=37 rows are sent twice)."""
    return F.when(m == 37, F.array(item, item)).otherwise(F.array(item))


def geo_events(events: DataFrame) -> DataFrame:
    """The 8-field geo events (duplicates included) derived from ``events``."""
    pe = _per_event(events)
    row = F.struct(*[F.col(f) for f in schemas.GEO_EVENT_FIELDS])
    # duplicate copies by a generator: narrow, no second scan, no union
    return pe.select(F.explode(_copies(F.col("m"), row)).alias("g")).select("g.*")


def wire_messages(events: DataFrame) -> DataFrame:
    """JSON messages for all geo events plus the malformed extras.

    Columns: key, value (JSON text), ts (epoch ms of the source event, used
    to cut the messages into time-ordered files for streaming runs).
    """
    pe = _per_event(events).withColumn("value", wire.event_json())
    m = F.col("m")
    key = wire.message_key()
    good = F.struct(key.alias("key"), F.col("value").alias("value"))
    v = F.col("value")
    bad_value = (
        F.when(m == 39, F.expr("substring(value, 1, length(value) div 2)"))
        .when(m == 19, F.regexp_replace(v, '"congestion":[^,]*', '"congestion":"abc"'))
        .when(m == 29, F.regexp_replace(v, '"congestion":[^,]*', '"congestion":55.5'))
        .when(m == 3, F.regexp_replace(v, F.lit('"timestamp":[0-9]+'), F.concat(F.lit('"timestamp":'), _bad_timestamp())))
        .otherwise(F.lit(""))
    )
    bad = F.struct(key.alias("key"), bad_value.alias("value"))
    msgs = (
        F.when(m == 37, F.array(good, good))
        .when(m.isin(3, 9, 19, 29, 39), F.array(good, bad))
        .otherwise(F.array(good))
    )
    return pe.select(F.col("timestamp").alias("ts"), F.explode(msgs).alias("msg")).select(
        "msg.key", "msg.value", "ts"
    )


FUTURE_MS = 6000 * 31_556_952_000  # 6000 years


def future_messages(events: DataFrame) -> DataFrame:
    """For each event with m=13 one more message, valid but for its time, 6000
    years later: it would move a watermark past everything else."""
    late = _per_event(events).where(F.col("m") == 13).withColumn("timestamp", F.col("timestamp") + F.lit(FUTURE_MS))
    return late.select(wire.message_key().alias("key"), wire.event_json().alias("value"))


def conflicting_events(events: DataFrame) -> DataFrame:
    """The geo events and, for m=23, a second one of the same client, cell and
    time with other values (100 less its congestion, signal one less, the other
    technology)."""
    other = _per_event(events).where(F.col("m") == 23)
    changed = other.withColumns(
        {
            "congestion": (F.lit(100) - F.col("congestion")).cast("int"),
            "signalDbm": (F.col("signalDbm") - 1).cast("int"),
            "technology": F.when(F.col("technology") == "5G", F.lit("4G")).otherwise(F.lit("5G")),
        }
    )
    return geo_events(events).unionByName(changed.select(*schemas.GEO_EVENT_FIELDS))


def sentinel_message(events: DataFrame) -> DataFrame:
    """One valid message 600 s after the last event, for a client with no
    consent row: it passes cleaning, advances the watermark past every open
    window, and can never become a candidate."""
    last = events.select(F.max("event_id").alias("last_id"))
    ts = (F.lit(EPOCH_2024_MS) + F.col("last_id") * STEP_MS + F.lit(SENTINEL_GAP_MS)).cast("long")
    ev = last.select(
        F.lit(SENTINEL_CLIENT).alias("clientId"),
        F.lit("CELL_001").alias("cellId"),
        F.lit(40.0).alias("latitude"),
        F.lit(-3.0).alias("longitude"),
        F.lit(-80).cast("int").alias("signalDbm"),
        F.lit(0).cast("int").alias("congestion"),
        F.lit("5G").alias("technology"),
        ts.alias("timestamp"),
    )
    return ev.select(wire.message_key().alias("key"), wire.event_json().alias("value"), F.col("timestamp").alias("ts"))
