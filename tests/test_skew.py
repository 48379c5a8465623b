"""Hot keys: one group holding a third of all rows.

* a group of exact copies (same client, cell and event time) spread over
  every input partition: de-duplication keeps one row of it and leaves every
  other row as it was;
* one (client, cell) with a third of all events at distinct times: the
  co-located batch windows equal Spark's ``window()`` form, row for row.
"""

from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.operators import clean as C
from surgecast.operators import dedup as DD
from surgecast.operators import windows as W
from surgecast.plans import catalog
from tests.conftest import SF_MID
from tests.helpers import spark_rows


def _events(spark):
    return C.clean(catalog.events_for(spark, SF_MID))


def _as_literals(row, columns):
    return [F.lit(row[c]).alias(c) for c in columns]


def test_hot_copy_group_dedups_to_one_row(spark):
    ev = _events(spark)
    n = ev.count()
    hot_row = ev.orderBy("eventTime", "clientId").first()
    # n / 2 copies of one event over 8 input partitions: a third of all rows
    hot = spark.range(0, n // 2, numPartitions=8).select(*_as_literals(hot_row, ev.columns))
    skewed = ev.unionByName(hot)
    assert skewed.count() == n + n // 2

    got = DD.dedup(skewed)
    assert spark_rows(got) == spark_rows(DD.dedup(ev))
    key = (F.col("clientId") == hot_row["clientId"]) & (F.col("cellId") == hot_row["cellId"]) & (
        F.col("eventTime") == hot_row["eventTime"]
    )
    assert got.where(key).count() == 1


def test_hot_client_cell_windows_match_window_function(spark):
    ev = _events(spark)
    n = ev.count()
    base = ev.orderBy("eventTime", "clientId").first()
    t0 = int(base["eventTime"].timestamp() * 1000)
    # n / 2 events of one (client, cell), 200 ms apart and 100 ms off the
    # fixture's 200 ms grid (no key collides with an existing event)
    ids = spark.range(0, n // 2, numPartitions=8)
    hot_cols = {
        "eventTime": F.timestamp_millis(F.lit(t0 + 100) + F.col("id") * 200),
        "congestion": (F.lit(base["congestion"]) + F.col("id") % 13).cast("int"),
    }
    hot = ids.select(*[hot_cols.get(c, F.lit(base[c])).alias(c) for c in ev.columns])
    d = DD.dedup(ev.unionByName(hot))

    cfg = CampaignConfig()
    colocated = catalog.flat(W.window_aggregate(d, cfg))
    standard = catalog.flat(W.window_aggregate(d, cfg.with_(colocate_windows=False)))
    assert spark_rows(colocated) == spark_rows(standard)
    pair = (F.col("clientId") == base["clientId"]) & (F.col("cellId") == base["cellId"])
    hot_windows = colocated.where(pair).agg(F.sum("eventCount").alias("s"), F.count(F.lit(1)).alias("w")).first()
    hot_events = d.where(pair).count()
    assert hot_events >= n // 2
    # every event lands in exactly 4 sliding windows (2 min / 30 s)
    assert hot_windows["s"] == 4 * hot_events
    assert hot_windows["w"] > 4
