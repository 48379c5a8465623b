"""The eligibility filter keeps the same rows whatever the tables' size."""

import pytest

from surgecast import schemas
from surgecast.config import CampaignConfig
from surgecast.operators import dedup as DD
from surgecast.operators import enrich as E
from surgecast.operators.joins import as_side, runtime_filter_conf
from surgecast.plans import catalog
from surgecast.plans.chain import campaign_plan
from surgecast.sources.reference_tables import build_cells, build_consents, read_cells, read_consents, setup_tables
from tests.conftest import SF_SMALL
from tests.helpers import spark_rows


@pytest.fixture()
def shuffled(spark):
    """No broadcasts, and a Bloom filter for inputs of any size."""
    conf = runtime_filter_conf(input_bytes=0) | {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(spark, limit):
    cfg = CampaignConfig(broadcast_max_bytes=limit)
    return campaign_plan(catalog.events_for(spark, SF_SMALL), build_consents(spark), build_cells(spark), cfg)


def test_frames_are_equal_at_any_bound(spark, shuffled):
    small, large = plan(spark, 64 << 20), plan(spark, 0)
    assert small.consents.broadcastable and not large.consents.broadcastable
    for frame in ("deduped", "aggregated", "candidates", "decisions"):
        a, b = getattr(small, frame), getattr(large, frame)
        a, b = (catalog.flat(x) if "window" in x.columns else x for x in (a, b))
        assert spark_rows(a) == spark_rows(b), frame
    everything = DD.dedup(catalog.C.clean(catalog.events_for(spark, SF_SMALL))).count()
    assert 0 < small.deduped.count() < everything  # it does drop rows


def test_large_tables_filter_rows_before_the_shuffle(spark, scratch, shuffled):
    tables = setup_tables(spark, scratch)
    catalog.events_for(spark, SF_SMALL).write.parquet(f"{scratch}/events")
    events = spark.read.parquet(f"{scratch}/events")
    consents, cells = as_side(read_consents(spark, tables["consents"]), "consents", 0), as_side(read_cells(spark, tables["cells"]), "cells", 0)
    kept = E.eligible_events(events, consents, cells)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 2 and text.count("LeftSemi") == 2 and "Broadcast" not in text
    assert "might_contain" in text  # Spark's Bloom filter of the eligible keys
    scan = text[: text.index("FileScan")]
    assert scan.rindex("might_contain") > scan.rindex("Exchange hashpartitioning(clientId") or "might_contain" in text[text.rindex("Exchange hashpartitioning(clientId") :]
    want = E.eligible_events(events, as_side(build_consents(spark), "consents", 64 << 20), as_side(build_cells(spark), "cells", 64 << 20))
    assert spark_rows(kept) == spark_rows(want)


def test_repeated_and_null_keys_in_the_tables(spark, shuffled):
    """A client listed twice does not double its events; null keys match nothing."""
    consents = build_consents(spark).unionByName(build_consents(spark))
    nulls = spark.createDataFrame([(None, True, "PREMIUM", "", 0)], schemas.CONSENT)
    events = catalog.events_for(spark, SF_SMALL)
    for limit in (0, 64 << 20):
        sides = as_side(consents.unionByName(nulls), "consents", limit), as_side(build_cells(spark), "cells", limit)
        once = as_side(build_consents(spark), "consents", limit), as_side(build_cells(spark), "cells", limit)
        assert spark_rows(E.eligible_events(events, *sides)) == spark_rows(E.eligible_events(events, *once))
