"""The whole batch chain against a brute-force evaluation in plain Python on
random small event sets (hypothesis)."""

import math
from collections import Counter, defaultdict

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from surgecast.plans.chain import campaign_plan
from surgecast.sources.reference_tables import build_cells, build_consents, cells_side, consents_side
from tests.test_decide import expected as policy

T0 = 1704067200000
SLIDE, SIZE = 30_000, 120_000

EVENT_SCHEMA = (
    "clientId string, cellId string, latitude double, longitude double, "
    "signalDbm int, congestion int, technology string, timestamp long"
)

def rarely_none(strategy):
    """``strategy``, or None one time in ten."""
    return st.integers(0, 9).flatmap(lambda r: st.none() if r == 0 else strategy)


clients = st.sampled_from(
    ["CLIENT_0001", "CLIENT_0002", "CLIENT_0003", "CLIENT_0006", "CLIENT_0010", "CLIENT_0012"] * 3 + ["", None]
)
cells = st.sampled_from(["CELL_002", "CELL_003", "CELL_006", "CELL_007", "CELL_009"])
event = st.tuples(
    clients,
    cells,
    st.integers(min_value=0, max_value=240),  # seconds
    st.integers(min_value=0, max_value=999),  # ms
    rarely_none(st.integers(min_value=-110, max_value=-60)),
    rarely_none(st.one_of(st.integers(min_value=-5, max_value=110), st.integers(min_value=58, max_value=100))),
    st.sampled_from(["4G", "5G"]),
    st.booleans(),  # send an exact copy too
)

# known to give SEND (CLIENT_0001 PREMIUM at 90 in CELL_007) and SKIP (CLIENT_0003 STANDARD, 3 sent)
KNOWN = [
    ("CLIENT_0001", "CELL_007", 10, 0, -80, 90, "5G", True),
    ("CLIENT_0001", "CELL_007", 40, 5, -81, 88, "4G", False),
    ("CLIENT_0003", "CELL_002", 100, 0, -90, 95, "4G", False),
    ("CLIENT_0010", "CELL_002", 100, 0, -90, 95, "4G", False),
    (None, "CELL_002", 100, 1, None, 95, "4G", False),
]


def brute_alerts(events, consents, cells_tbl):
    valid = [
        e
        for e in events
        if e[0] is not None and e[0] != "" and e[4] is not None and e[5] is not None and 0 <= e[5] <= 100
    ]
    unique = {}
    for e in valid:
        unique.setdefault((e[0], e[1], e[7]), e)  # copies are exact: any one
    groups = defaultdict(list)
    for e in unique.values():
        base = (e[7] // SLIDE) * SLIDE
        for o in range(SIZE // SLIDE):
            groups[(base - o * SLIDE, e[0], e[1])].append(e)
    out = Counter()
    for (ws, client, cell), evs in groups.items():
        avg_c = math.trunc(sum(e[5] for e in evs) / len(evs))
        tech = max(evs, key=lambda e: e[7])[6]
        c = consents.get(client)
        k = cells_tbl.get(cell)
        if c is None or not c["hasConsent"] or k is None or not k["campaignActive"]:
            continue
        if avg_c < k["congestionThreshold"]:
            continue
        decision, reason, sms = policy(c["segment"], avg_c, c["campaignsSent"], tech)
        out[(client, cell, k["city"], avg_c, tech, c["segment"], decision, reason, sms)] += 1
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40))
@example(KNOWN)
def test_chain_equals_bruteforce(spark, raw):
    events = []
    for client, cell, sec, ms, sig, cong, tech, copy in raw:
        e = (client, cell, 40.0, -3.0, sig, cong, tech, T0 + sec * 1000 + ms)
        events.append(e)
        if copy:
            events.append(e)
    # keep keys unique apart from exact copies (the survivor of differing
    # duplicates is unspecified)
    seen, uniq = {}, []
    for e in events:
        k = (e[0], e[1], e[7])
        if k in seen and seen[k] != e:
            continue
        seen[k] = e
        uniq.append(e)
    df = spark.createDataFrame(uniq, EVENT_SCHEMA)
    plan = campaign_plan(df, consents_side(spark), cells_side(spark))
    got = Counter(
        tuple(r)
        for r in plan.alerts(with_stamp=False)
        .select("clientId", "cellId", "city", "congestion", "technology", "segment", "aiDecision", "aiReasoning", "smsText")
        .collect()
    )
    consents = {r.clientId: r.asDict() for r in build_consents(spark).collect()}
    cells_tbl = {r.cellId: r.asDict() for r in build_cells(spark).collect()}
    assert got == brute_alerts(uniq, consents, cells_tbl)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=5, max_size=60))
@example(KNOWN)
def test_stream_equals_bruteforce(spark, raw):
    """Random events as 3 time-ordered JSON files and a sentinel, streamed
    through the pipeline: alerts equal the brute-force evaluation."""
    import tempfile

    from surgecast.config import CampaignConfig
    from surgecast.operators import reports as R
    from surgecast.sources import wire
    from surgecast.sources.reference_tables import setup_tables
    from surgecast.streaming.runner import start_pipeline
    from surgecast.streaming.sources import file_messages

    base = tempfile.mkdtemp(prefix="surgecast-prop-")
    events, seen = [], {}
    for client, cell, sec, ms, sig, cong, tech, copy in raw:
        e = (client, cell, 40.0, -3.0, sig, cong, tech, T0 + sec * 1000 + ms)
        k = (e[0], e[1], e[7])
        if k in seen and seen[k] != e:
            continue
        seen[k] = e
        events += [e, e] if copy else [e]
    events.sort(key=lambda e: e[7])
    cuts = [T0 + 80_000, T0 + 160_000]
    parts = [
        [e for e in events if e[7] < cuts[0]],
        [e for e in events if cuts[0] <= e[7] < cuts[1]],
        [e for e in events if e[7] >= cuts[1]],
        [("SENTINEL", "CELL_001", 40.0, -3.0, -80, 0, "5G", T0 + 2_000_000)],
    ]
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, EVENT_SCHEMA)
        wire.encode(df).select("value").coalesce(1).write.mode("overwrite").text(f"{base}/inbox/f{i}")
    tables = setup_tables(spark, f"{base}/tables")
    q, _ = start_pipeline(
        spark,
        file_messages(spark, f"{base}/inbox/*", max_files_per_trigger=1),
        tables["consents"],
        tables["cells"],
        f"{base}/feed",
        f"{base}/sent",
        f"{base}/checkpoint",
        CampaignConfig(),
        available_now=True,
    )
    assert q.awaitTermination(300) and q.exception() is None
    import os

    got = Counter()
    if os.path.exists(f"{base}/feed"):
        got = Counter(
            tuple(r)
            for r in R.read_feed(spark, f"{base}/feed")
            .select("clientId", "cellId", "city", "congestion", "technology", "segment", "aiDecision", "aiReasoning", "smsText")
            .collect()
        )
    consents = {r.clientId: r.asDict() for r in build_consents(spark).collect()}
    cells_tbl = {r.cellId: r.asDict() for r in build_cells(spark).collect()}
    assert got == brute_alerts(events, consents, cells_tbl)
