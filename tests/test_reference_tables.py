"""Golden facts of the consent and cell tables, re-runnable writes and the
size bound used to decide broadcasts."""

from collections import Counter

from pyspark.sql import functions as F

from surgecast.operators.joins import measure
from surgecast.sources.reference_tables import (
    build_cells,
    build_consents,
    cells_side,
    consents_side,
    read_cells,
    read_consents,
    setup_tables,
    write_table,
)


def test_consents_golden(spark):
    rows = build_consents(spark).orderBy("clientId").collect()
    assert len(rows) == 50
    first = rows[0]
    assert (first.clientId, first.hasConsent, first.segment, first.campaignsSent) == ("CLIENT_0001", True, "PREMIUM", 1)
    assert first.targetCells == ",".join(f"CELL_{i:03d}" for i in range(4, 12))
    assert sum(r.hasConsent for r in rows) == 45
    assert Counter(r.segment for r in rows) == {"PREMIUM": 17, "STANDARD": 25, "BASIC": 8}
    assert Counter(r.segment for r in rows if r.hasConsent) == {"PREMIUM": 16, "STANDARD": 21, "BASIC": 8}
    assert Counter(r.campaignsSent for r in rows) == {0: 12, 1: 13, 2: 13, 3: 12}
    cap = {"PREMIUM": 5, "STANDARD": 3, "BASIC": 2}
    assert Counter(r.segment for r in rows if r.hasConsent and r.campaignsSent < cap[r.segment]) == {
        "PREMIUM": 16,
        "STANDARD": 17,
        "BASIC": 4,
    }
    n_by_seg = {"PREMIUM": 8, "STANDARD": 5, "BASIC": 3}
    for i, r in enumerate(rows, start=1):
        n = n_by_seg[r.segment]
        off = (3 * i) % (20 - n)
        assert r.targetCells.split(",") == [f"CELL_{j:03d}" for j in range(off + 1, off + n + 1)]


def test_cells_golden(spark):
    rows = {r.cellId: r for r in build_cells(spark).collect()}
    assert len(rows) == 20
    assert sum(r.campaignActive for r in rows.values()) == 16
    assert {c for c, r in rows.items() if not r.campaignActive} == {"CELL_001", "CELL_006", "CELL_011", "CELL_016"}
    assert Counter(r.congestionThreshold for r in rows.values()) == {60: 7, 70: 7, 80: 6}
    assert (rows["CELL_003"].city, rows["CELL_003"].zone, rows["CELL_003"].congestionThreshold) == ("Madrid", "Retiro", 80)
    assert (rows["CELL_007"].city, rows["CELL_007"].zone, rows["CELL_007"].congestionThreshold) == ("Sevilla", "Centro", 60)


def test_rerunnable_write(spark, scratch):
    paths = setup_tables(spark, scratch)
    setup_tables(spark, scratch)  # second run: replaces, does not fail or duplicate
    assert read_consents(spark, paths["consents"]).count() == 50
    assert read_cells(spark, paths["cells"]).count() == 20
    write_table(build_cells(spark), paths["cells"])
    assert read_cells(spark, paths["cells"]).count() == 20


def test_construction_bound_covers_measured_size(spark):
    for bound, df in ((consents_side(spark), build_consents(spark)), (cells_side(spark), build_cells(spark))):
        m = measure(df, "x")
        assert m.rows == bound.rows
        assert m.bytes <= bound.bytes
    big = consents_side(spark, n_clients=5000)
    assert big.bytes >= measure(build_consents(spark, n_clients=5000), "x").bytes
    assert build_consents(spark, n_clients=5000).where(F.col("clientId") == "CLIENT_5000").count() == 1
