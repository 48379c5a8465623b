"""Rows that repeat by the thousand, and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from surgecast.llm import mixing as M
from surgecast.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, source string"


def words(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


def rows_of_sources():
    """Sources a to d; c is one row a thousand times, d has two such rows."""
    rows = [(i, words(20 + i % 7), "a") for i in range(60)]
    rows += [(100 + i, words(15 + i % 11), "b") for i in range(900)]
    rows += [(5000, words(100), "c")] * 1000
    rows += [(6000, words(40), "d")] * 400 + [(6001, words(30, "v"), "d")] * 300 + [(None, words(25), "d")] * 200 + [(6002, "", "d")] * 50
    return rows


@pytest.mark.parametrize("cells", [M.CELLS, 1])
def test_targets_are_met_among_repeated_rows(spark, cells):
    df = spark.createDataFrame(rows_of_sources(), SCHEMA).repartition(7)
    got = M.copies(df, cells=cells).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows"), F.max("copies").alias("most")).collect()
    assert {r["source"]: r["rows"] for r in got} == {"a": 60, "b": 900, "c": 1000, "d": 950}
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 100, r  # the largest document
        assert r["most"] <= 3


def test_mix_takes_repeated_rows_with_their_other_columns(spark):
    df = spark.createDataFrame(rows_of_sources(), SCHEMA).repartition(5)
    df = df.withColumn("n_chars", F.length("text")).withColumn("_some", F.monotonically_increasing_id()).withColumn("at", F.lit("x"))
    mixed = M.mix(df)
    assert mixed.columns == df.columns
    want = {r["source"]: r["target"] for r in M.copies(df).select("source", "target").distinct().collect()}
    size = F.size(F.split("text", " "))
    for r in mixed.groupBy("source").agg(F.sum(size).alias("taken")).collect():
        assert abs(r["taken"] - want[r["source"]]) <= 100
    # each row is taken at most three times, also among those that repeat it
    assert mixed.groupBy("_some").count().agg(F.max("count")).first()[0] <= 3


def test_many_repeated_rows_share_one_list_of_factors(spark):
    """A text in 3,000 rows: its list of factors is as long as for one row."""
    text = words(70)
    rows = [(1, words(70) + " tail")] + [(5, text)] * 3000 + [(9, text)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spans = S._spans(df, 10)
    assert spans.count() == 2
    assert spans.agg(F.max(F.size("spans"))).first()[0] <= 61
    got = S.removed_words(df, 10)
    assert got.count() == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    found = {tuple(r) for r in got.where("doc_id in (5, 9)").collect()}
    assert found == {(5, 70, 70, empty), (9, 70, 70, empty)}


def test_cut_with_clashing_names(spark):
    rows = [(1, words(20)), (2, "x " + words(20) + " y"), (None, None)]
    names = ["__spans", "__th", "__doc", "spans", "doc", "th", "start", "size", "c0", "c1", "with.dot"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for i, name in enumerate(names):
        df = df.withColumn(name, F.lit(i))
    cut = S.remove_duplicates(df, 10)
    assert cut.columns == df.columns
    got = {r["doc_id"]: r for r in cut.collect()}
    assert got[2]["text"] == "x y" and got[1]["text"] == words(20) and got[None]["text"] is None
    assert all(r["__spans"] == 0 and r["with.dot"] == len(names) - 1 for r in got.values())
