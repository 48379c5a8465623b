"""Merkle manifest against a plain-Python tree, the DuckDB oracle and edge rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surgecast.llm import merkle as M
from tests.helpers import assert_same, spark_rows

from tests.conftest import SF_MID

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return sha(*[framed(v) for v in row])


def tree(nodes):
    """(root, siblings of every node up to the root as (left, right) pairs)."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for lo in range(0, len(nodes), 8):
            run = nodes[lo : lo + 8]
            for j in range(len(run)):
                for i in under[lo + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha(*run))
            over.append([i for j in range(len(run)) for i in under[lo + j]])
        nodes, under = up, over
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        rs = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[g] = (rs, *tree([leaf(r) for r in rs]))
    root, tops = tree([made[g][1] for g in order])
    out = []
    for g, above in zip(order, tops):
        rs, sub, paths = made[g]
        for r, path in zip(rs, paths):
            path = path + above
            cur = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                cur = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for a, b in path:
                cur = sha(a, cur, b)
            out.append((r[0], leaf(r), sub, root, sha(*[a + b for a, b in path]), cur, cur == root))
    return out


def some_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "plain text", "Üml Aut É", "MiXed " * rng.randint(1, 5), "\U0001f600 x\ty\n"])
        lang = rng.choice(["en", "en", "en", "de", None, "", "é", "zz"])
        rows.append((i * 7 - 50 if rng.random() < 0.95 else None, rng.choice([None, "s1", "a:b"]), lang, rng.choice([None, 5, -3]), text))
    return rows


def as_table(spark, scratch, rows, more=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in more:
        df = df.withColumn(name, F.lit(1))
    df.write.parquet(f"{scratch}/documents.parquet")
    return scratch


def got(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


@pytest.mark.parametrize("rows", [some_rows(40), some_rows(1), [(3, None, None, None, None)], some_rows(9, 3) * 30], ids=["mixed", "one", "nulls", "repeated"])
def test_equals_plain_tree(spark, scratch, rows):
    df = M.op11_merkle_manifest(spark, as_table(spark, scratch, rows))
    assert got(df) == sorted(brute(rows), key=str)


def test_many_floors(spark, scratch, monkeypatch):
    """Blocks of 8 nodes: a group of 400 rows takes three floors."""
    monkeypatch.setattr(M, "DEPTH", 1)
    monkeypatch.setattr(M, "SPAN", 8)
    rows = [(i, "s", "en" if i % 5 else "de", i, f"Text {i}") for i in range(500)]
    df = M.op11_merkle_manifest(spark, as_table(spark, scratch, rows))
    assert got(df) == sorted(brute(rows), key=str)


def test_many_groups(spark, scratch):
    rows = [(i, "s", f"l{i:04d}", None, "A") for i in range(700)]
    df = M.op11_merkle_manifest(spark, as_table(spark, scratch, rows))
    assert got(df) == sorted(brute(rows), key=str)


def test_empty_and_clashing_columns(spark, scratch):
    df = M.op11_merkle_manifest(spark, as_table(spark, f"{scratch}/a", []))
    assert df.count() == 0
    rows = some_rows(30, 5)
    clash = ["g", "h", "u", "at", "part", "idx", "n", "item", "flanks", "key", "leaf", "root"]
    df = M.op11_merkle_manifest(spark, as_table(spark, f"{scratch}/b", rows, clash))
    assert got(df) == sorted(brute(rows), key=str)


def test_very_long_text_and_hot_group(spark, scratch):
    """A 2 MB text, and one language that holds nearly all rows: it is spread
    over the sorted partitions, not one task."""
    rows = [(i, "s", "en", 1, "X" * 2_000_000 if i == 7 else f"T{i}") for i in range(3000)] + [(9999, "s", "de", 1, "q")]
    path = as_table(spark, scratch, rows)
    assert got(M.op11_merkle_manifest(spark, path)) == sorted(brute(rows), key=str)
    nodes = spark.read.parquet(f"{path}/documents.parquet").select(M.group_key(F.col("lang")).alias("g"), F.col("doc_id").alias("key"), F.lit("x").alias("h")).repartition(8)
    placed = M.numbered(nodes, ["key", "h"])
    idx = sorted(r["idx"] for r in placed.where("g = '=en'").collect())
    assert idx == list(range(3000))


def test_flanks_rebuild_the_root(spark, scratch):
    rows = some_rows(100, 9)
    spark.createDataFrame(rows, SCHEMA).createOrReplaceTempView("merkle_docs")
    found = M.manifest(spark.table("merkle_docs"))
    bad = found.where(M.fold(F.col("leaf"), F.col("flanks")) != F.col("root"))
    assert bad.count() == 0 and found.count() == 100


def test_oracle(spark, duck_mid):
    assert_same(M.op11_merkle_manifest(spark, SF_MID), duck_mid, M.ORACLE)


def test_oracle_of_edge_rows(spark, scratch):
    import duckdb

    rows = some_rows(60, 21)
    path = as_table(spark, scratch, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    want = {tuple(r) for r in con.sql(M.ORACLE).fetchall()}
    assert want == set(brute(rows))


def test_shuffled_input_gives_the_same_manifest(spark, scratch):
    rows = some_rows(80, 33)
    other = rows[:]
    random.Random(4).shuffle(other)
    a = M.op11_merkle_manifest(spark, as_table(spark, f"{scratch}/a", rows))
    b = M.op11_merkle_manifest(spark, as_table(spark, f"{scratch}/b", other))
    assert spark_rows(a) == spark_rows(b)
