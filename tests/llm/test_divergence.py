"""Divergence audit against plain Python, the DuckDB oracle and edge rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surgecast.llm import divergence as D
from tests.conftest import SF_MID
from tests.helpers import assert_same

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows, least=10, top=10):
    counts, docs, groups = {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        for t in terms:
            counts[lang, source, t] = counts.get((lang, source, t), 0) + 1
        for t in set(terms):
            docs[lang, t] = docs.get((lang, t), 0) + 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        v, sources = len(kept), [s for x, s in groups if x == lang]
        table = {s: [counts.get((lang, s, t), 0) for t in kept] for s in sources}
        table[None] = [sum(table[s][k] for s in sources) for k in range(v)]
        share = {s: [1 + 10**9 * (c + 2) // (sum(row) + 2 * v) for c in row] for s, row in table.items()}
        for s in sources:
            pair = [(sum((p - q) ** 2 // (p + q) for p, q in zip(share[s], share[o])), o) for o in sources if o != s]
            term = [((p - q) ** 2 // (p + q), t) for p, q, t, c in zip(share[s], share[None], kept, table[s]) if c and p > q]
            for part, found in (("pair", pair), ("term", term)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def some_rows(n, seed=1, sources=5):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "été", "ÉTÉ", "x", "naïve", "\U0001f600", "don't", "a1b", "[z]", "日本"] + [f"w{chr(97 + i)}" for i in range(15)]
    rows = []
    for i in range(n):
        k = rng.randrange(sources)
        words = [vocabulary[min(int(rng.expovariate(1 / (3 + 2 * k))), len(vocabulary) - 1)] for _ in range(rng.randrange(30))]
        rows.append((i, rng.choice([" ", "-", "\n"]).join(words) if rng.random() < 0.95 else None, rng.choice(["en", "en", "de", None, ""]), f"s{k}" if rng.random() < 0.9 else None))
    return rows


def got(spark, rows, **kw):
    df = D.divergence(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw)
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("rows", [some_rows(300), some_rows(40, 2) * 5, [(1, None, None, None)], [(i, None, "en", f"s{i % 3}") for i in range(9)]], ids=["mixed", "repeated", "null", "no_terms"])
def test_equals_brute_force(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_blocks_of_rows_and_columns(spark, monkeypatch):
    """Few cells and sources a block: many blocks of columns and pairs of row
    blocks give the same sums."""
    monkeypatch.setattr(D, "WORK", 40)
    monkeypatch.setattr(D, "ROWS", 4)
    rows = some_rows(600, 5, sources=23)
    assert got(spark, rows) == brute(rows)


def test_empty_and_other_columns(spark):
    assert got(spark, []) == []
    rows = some_rows(60, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "c", "total", "new", "n", "v", "rb", "a", "b", "x", "cb", "rank", "value"):
        df = df.withColumn(name, F.lit(7))
    found = D.divergence(df, min_docs=3)
    assert sorted(tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()) == brute(rows, 3)


def test_long_text_ties_and_hot_source(spark):
    """One source with most rows, one text of two million characters, and
    terms of equal value: ties go to the smaller term in UTF-8."""
    rows = [(i, "b a é Z z", "en", "hot") for i in range(400)] + [(1000 + i, "a q", "en", "cold") for i in range(12)]
    rows.append((5000, "a b " * 500_000, "en", "long"))
    assert got(spark, rows) == brute(rows)


def test_terms_are_whole_and_lower_cased():
    texts = ["Ab-cd éÉx", None, "", "1a2b", "AB", "ab"]
    terms, row = D.terms_of(pa.array(texts, pa.string()))
    want = [(i, t.translate(LOWER)) for i, text in enumerate(texts) for t in TERM.findall(text or "")]
    assert list(zip(row.tolist(), terms.to_pylist())) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.floats(0, 1), st.integers(0, 10**6))
def test_joint_traversal(rows, cols, density, seed):
    rng = np.random.default_rng(seed)
    m = rng.random((rows, cols)) < density * density
    piece, D.PIECE = D.PIECE, 3
    try:
        zero, i, j, c = D.Quadtree(*np.nonzero(m), (rows, cols)).pairs()
    finally:
        D.PIECE = piece
    visited = set(zip(i.tolist(), j.tolist(), c.tolist()))
    assert len(visited) == len(i)
    for a in range(rows):
        for b in range(a, rows):
            either = m[a] | m[b]
            assert zero[a, b] == (~either).sum()
            assert {x[2] for x in visited if x[:2] == (a, b)} == set(np.flatnonzero(either).tolist())


def test_share_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        n, v = rng.randrange(10**15), rng.randrange(1, 10**9)
        c = rng.randrange(n + 1)
        assert int(D.share(np.array([c]), n, v)[0]) == 1 + 10**9 * (c + 2) // (n + 2 * v)


def test_oracle(spark, duck_mid):
    assert_same(D.op12_source_divergence(spark, SF_MID), duck_mid, D.ORACLE)
