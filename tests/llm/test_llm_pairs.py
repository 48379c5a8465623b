"""N-gram join and substring de-duplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surgecast.llm import common as C
from surgecast.llm import ngram_join as N
from surgecast.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def brute_components(rows, k=5, percent=80):
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in ids}


def brute_cut(rows, width):
    first = {}
    for i, text in rows:
        w = words(text)
        for j in range(len(w) - width + 1):
            key = tuple(w[j : j + width])
            first[key] = min(first.get(key, i), i)
    out = set()
    for i, text in rows:
        w = words(text)
        gone = set()
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < i:
                gone.update(range(j, j + width))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.add((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near_copies(seed=3):
    """Groups around edited bases, with a chain whose ends do not link."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, i = [], 0
    for size in (30, 8, 2, 2):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((i, " ".join(w)))
            i += 1
    base = [rng.choice(vocabulary) for _ in range(100)]
    for step in range(8):  # a chain: each text has moved on by three words
        rows.append((i, " ".join(base[3 * step :] + [f"c{j}" for j in range(3 * step)])))
        i += 1
    for _ in range(20):
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))))
        i += 1
    return rows


EDGES = [
    (901, None), (902, ""), (903, " \t\n\x0b\x0c\r "), (904, "one"), (905, "ONE"), (906, "one two three four"), (907, "One  two\tthree\nfour"),
    (908, "naïve É x y z"), (909, "naïve é x y z"), (910, "a b c d e f g"), (911, "x " * 3000), (912, "x " * 2000), (913, "é" * 9000),
]


def frame(spark, rows, extra=False):
    schema = "doc_id long, text string" + (", rep string, a binary, n_words long, th string, doc string" if extra else "")
    return spark.createDataFrame([(*r, "x", b"y", 7, "t", "d") if extra else r for r in rows], schema)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("extra", [False, True])
def test_join_matches_brute_force(spark, extra):
    rows = near_copies() + EDGES
    got = as_set(N.join_components(frame(spark, rows, extra).repartition(5)))
    assert got == brute_components(rows)


def test_join_nulls_repeats_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (7, text), (None, text), (None, None), (9, None)]
    got = sorted(map(tuple, N.join_components(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 26, 5), (5, 26, 5), (7, 26, 5), (None, 26, None), (None, 0, None), (9, 0, 9)], key=str)
    assert N.join_components(frame(spark, [])).count() == 0
    kept = sorted((r[0], r[1]) for r in N.keep_one(frame(spark, rows, True)).select("doc_id", "text").collect() if r[0] is not None)
    assert kept == [(5, text), (9, None)]


def test_null_ids_before_near_copies(spark):
    """A set's fingerprint does not depend on the rows before it."""
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(150)]
        for j in range(12):
            w = list(base)
            w[rng.randrange(len(w))] = f"e{j // 2}"
            rows.append((i, " ".join(w)))
            i += 1
    nulls = [(None, " ".join(rng.choice(vocabulary) for _ in range(90))) for _ in range(3)]
    df = frame(spark, nulls + rows).coalesce(1)
    got = {tuple(r) for r in N.join_components(df).where("doc_id is not null").collect()}
    assert got == brute_components(rows)
    kept = N.keep_one(frame(spark, nulls + rows, True).coalesce(1)).where("doc_id is not null")
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in got}


def test_fingerprint_of_a_set_is_its_own():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 170, dtype=np.uint64)) for _ in range(60)]
    alone = [int(N._fingerprints([s])[0]) for s in sets]
    assert N._fingerprints(sets).tolist() == alone
    assert N._fingerprints(sets[7:]).tolist() == alone[7:]


def test_equal_partitions_keep_their_chunks_apart(spark):
    """rows + rows: chunks that hold the same sets are not merged."""
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(100_000)]
    rows = []
    for i in range(0, 16, 2):
        a, b = ([rng.choice(vocabulary) for _ in range(174)] for _ in range(2))
        rows += [(i, " ".join(a)), (i + 1, " ".join(a[:82] + b[82:]))]  # J about 0.3
    rows.append((16, " ".join(a[:-1] + ["z"])))
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows * 8, 8), "doc_id long, text string")  # rows in each partition
    got = [tuple(r) for r in N.join_components(df).collect()]
    want = brute_components(rows)
    assert sorted(got) == sorted([*want] * 8) and (16, 170, 14) in want


def test_heavy_tokens_keep_links(spark, monkeypatch):
    """Hot tokens are sent by count only; the links are the same."""
    rows = near_copies(9)
    monkeypatch.setattr(C, "hot_keys", lambda reported, total: _top(reported))
    assert as_set(N.join_components(frame(spark, rows))) == brute_components(rows)


def _top(reported):
    rows = reported.groupBy("key").agg({"count": "sum"}).where("`sum(count)` >= 4").collect()
    keys = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    counts = np.array([r[1] for r in rows], np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def test_cut_matches_brute_force(spark):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(40):
        w = [f"u{rng.randrange(3000)}" for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            a = rng.randrange(20)
            at = rng.randint(0, len(w))
            w[at:at] = passage[a : a + rng.randint(5, 40)]
        rows.append((i, " \n".join(w)))
    rows += [(90, rows[3][1]), (91, rows[3][1] + " tail"), *EDGES, (1200, "x " * 1500)]
    got = as_set(S.removed_words(frame(spark, rows, True).repartition(6), width=10))
    assert got == brute_cut(rows, 10)


def test_cut_at_full_width(spark):
    base = [f"b{i}" for i in range(200)]
    rows = [(1, " ".join(base[:120])), (2, " ".join(base[60:])), (3, " ".join(base[30:79])), (4, " ".join(["z", *base[30:80], "z"])), (5, " ".join(base))]
    assert as_set(S.removed_words(frame(spark, rows))) == brute_cut(rows, 50)


def test_cut_nulls_repeats_and_text(spark):
    text = "A  b\tc d\ne f g h"
    rows = [(None, text), (2, text), (2, text), (3, "start " + text + "\n end"), (4, None)]
    got = sorted(map(tuple, S.removed_words(frame(spark, rows), width=5).select("doc_id", "n_removed").collect()), key=str)
    assert got == sorted([(None, 0), (2, 0), (2, 0), (3, 8), (4, 0)], key=str)
    cut = {r["doc_id"]: r["text"] for r in S.remove_duplicates(frame(spark, rows, True), width=5).collect()}
    assert cut[3] == "start end" and cut[2] == text and cut[4] is None
    assert S.removed_words(frame(spark, [])).count() == 0


def test_hot_seeds_are_split(spark, monkeypatch):
    rows = [(i, " ".join([f"u{i}a{j}" for j in range(8)] + [f"p{j}" for j in range(25)] + [f"v{i}b{j}" for j in range(8)])) for i in range(60)]
    monkeypatch.setattr(C, "hot_keys", lambda reported, total: (np.sort(np.array([r[0] for r in reported.select("key").distinct().collect()], np.int64).view(np.uint64)), None))
    assert as_set(S.removed_words(frame(spark, rows), width=10)) == brute_cut(rows, 10)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab C\t\né ", max_size=30), max_size=6))
def test_word_positions(texts):
    import pyarrow as pa

    w = C.Words(pa.array(texts, pa.string()))
    assert [[w.bytes_of(i).decode() for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])] == [words(t) for t in texts]


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501)], "a long, b long")
    got = dict(map(tuple, C.components(edges).collect()))
    assert got == {**{i: 0 for i in range(n + 1)}, 500: 500, 501: 500}
