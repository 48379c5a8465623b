"""Trained operators on rows that they were not trained on, and averaging."""

import numpy as np
from pyspark.sql import functions as F

from surgecast.llm import common as C
from surgecast.llm import language_id as L
from surgecast.llm import lm_score as G
from surgecast.llm import toxicity as X

SF_LARGE = "/root/testdata/sf0.1"


def test_toxicity_of_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    held = C.crc_mod5(F.col("doc_id")) == 0
    model = X.fit(X.labelled_sample(docs, labels.where(~held)))
    truth = {r["doc_id"]: r["toxic"] for r in labels.where(held & F.col("toxic").isNotNull()).collect()}
    got = {r["doc_id"]: r for r in X.score(docs.join(labels.where(held).select("doc_id"), "doc_id"), model).collect()}
    assert set(got) == set(truth) and 0 < sum(truth.values()) < len(truth)
    wrong = [i for i, t in truth.items() if got[i]["toxic"] != bool(t)]
    assert len(wrong) <= 0.05 * len(truth)
    caught = [i for i, t in truth.items() if t and got[i]["toxic"]]
    assert len(caught) >= 0.8 * sum(truth.values())
    expected = {t: np.mean([got[i]["expected_severity"] for i, x in truth.items() if x == t]) for t in (0, 1)}
    assert expected[1] > expected[0] + 0.5


def test_average_in_two_steps(spark):
    """Weighted by tokens, whatever the number of partitions and pieces."""
    rng = np.random.default_rng(2)
    weights, tokens = rng.normal(size=(150, 3, 5)).astype(np.float32), rng.integers(1, 900, 150)
    rows = [(p, part, int(tokens[part]), weights[part, p].tobytes()) for part in range(150) for p in range(3)]
    parts = spark.createDataFrame(rows, G._WEIGHTS).repartition(7)
    some = G._averaged(parts, 4, F.pmod(F.col("part"), F.lit(12)))
    assert some.count() == 3 * 12
    mean = G._averaged(some, 2, F.lit(0)).collect()
    assert len(mean) == 3 and {r["tokens"] for r in mean} == {int(tokens.sum())}
    want = np.average(weights.astype(float), axis=0, weights=tokens)
    for r in mean:
        assert np.allclose(np.frombuffer(r["w"], np.float32), want[r["piece"]], atol=1e-5)


def test_each_language_has_its_share_of_training_words(monkeypatch):
    """A language with far more text does not crowd the others out."""
    monkeypatch.setattr(L, "TRAIN_WORDS", 600)
    many = [("aa", " ".join(f"ba{i % 7}da" for i in range(5000)))] * 5
    few = [("bb", " ".join(f"zu{i % 5}ku" for i in range(150)))] * 4
    model = L.fit(many + few, epochs=15)
    batch = __import__("pyarrow").RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["ba1da ba3da ba9da", "zu1ku zu2ku zu8ku"]})
    (got,) = L._predict(iter([batch]), model)
    assert got.column("lang_pred").to_pylist() == ["aa", "bb"]


def small_lm(words=300):
    rng = np.random.default_rng(3)
    keys = C.mix(np.arange(1, words + 1, dtype=np.uint64))
    m = G.GruModel(np.append(G.END, keys), np.arange(words + 1, 0, -1).astype(float), 40.0, np.ones(1 << 16))
    m.p = {k: (v + rng.normal(size=v.shape) * 0.3 * (k != "word_b")).astype(np.float32) for k, v in m.p.items()}
    return m


def test_lm_scores_texts_of_several_slices_together(monkeypatch):
    """A step of the network costs the same whether one text or hundreds take
    it: texts of all slices share their steps, and score as each would alone."""
    import pyarrow as pa

    sizes = [300, 1, 280, 0, 7, 299, 40] * 6
    texts = [" ".join(f"w{(i * j) % 90}" for j in range(n)) if n else None for i, n in enumerate(sizes)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "th": list(range(len(texts)))})
    m, hot = small_lm(), np.zeros(0, np.uint64)
    steps, step = [], G.GruModel.step
    monkeypatch.setattr(G.GruModel, "step", lambda self, x, *a: steps.append(len(x)) or step(self, x, *a))
    alone = [r.column("score")[0].as_py() for i in range(len(texts)) for r in G._score(iter([batch.slice(i, 1)]), m, hot, np.zeros(0, np.int64))]
    steps.clear()
    monkeypatch.setattr(G, "SLICE", 1000)
    got = pa.Table.from_batches(G._score(iter([batch]), m, hot, np.zeros(0, np.int64))).to_pydict()
    assert got["doc_id"] == list(range(len(texts))) and got["n_tokens"] == [n + 1 for n in sizes]
    assert np.allclose(got["score"], alone, rtol=1e-5)
    assert len(steps) == max(sizes) + 1 and sum(steps) == sum(sizes) + len(sizes)


def test_lm_lookup_and_sums():
    rng = np.random.default_rng(4)
    for keys in (np.sort(C.mix(np.arange(1, 5000, dtype=np.uint64))), np.arange(1, 200, dtype=np.uint64), np.zeros(0, np.uint64), np.array([7], np.uint64)):
        values = np.concatenate((keys, keys[::3] + np.uint64(1), rng.integers(0, 1 << 63, 500).astype(np.uint64)))
        assert np.array_equal(G.Places(keys)(values), C.member(values, keys))
    x, rows = rng.zipf(1.4, 3000) % 70_000, rng.normal(size=(3000, 96)).astype(np.float32)
    found, sums = G._sums_by(x, rows)
    want = np.zeros((70_000, 96))
    np.add.at(want, x, rows.astype(float))
    assert np.array_equal(found, np.unique(x)) and np.allclose(sums, want[found], atol=1e-3)


def test_hash_of_words_of_any_length():
    import pyarrow as pa

    texts = ["a", "", None, " ".join("Ab" * n for n in range(1, 40)), "x" * 23 + " " + "y" * 24 + " " + "z" * 25, "Q" * 9001 + " q"]
    words = C.Words(pa.array(texts, pa.string()))
    for lower in (True, False):
        table, powers = C._tables()[1 if lower else 0], C._tables()[2]
        for i, got in enumerate(words.hashes(lower)):
            total = len(words.bytes_of(i))
            for j, byte in enumerate(words.bytes_of(i)):
                total += int(table[byte]) * ((int(powers[j & 4095]) + (j >> 12) * 0x2545F4914F6CDD1D) % (1 << 64))
            assert got == C.mix(np.array([total % (1 << 64)], np.uint64))[0]
