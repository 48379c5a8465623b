"""The operators that take one document, vector or conversation at a time."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from surgecast.llm import byte_bpe as B
from surgecast.llm import chat_format as CF
from surgecast.llm import language_id as L
from surgecast.llm import lm_score as LM
from surgecast.llm import mixing as M
from surgecast.llm import quality_rules as Q
from surgecast.llm import topk_search as T
from surgecast.llm import toxicity as X
from tests.conftest import SF_SMALL
from tests.llm.test_llm_pairs import EDGES, words

ODD = [*EDGES, (None, "null id here"), (None, None), (901, None), (914, "123 456 !!!"), (915, "#*$%&|<> a\n\na\nb\na")]


def docs_of(spark, rows, extra=True):
    tail = ", size long, th string, key int, words string, copies int" if extra else ""
    data = [(i, t, lang, src, *((5, "t", 1, "w", 2) if extra else ())) for i, t, lang, src in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string" + tail)


def odd_docs(spark):
    return docs_of(spark, [(i, t, None if n % 3 else "en", None if n % 4 == 0 else f"s{n % 3}") for n, (i, t) in enumerate(ODD)])


# ------------------------------------------------------------------ byte BPE


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.read_vocabulary(B.default_path()))


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P
    import tiktoken

    with open(B.default_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(codec, reference):
    rng = np.random.default_rng(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "a", "B", "é", "1", "२", "!", "中", "\x85", "　", "😀", "\r", "\x1c", "’"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(3000)]
    texts += [None, "", "'s", "''s", " 's", "\n's", "a's's", "it'll've", "x \n y", "end  ", "%" * 3000, "ab" * 900, "naïve " * 300]
    e = codec.encode(pa.array(texts))
    for i, t in enumerate(texts):
        ids = e.ids[e.bounds[i] : e.bounds[i + 1]]
        assert ids.tolist() == reference.encode_ordinary(t or "")
        assert codec.decode(ids).tobytes().decode() == (t or "")
    offsets = e.offsets()
    for i in (3, 50, len(texts) - 1):
        raw = (texts[i] or "").encode()
        at = offsets[e.bounds[i] : e.bounds[i + 1]].tolist() + [len(raw)]
        assert [raw[a:b] for a, b in zip(at, at[1:])] == [codec.tokens[k] for k in e.ids[e.bounds[i] : e.bounds[i + 1]]]


def test_scan_is_associative_over_blocks():
    gen, *_ = B.automaton()
    ids = gen[np.random.default_rng(2).integers(0, 8, 5000)]
    assert (B.scan(ids, 7) == B.scan(ids, 5000)).all()


def test_bpe_query_and_round_trip(spark, reference):
    rows = {r["doc_id"]: r for r in B.token_digests(odd_docs(spark).where("doc_id is not null"), B.default_path()).collect()}
    for i, t in EDGES:
        ids = reference.encode_ordinary(t or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    tokens = B.encoded(odd_docs(spark), B.default_path())
    back = sorted((str(r[0]), r[1]) for r in B.decoded(tokens, B.default_path()).collect())
    assert back == sorted((str(i), t or "") for i, t in ODD)
    assert B.token_digests(docs_of(spark, []), B.default_path()).count() == 0


# --------------------------------------------------------------- language, toxicity


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = L.op2_language_id(spark, SF_SMALL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_language_edges(spark):
    en, fr = "the house and the garden of this man " * 4, "le jardin et la maison de cet homme avec une " * 4
    model = L.fit([("en", en), ("fr", fr)] * 6)
    rows = [(1, None), (2, ""), (3, "123 !? 99"), (4, en), (5, fr), (6, "ß"), (None, en), (4, en), (7, fr * 300)]
    got = [(r[0], r[1]) for r in L.predict(docs_of(spark, [(i, t, None, None) for i, t in rows]), model).collect()]
    want = [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "fr"), (None, "en"), (4, "en"), (7, "fr")]
    assert sorted(map(str, want)) == sorted(str(g) for g in got if g[0] != 6)
    kept = L.keep_identified(docs_of(spark, [(i, t, None, None) for i, t in rows]), model)
    assert {r["doc_id"] for r in kept.collect()} >= {4, 5, None, 7} and kept.where("doc_id in (1, 2, 3)").count() == 0
    assert {r[1] for r in L.predict(odd_docs(spark), L.fit([])).collect()} == {"und"}
    assert L.predict(docs_of(spark, []), model).count() == 0


def test_identify_keeps_text_in_several_languages(spark):
    texts = {
        "en": "the house and the garden of this man ",
        "fr": "le jardin et la maison de cet homme avec une ",
        "de": "das haus und der garten von diesem mann mit einer ",
    }
    model = L.fit([(k, t * 4) for k, t in texts.items()] * 6)
    mixed = "".join(t * 5 for t in texts.values())
    found = L.predict(docs_of(spark, [(1, mixed, None, None)]), model).first()
    assert found["lang_pred"] in texts and found["score"] < 0.5
    rows = [(1, mixed), (2, texts["en"]), (3, "12 34"), (4, None), (None, mixed)]
    docs = docs_of(spark, [(i, t, None, None) for i, t in rows])
    assert sorted(str(r["doc_id"]) for r in L.keep_identified(docs, model).collect()) == ["1", "2", "None"]
    assert L.keep_identified(docs, L.fit([])).count() == len(rows)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    e, switch = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))
    total, marginal = 0.0, np.zeros((7, 2))
    for code in range(1 << 7):
        path = [(code >> i) & 1 for i in range(7)]
        p = math.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(switch[a, b] for a, b in zip(path, path[1:])))
        total += p
        marginal[np.arange(7), path] += p
    for step in (1, 2, 3, 7, 64):
        got = L.Chains(np.array([0, 7, 0]), step).run(e, switch)
        assert np.allclose(got, marginal / total, atol=1e-9)


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = X.fit(X.labelled_sample(docs, labels))
    got = {r["doc_id"]: r for r in X.score(docs, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert np.mean([got[i]["toxic"] == bool(t) for i, t in truth.items()]) > 0.95
    assert (np.diff(model.thresholds) > 0).all()
    odd = X.score(odd_docs(spark), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["expected_severity"] <= len(model.thresholds) for r in odd)
    none = X.fit(X.labelled_sample(docs, labels.where("toxic > 5")))
    assert {r["toxic"] for r in X.score(odd_docs(spark), none).collect()} == {False}
    assert X.score(docs_of(spark, []), model).count() == 0


# --------------------------------------------------------------------- chat


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, bucket int, place string, n int")


def test_chat_nulls_collapse_as_in_sql(spark):
    """Turns are equal as they render: a null in one column is not a null in the other."""
    import duckdb

    rows = [(1, 0, None, "x"), (2, 0, "x", None), (3, 0, "unknown", "x"), (4, 0, "user", None), (5, 0, None, "user"), (6, 0, "user", ""), (6, 1, "user", "more")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = CF.chat_texts(conversations(spark, [(*r, 1, "p", 2) for r in rows])).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(CF.ORACLE).fetchall())


def test_chat_collapse_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(CF, "SPAN", 3)
    rng = np.random.default_rng(5)
    convs = {}
    for i in range(60):
        base = list(convs.values())[rng.integers(0, len(convs))][: rng.integers(1, 9)] if convs and rng.random() < 0.7 else []
        convs[i] = base + [(str(rng.choice(["user", "assistant"])), f"t{rng.integers(0, 4)}") for _ in range(rng.integers(0 if base else 1, 5))]
    convs[70] = [(None, None)]
    convs[None] = [("user", "lost")]
    rows = [(i, t, r, x, 1, "p", 2) for i, c in convs.items() for t, (r, x) in enumerate(c)]
    want = set()
    for i, c in convs.items():
        longer = any(len(d) > len(c) and d[: len(c)] == c for d in convs.values())
        same = any(d == c and j is not None and (i is None or j < i) for j, d in convs.items() if j != i)
        if not longer and not same:
            want.add((i, "".join(f"<|{r or 'unknown'}|>\n{x or ''}<|end|>\n" for r, x in c)))
    parts = collections.defaultdict(list)
    for r in CF.chat_texts(conversations(spark, rows)).collect():
        parts[r["conv_id"]].append((r["part"], r["text"]))
    assert {(i, "".join(t for _, t in sorted(p))) for i, p in parts.items()} == want
    assert CF.chat_texts(conversations(spark, [])).count() == 0


# ------------------------------------------------------------------- mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > most * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in free}
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mix_targets_and_sampling(spark):
    rng = np.random.default_rng(3)
    rows = []
    for n, (src, count) in enumerate([("a", 400), ("b", 15), ("é", 200), (None, 90), ("z", 3)]):
        rows += [(1000 * n + i, " ".join(f"w{rng.integers(0, 60)}" for _ in range(rng.integers(0, 40))), "en", src) for i in range(count)]
    rows += [(9000, None, None, "empty")]
    docs = docs_of(spark, rows)
    got = M.copies(docs).collect()
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[r["source"]] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 20
    again = M.copies(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert {r["doc_id"]: r["copies"] for r in got if r["copies"]} == dict(times)


def test_mix_edges(spark):
    got = M.copies(odd_docs(spark)).collect()
    assert len(got) == len(ODD) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert M.copies(docs_of(spark, [])).count() == 0 and M.mix(docs_of(spark, [])).count() == 0


# ----------------------------------------------------------- quality, search, LM


def test_quality_counts_against_brute_force(spark):
    rows = [(i, t, "en", None) for i, t in ODD] + [(2000 + i, t, "en", None) for i, t in enumerate(["a b c a b c d", "a a a a a", "x y " * 40 + "z", "one\ntwo\none\n \n\none two"])]
    for r in Q.judge(docs_of(spark, rows)).collect():
        if r["doc_id"] is None:
            continue
        t = next(t for i, t, _, _ in rows if i == r["doc_id"])
        w = words(t)
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        cover = {j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
    assert Q.judge(docs_of(spark, [])).count() == 0


def test_quality_keeps_clean_documents(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = Q.op7_quality_rules(spark, SF_SMALL).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert sum(not r["kept"] for r in rows if r["quality"] == 0) > 0


def test_js_distance(spark):
    row = spark.range(1).select(
        Q.js_distance(Q.F.array(*map(Q.F.lit, (0.5, 0.5, 0.0))), Q.F.array(*map(Q.F.lit, (0.0, 0.0, 1.0)))).alias("far"),
        Q.js_distance(Q.F.array(*map(Q.F.lit, (0.2, 0.8))), Q.F.array(*map(Q.F.lit, (0.2, 0.8)))).alias("same"),
    ).first()
    assert row["far"] == pytest.approx(1.0) and row["same"] == pytest.approx(0.0)


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (rng.random(8) < 0.5)]) for i in range(250)]
    rows += [(300, None), (400, [1.0, None]), (500, [float("nan"), 1.0]), (501, [float("inf")]), (600, []), (None, [1.0] * 8), (700, [0.1, -0.2]), (203, rows[3][1]), (200, rows[200][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, v string")
    v = T.integer_vectors(df)
    got = sorted(map(tuple, T.top_k(v, v.where("vec_id % 100 = 0")).collect()))
    fine = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for q in sorted({i for i, _ in fine if i % 100 == 0}):
        qv = min(e for i, e in fine if i == q)
        scored = sorted(((-sum(a * b for a, b in zip(qv, e)), i) for i, e in fine if i != q))[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    empty = T.integer_vectors(df.where("vec_id < 0"))
    assert T.top_k(empty, empty).count() == 0


def test_lm_base_score_against_brute_force(spark):
    rows = [(i, t, "en", None) for i, t in ODD] + [(3000 + i, " ".join(["The", "cat", f"w{i}"] * (i % 7)), None, None) for i in range(60)]
    got = LM.score_documents(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    tokens = [(i, [*words((t or "").translate({k: k + 32 for k in range(65, 91)})), None]) for i, t, _, _ in rows]
    count = collections.Counter()
    for i, w in tokens:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = collections.Counter((str(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for i, w in tokens)
    have = collections.Counter((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)
    assert have == want
    assert all(r["score"] < 0 for r in got)
    assert LM.score_documents(docs_of(spark, [])).count() == 0


def test_lm_equal_partitions_are_counted_apart(spark):
    """rows + rows: chunks that hold the same rows keep their own sums."""
    rows = [(i, " ".join(f"w{(i * j) % 40}" for j in range(1, 30)) + f" only{i}") for i in range(20)]
    got = LM.score_documents(spark.createDataFrame(spark.sparkContext.parallelize(rows * 6, 6), "doc_id long, text string")).collect()
    tokens = [(i, [*words(t), None]) for i, t in rows] * 6
    count = collections.Counter()
    for i, w in tokens:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = collections.Counter((i, len(w), sum(count[x] > 0 for x in w), round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for i, w in tokens)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in got) == want


def test_lm_learns_from_every_training_token(spark):
    """Long texts and all lanes' ends included, whatever the partitioning."""
    rows = [(i, " ".join(f"w{(i + j) % 50}" for j in range(1 + 37 * i % 400))) for i in range(60)] + [(99, "a b c d " * 6000), (100, None)]
    df = docs_of(spark, [(i, t, None, None) for i, t in rows], False)
    vocabularies, seen = [], []
    rounds = LM.train_rounds

    def watched(r, m):
        vocabularies.append((m.sorted.tolist(), m.rank.tolist(), m.p["word_b"].tolist()))
        seen.append(rounds(r, m))

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(LM, "train_rounds", watched)
        got = [LM.score_documents(df.repartition(n)).collect() for n in (1, 7)]
    assert vocabularies[0] == vocabularies[1] and len(vocabularies[0][0]) > 50
    assert seen == [got[0][0]["train_tokens"]] * 2


def test_gru_gradients_and_whole_document_state():
    rng = np.random.default_rng(8)
    m = LM.GruModel(np.arange(1, 131, dtype=np.uint64), np.arange(130, 0, -1).astype(float), 40.0, np.ones(1 << 16))
    m.p = {k: rng.normal(size=v.shape).astype(np.float64) * 0.2 if k != "word_b" else v.astype(np.float64) for k, v in m.p.items()}
    x, y = rng.integers(0, 131, (5, 3)), rng.integers(0, 131, (5, 3))
    fresh = np.zeros((5, 3), bool)
    fresh[2, 1] = True
    h = np.zeros((3, LM.HIDDEN))
    g, loss, _ = m.window_gradients(x, y, fresh, h)
    for name, at in (("gates", (3, 5)), ("cand", (2, 7)), ("cls", (4, 1)), ("word", (int(y[0, 0]) % 130, 3)), ("input", (int(x[1, 0]), 40)), ("cls_b", (1,))):
        keep = m.p[name][at]
        losses = []
        for e in (1e-3, -1e-3):
            m.p[name][at] = keep + e
            losses.append(m.window_gradients(x, y, fresh, h)[1])
        m.p[name][at] = keep
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(float(g[name][at]), abs=2e-4)
    long = rng.integers(0, 131, 3 * LM.WINDOW + 5)
    whole = m.score(long, np.array([len(long)]))[0]
    state, prev, total = np.zeros((1, LM.HIDDEN)), np.array([m.size + 1]), 0.0
    for t in long:
        state = m.step(prev, state)[0]
        prev = np.array([t])
        total += m.log_prob(state, prev)[0]
    assert whole == pytest.approx(total, rel=1e-4)
    before = m.score(long, np.array([len(long)]))[0]
    m.train([long.astype(np.int64)] * 8, passes=4)
    assert m.score(long, np.array([len(long)]))[0] > before


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = P.identify(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    joined = P.drop_linked(spark, kept, SF_SMALL)
    cut = P.cut_passages(spark, joined, SF_SMALL)
    assert cut.columns == docs.columns and cut.count() == joined.count()
    mixed = P.mix_sources(spark, cut, SF_SMALL)
    want = collections.Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in mixed.collect())
    assert collections.Counter((r["doc_id"], r["decoded_sha256"]) for r in out.collect()) == want
