"""Hot prefix tokens of the n-gram join, and groups of queries of the search."""

import random

import pytest
from pyspark.sql import functions as F

from surgecast.llm import ngram_join as N
from surgecast.llm import topk_search as T
from tests.llm.test_llm_pairs import EDGES, as_set, brute_components, frame, near_copies


def boilerplate(n, seed=2, own=(30, 30), shared=200):
    """Documents of one shared passage and words of their own."""
    rng = random.Random(seed)
    passage = " ".join(f"b{i}" for i in range(shared))
    return [(10_000 + i, passage + " " + " ".join(f"o{i}x{j}" for j in range(rng.randint(*own)))) for i in range(n)]


@pytest.mark.parametrize("hot", [2, 10**9])
def test_shapes_find_the_links_that_documents_do(spark, monkeypatch, hot):
    """All tokens through shapes, or none."""
    monkeypatch.setattr(N, "HOT_TOKEN", hot)
    monkeypatch.setattr(N, "CENTRAL_KEYS", 1)
    monkeypatch.setattr(N, "RANDOM_KEYS", 1)
    rows = near_copies(13) + EDGES + boilerplate(25, own=(20, 70)) + boilerplate(12, 5, (30, 30))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert as_set(N.join_components(frame(spark, rows).repartition(4))) == brute_components(rows)


def _match_rows(spark, n):
    """Rows that the joins of the prefix step make for n boilerplate documents."""
    made = []
    keep = N.verified
    try:
        N.verified = lambda pairs, profile, percent: made.append((pairs, profile)) or keep(pairs, profile, percent)
        N.join_components(frame(spark, boilerplate(n))).count()
    finally:
        N.verified = keep
    return made[-1][0].count()


def test_boilerplate_too_short_to_link_makes_no_pairs(spark):
    assert _match_rows(spark, 400) == 0
    post = 17 * 400  # about 17 prefix tokens a document hold the passage
    shapes = spark.createDataFrame([(t, 226, 1, 0, -196, 1) for t in range(17)], "tok int, n int, ell int, before int, rest int, small int")
    assert shapes.count() * 100 < post
    other = shapes.select(*[F.col(c).alias("l_" + c) for c in ("tok", "n", "ell", "before", "rest")])
    assert shapes.join(other, (F.col("tok") == F.col("l_tok")) & N._can_match(80)).count() == 0


def test_search_in_many_groups_equals_one(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0, 0, rng.randrange(-900, 900)]) for _ in range(6)]) for i in range(400)] + [(400, []), (401, [0] * 6), (402, [5])]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    asked = v.where("vec_id % 5 = 0")
    whole = as_set(T.top_k(v, asked))
    monkeypatch.setattr(T, "GROUP", 9)
    assert as_set(T.top_k(v.repartition(5), asked)) == whole
    want = set()
    for q, a in rows[::5]:
        best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q))[:10]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert whole == want
    assert T.top_k(v, asked.limit(0)).count() == 0
    assert T.top_k(v.limit(0), asked).count() == 0
