"""Operator 4 - toxicity by cumulative-link ordinal regression.

Grades 0..G are ordered; P(grade > k) = sigmoid(w.x - theta_k) with one
weight vector for all thresholds theta_0 < theta_1 < ... Features are the
distinct words of a text (A-Z lower-cased, trailing punctuation off), by
64-bit hash: sparse, binary, no bucket collisions. The output is the expected
severity, the sum of P(grade > k), the likeliest grade, and ``toxic``:
P(grade > 0) >= 0.5.

Grades. The labels say toxic or not. Toxic rows of the training sample are
graded by how many different telling words they hold (words of at least
``TELLING`` times the share among toxic rows than among others): 1 for up to
2, 2 for 3 or 4, 3 for more.

The model is fitted at the driver on a bounded sample of labelled rows (at
most about ``SAMPLE`` of each class by a hash of the id, texts up to
``LONGEST`` characters); it is a sorted array of at most ``FEATURES`` word
hashes with weights, and is broadcast. All documents are scored where the
scan puts them.

Defined results: null or blank text scores as the empty set of words; a
doc_id with several labels counts as toxic if one says so; null labels and
ids are left out of the sample; with no toxic or no other rows in the sample
every document gets severity 0 (or the top grade's prior); repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C

SAMPLE = 5000
LONGEST = 200_000
FEATURES = 200_000
TELLING = 20.0
SCREEN = 10.0
L2 = 0.1
STEPS = 200

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?\"')")] = True


def _features(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, word hash) pairs, sorted by row."""
    words = C.Words(piece.column("text"))
    end = words.end.copy()
    for _ in range(8):
        strip = _PUNCTUATION[words.data[end - 1]] & (end - words.start > 1) if len(end) else np.zeros(0, bool)
        if not strip.any():
            break
        end[strip] -= 1
    return words.doc(), C.word_hashes(words.data, words.start, end, lower=True)


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in C.text_slices(batches):
        row, h = _distinct(*_features(piece))
        cut = np.searchsorted(row, np.arange(piece.num_rows + 1))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array([C.blob(h[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["doc_id", "toxic", "words"])


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list:
    """(doc_id, toxic, words) of about ``size`` rows of either class."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    u = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, size / max(1, counts.get(1, 0)))).otherwise(min(1.0, size / max(1, counts.get(0, 0))))
    chosen = known.where(u < share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= LONGEST))
    # about 2 * SAMPLE ids of 12 bytes
    picked = rows.join(F.broadcast(chosen), "doc_id")
    found = picked.select("doc_id", "toxic", "text").mapInArrow(_sample_rows, "doc_id long, toxic int, words binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["words"]))
    return [(r["doc_id"], r["toxic"], np.frombuffer(r["words"], np.uint64)) for r in found]


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row a document."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))

    def scores(self, row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        at = C.member(h, self.words)
        some = at >= 0
        row, h = _distinct(row[some], h[some])
        return np.bincount(row, self.weights[C.member(h, self.words)] if len(h) else None, minlength=n).astype(float)


def grades_of(toxic: np.ndarray, rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Severity grades of the sample (``rows``, ``words``: its features)."""
    n_toxic, n_other = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    names, at = np.unique(words, return_inverse=True)
    in_toxic = np.bincount(at, toxic[rows], minlength=len(names))
    in_other = np.bincount(at, 1 - toxic[rows], minlength=len(names))
    telling = (in_toxic >= 3) & (in_toxic / n_toxic >= TELLING * (in_other + 0.5) / n_other)
    hits = np.bincount(rows, telling[at], minlength=len(toxic))
    return np.where(toxic == 1, 1 + (hits > 2) + (hits > 4), 0).astype(np.int64)


def fit(sample: list, steps: int = STEPS) -> OrdinalModel:
    toxic = np.array([t for _, t, _ in sample], np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.full(1, -40.0 if len(toxic) and toxic[0] else 40.0))
    rows = np.repeat(np.arange(len(sample)), [len(w) for _, _, w in sample])
    words = np.concatenate([w for _, _, w in sample])
    grade = grades_of(toxic, rows, words)
    # features: words that lean to one side by at least SCREEN, seen twice there;
    # ordinary words would only add up to noise in long texts
    names, place = np.unique(words, return_inverse=True)
    seen = np.stack([np.bincount(place, toxic[rows] == side, minlength=len(names)) for side in (0, 1)])
    share = (seen + 0.5) / (np.bincount(toxic, minlength=2)[:, None] + 1)
    lean = np.abs(np.log(share[1] / share[0])) >= np.log(SCREEN)
    counts = np.where(lean & (np.where(share[1] > share[0], seen[1], seen[0]) >= 2), seen.sum(axis=0), 0)
    names = np.sort(names[np.argsort(-counts, kind="stable")[: min(FEATURES, int((counts > 0).sum()))]])
    at = C.member(words, names)
    rows, at = rows[at >= 0], at[at >= 0]
    top = int(grade.max())
    n = len(sample)
    w = np.zeros(len(names))
    over = np.array([(grade > k).mean() for k in range(top)]).clip(1e-4, 1 - 1e-4)
    theta0, gaps = -np.log(over[0] / (1 - over[0])), np.full(max(0, top - 1), 0.5)
    params = np.concatenate((w, [theta0], np.log(gaps)))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, theta = params[: len(names)], params[len(names)] + np.concatenate(([0.0], np.cumsum(np.exp(params[len(names) + 1 :]))))
        score = np.bincount(rows, w[at], minlength=n)
        s = 1.0 / (1.0 + np.exp(np.clip(theta[None, :] - score[:, None], -40, 40)))  # P(grade > k)
        full = np.concatenate((np.ones((n, 1)), s, np.zeros((n, 1))), axis=1)
        i = np.arange(n)
        p = np.maximum(full[i, grade] - full[i, grade + 1], 1e-12)
        slope = full * (1 - full)
        # d log p / d score, and by threshold
        d_score = (slope[i, grade] - slope[i, grade + 1]) / p
        d_theta = np.zeros((n, top + 2))
        d_theta[i, grade] -= slope[i, grade] / p
        d_theta[i, grade + 1] += slope[i, grade + 1] / p
        d_theta = d_theta[:, 1:-1].sum(axis=0)
        tail = np.cumsum(d_theta[::-1])[::-1]
        g = np.concatenate((np.bincount(at, d_score[rows], minlength=len(names)) - L2 * w, [d_theta.sum()], tail[1:] * np.exp(params[len(names) + 1 :])))
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        params = params + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w, theta = params[: len(names)], params[len(names)] + np.concatenate(([0.0], np.cumsum(np.exp(params[len(names) + 1 :]))))
    return OrdinalModel(names, w, theta)


def _score(batches: Iterator[pa.RecordBatch], model: OrdinalModel) -> Iterator[pa.RecordBatch]:
    for piece in C.text_slices(batches):
        above = model.above(model.scores(*_features(piece), piece.num_rows))
        full = np.concatenate((np.ones((len(above), 1)), above, np.zeros((len(above), 1))), axis=1)
        grade = (full[:, :-1] - full[:, 1:]).argmax(axis=1)
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(grade.astype(np.int32)), pa.array(above.sum(axis=1)), pa.array(above[:, 0] >= 0.5)], ["doc_id", "severity", "expected_severity", "toxic"]
        )


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, severity, expected_severity, toxic) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(lambda b: _score(b, sent.value), "doc_id long, severity int, expected_severity double, toxic boolean")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents")
    return score(docs, fit(labelled_sample(docs, C.read(spark, sf_dir, "labels"))))
