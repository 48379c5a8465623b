"""Operator 8 - scoring by a gated recurrent language model.

Base score: unigram counts over all training documents (crc32(doc_id) mod 5
is not 1), add-half smoothing, exact. Chunks of documents send the hash of
each token, with the document's number in its chunk, to hash blocks; a block
counts its words and sends back, per document, only the sum of log10(c + 0.5)
and the number of known tokens. Words that hold over 2^-18 of all tokens
(first pass) are not sent: each chunk sends one count per such word, and
their exact totals are broadcast for the scoring pass.

Model. Tokens are one end, unknown words, and the words that training documents
hold at least N^(2/3) / ``SPREAD`` times (at least ``LEAST``), N being all their
tokens: up to SPREAD * N^(1/3) words, by exact counts, so the vocabulary grows
with the corpus and does not depend on chunks or files. The output softmax is factored: class given state,
then word given class and state. An unknown word costs its class and its
spelling, by a byte bigram model with corpus-wide counts.

Training. Weights start from output biases that are the corpus-wide
frequencies, and are trained on every token of every training document by
truncated back-propagation inside Spark. In each of ``ROUNDS`` rounds every
partition goes on from the common weights over its documents of that round
(dealt by hash), and the weights of all partitions are averaged by their
tokens, piece by piece, in two steps: within groups of about the square root of the
number of partitions, then the groups; the driver only gets the average. Texts are
lanes of one batch; one of over ``STRETCH`` tokens becomes several lanes, which
begin with an empty state but the right previous token. The weights depend on how rows
lie in partitions, as with any averaged training. A document is scored
whole: windows of ``WINDOW`` tokens, the state carried from one to the next;
documents of several slices, the longest first, are lanes of batches of about
one length, so that few steps run with few lanes.

Defined results: null text is empty (one token, the end); null doc_id is
held out (held_out null) and not counted; repeated rows are counted and
scored each; without training documents every token has the same base score;
an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import heapq
from collections.abc import Iterator
from functools import cached_property
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C

CHUNK = 1 << 20  # tokens a map task combines at once
CHUNK_DOCS = 32_000  # a document's number within its chunk has 15 bits
PER_TASK = 1_000_000
SPREAD, LEAST = 64, 2  # size of the vocabulary, see above
IN_CLASS = 64
HIDDEN = 32
WINDOW, BATCH = 64, 512
TOGETHER = 3 << 20  # tokens of texts that are scored together
LANES, TRAIN_WINDOW, STRETCH = 256, 32, 2048
ROUNDS, RATE = 3, 0.004
PIECE = 1 << 16  # weights averaged together
ROWS_AT_ONCE = 1024  # of the output layer, so that they stay in the cache
AT_ONCE = 1 << 14  # weights moved together, for the same reason
SLICE = 4 << 20
END = np.uint64(0x9D5C_1F3A_77E1_0B2D)  # stands for the end token among word hashes

# ---------------------------------------------------------- corpus-wide counts

_REPORT = "kind int, key long, count long"  # 0: tokens, 1: heavy word, 2: byte bigram
_ROWS = "kind int, key long, chunk long, a binary, b binary, c binary"


def _train(piece: pa.RecordBatch) -> np.ndarray:
    return piece.column("train").fill_null(False).to_numpy(zero_copy_only=False)


def _bigrams(words: C.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (previous byte * 256 + byte) of the bytes of some words and their
    ends (a space before and after), and where each of the words begins."""
    start, size = words.start[which], words.end[which] - words.start[which] + 1
    first = np.cumsum(size) - size
    here = np.append(C.fold(words.data), np.uint8(32))[C.ranges(start, size)].astype(np.uint16)
    here[first + size - 1] = 32
    prev = np.roll(here, 1)
    prev[first] = 32
    return prev * np.uint16(256) + here, first


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n, docs = [], 0, 0
    grams = np.zeros(1 << 16, np.int64)

    def flush():
        k, c = C.local_heavy(np.concatenate(held))
        g = np.flatnonzero(grams)
        kinds = np.repeat([0, 1, 2], [1, len(k), len(g)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(np.concatenate(([0], k.view(np.int64), g)).astype(np.int64)), pa.array(np.concatenate(([n + docs], c, grams[g])).astype(np.int64))], ["kind", "key", "count"]
        )

    for piece in C.text_slices(batches):
        words, train = C.Words(piece.column("text")), _train(piece)
        use = train[words.doc()]
        h = words.hashes(lower=True)[use]
        held.append(h)
        n += len(h)
        docs += int(train.sum())
        grams += np.bincount(_bigrams(words, np.flatnonzero(use))[0], minlength=1 << 16)
        if n >= CHUNK:
            yield flush()
            held, n, docs = [], 0, 0
            grams[:] = 0
    if held:
        yield flush()


def _tokens(batches: Iterator[pa.RecordBatch], hot: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Per chunk: its documents (kind 0); per block, token hashes and document
    numbers, top bit set for training documents (kind 1); and the training
    counts of hot words (kind 2)."""
    hashes, numbers, ids, ths, docs, size = [], [], [], [], 0, 0
    names_of_chunks, places = C.chunk_names(), Places(hot)

    def rows(kind, key, chunk, a, b, c):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(key, pa.int64()), pa.array([chunk] * len(a), pa.int64()), *(pa.array(x, pa.binary()) for x in (a, b, c))], ["kind", "key", "chunk", "a", "b", "c"])

    def by_block(h, *others):
        block = ((h >> np.uint64(32)) % np.uint64(blocks)).astype(np.int16 if blocks < 1 << 15 else np.int32)
        order = np.argsort(block, kind="stable")
        names, lo = np.unique(block[order], return_index=True)
        cuts = list(zip(lo, np.append(lo[1:], len(order))))
        return names, [[C.blob(x[a:b]) for a, b in cuts] for x in (y[order] for y in (h, *others))]

    def flush():
        h, number = np.concatenate(hashes), np.concatenate(numbers)
        doc_ids = pa.chunked_array(ids).combine_chunks()
        th = np.concatenate(ths)
        chunk = next(names_of_chunks)
        known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        yield rows(0, [chunk], chunk, [C.blob(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))], [C.blob(th)], [C.blob(known)])
        at = places(h)
        c = np.bincount(at[(at >= 0) & (number >= 1 << 15)], minlength=len(hot))
        if c.any():
            names, (a, b) = by_block(hot[c > 0], c[c > 0].astype(np.int64))
            yield rows(2, names, chunk, a, b, [b""] * len(names))
        h, number = h[at < 0], number[at < 0]
        if len(h):
            names, (a, b) = by_block(h, number)
            yield rows(1, names, chunk, a, b, [b""] * len(names))

    for piece in C.text_slices(batches):
        words, train = C.Words(piece.column("text")), _train(piece)
        h = words.hashes(lower=True)
        lo = 0
        while lo < piece.num_rows:
            hi = min(piece.num_rows, lo + CHUNK_DOCS - docs)
            a, b = int(words.first[lo]), int(words.first[hi])
            hashes.append(h[a:b])
            numbers.append((np.repeat(np.arange(hi - lo) + docs, words.counts[lo:hi]) + (np.repeat(train[lo:hi], words.counts[lo:hi]).astype(np.int64) << 15)).astype(np.uint16))
            ids.append(piece.column("doc_id").slice(lo, hi - lo))
            ths.append(C.ids_of(piece.column("th").slice(lo, hi - lo)).astype(np.int64))
            docs += hi - lo
            size += b - a
            lo = hi
            if size >= CHUNK or docs >= CHUNK_DOCS:
                yield from flush()
                hashes, numbers, ids, ths, docs, size = [], [], [], [], 0, 0
    if docs:
        yield from flush()


def _count(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A block: per chunk the documents' sums (kind 1: a numbers, b sums of
    log10(c + 0.5), c known tokens); exact counts of its hot words (kind 2: a
    hashes, b counts); how many other words training documents hold (kind 3), and
    those they hold ``least`` times (kind 4: a hashes, b counts)."""
    chunks, hashes, numbers, hot, hot_n = [], [], [], [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        if (kind == 0).any():
            yield batch.filter(pa.array(kind == 0))
        part = batch.filter(pa.array(kind == 1))
        if part.num_rows:
            chunks.append(np.repeat(C.ids_of(part.column("chunk")), C.lengths(part.column("a")) // 8))
            hashes.append(C.unblob(part.column("a"), np.uint64))
            numbers.append(C.unblob(part.column("b"), np.uint16))
        part = batch.filter(pa.array(kind == 2))
        if part.num_rows:
            hot.append(C.unblob(part.column("a"), np.uint64))
            hot_n.append(C.unblob(part.column("b"), np.int64))

    def rows(kind, key, chunk, a, b, c):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(key, pa.int64()), pa.array(chunk, pa.int64()), *(pa.array(x, pa.binary()) for x in (a, b, c))], ["kind", "key", "chunk", "a", "b", "c"])

    if hot:
        k, at = np.unique(np.concatenate(hot), return_inverse=True)
        n = np.zeros(len(k), np.int64)
        np.add.at(n, at, np.concatenate(hot_n))
        yield rows(2, [0], [0], [C.blob(k)], [C.blob(n)], [b""])
    if not hashes:
        return
    chunk, h, number = np.concatenate(chunks), np.concatenate(hashes), np.concatenate(numbers)
    del chunks, hashes, numbers
    order = np.argsort(h)
    ordered = h[order]
    group = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])))
    c = np.bincount(group, number[order] >= 1 << 15)
    yield rows(3, [int((c > 0).sum())], [0], [b""], [b""], [b""])
    often = c >= least
    if often.any():
        new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        yield rows(4, [0], [0], [C.blob(ordered[new[often]])], [C.blob(c[often].astype(np.int64))], [b""])
    count = np.empty(len(h))
    count[order] = c[group]
    names, chunk = np.unique(chunk, return_inverse=True)
    doc = chunk.astype(np.int64) << 15 | (number & 0x7FFF)
    docs, at = np.unique(doc, return_inverse=True)
    sums = np.bincount(at, np.log10(count + 0.5))
    known = np.bincount(at, count > 0).astype(np.int64)
    cuts = np.searchsorted(docs >> 15, np.arange(len(names) + 1))
    number = (docs & 0x7FFF).astype(np.uint16)
    pairs = list(zip(cuts[:-1], cuts[1:]))
    yield rows(1, [0] * len(names), names, [C.blob(number[a:b]) for a, b in pairs], [C.blob(sums[a:b]) for a, b in pairs], [C.blob(known[a:b]) for a, b in pairs])


def _collect_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, cold_sum, cold_known) of the documents of each chunk."""
    tables, parts = {}, {}
    for batch in batches:
        for kind, chunk, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "chunk", "a", "b", "c"))):
            if kind == 0:
                tables[chunk] = (np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(c, bool))
            else:
                parts.setdefault(chunk, []).append((np.frombuffer(a, np.uint16), np.frombuffer(b, np.float64), np.frombuffer(c, np.int64)))
    for chunk, (ids, th, valid) in tables.items():
        sums, known = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        # in one order whatever the order of arrival, so that reruns agree
        for number, s, n in sorted(parts.pop(chunk, []), key=lambda p: (p[0].tobytes(), p[1].tobytes())):
            sums[number] += s
            known[number] += n
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~valid), pa.array(th), pa.array(sums), pa.array(known)], ["doc_id", "th", "cold_sum", "cold_known"])
    if parts:
        raise RuntimeError("sums came back for a chunk that is not there")


# ------------------------------------------------------------------- the model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax_parts(s: np.ndarray, target: np.ndarray, calm: bool, hit: np.ndarray, total: np.ndarray) -> None:
    """Turns rows of logits into exponentials; fills in their targets' logits
    and their sums."""
    if not calm:
        s -= s.max(axis=1, keepdims=True)
    hit[:] = s[np.arange(len(s)), target]
    np.matmul(np.exp(s, out=s), np.ones(s.shape[1], s.dtype), out=total)


class Places:
    """Index of each value among sorted ``keys``, or -1, as ``C.member`` gives
    it, by a table over the top bits: hashes spread evenly over it."""

    def __init__(self, keys: np.ndarray):
        bits = min(20, 2 + len(keys).bit_length())
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.count = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = (np.cumsum(self.count) - self.count).astype(np.int32)
        self.most = int(self.count.max())

    def __call__(self, values: np.ndarray) -> np.ndarray:
        if not len(self.keys) or self.most > 16:
            return C.member(values, self.keys)
        slot = (values >> self.shift).view(np.int64)
        out = self.first[slot].astype(np.int64)
        left = np.flatnonzero(self.keys.take(out, mode="clip") != values)
        at, size = out[left], self.count[slot[left]]
        out[left] = -1
        for k in range(1, self.most):
            more = np.flatnonzero(size > k)
            left, at, size = left[more], at[more], size[more]
            out[left] = np.where(self.keys[at + k] == values[left], at + k, out[left])
        return out


def _sums_by(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``x`` and the sum of the ``rows`` of each: first rows
    with first rows, seconds with seconds, ...; of values with many, one by one."""
    x = x.astype(np.uint16) if x.max(initial=0) < 1 << 16 else x
    order = np.argsort(x, kind="stable")
    ordered = x[order]
    first = np.flatnonzero(np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1])))
    n = np.diff(np.append(first, len(x)))
    rows = rows.take(order, axis=0, mode="clip")
    out, ones = rows.take(first, axis=0), np.ones(int(n.max(initial=0)), rows.dtype)
    many = np.flatnonzero(n > 8)
    for i, a, size in zip(many.tolist(), first[many].tolist(), n[many].tolist()):
        np.matmul(ones[:size], rows[a : a + size], out=out[i])
    for k in range(1, 8):
        at = np.flatnonzero((n > k) & (n <= 8))
        out[at] += rows.take(first[at] + k, axis=0)
    return ordered[first], out


class GruModel:
    """Words are numbered by frequency; number ``size`` is the unknown word,
    ``size + 1`` (input only) the beginning of a text. The unknown word is a
    class of its own, the last one."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, unknown: float, spelling: np.ndarray, seed: int = 11):
        order = np.argsort(words)
        self.sorted, self.rank = words[order], order
        self.size = len(words)
        self.in_class = max(IN_CLASS, int(np.ceil(np.sqrt(self.size))))
        self.classes = -(-self.size // self.in_class) + 1
        self.cls, self.hit = (x.astype(np.int16) for x in divmod(np.arange(self.size + 1), self.in_class))
        self.cls[self.size] = self.classes - 1
        rng = np.random.default_rng(seed)
        table = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {
            "input": table(self.size + 2, 3 * HIDDEN),
            "gates": table(HIDDEN, 2 * HIDDEN),
            "cand": table(HIDDEN, HIDDEN),
            "cls": table(HIDDEN, self.classes) * 0,
            "word": np.zeros(((self.classes - 1) * self.in_class, HIDDEN), np.float32),
        }
        self.p["input"][:, :HIDDEN] += 1.0  # keep the state at first
        padded = np.full((self.classes - 1) * self.in_class, 0.0)
        padded[: self.size] = counts
        mass = np.append(padded.reshape(-1, self.in_class).sum(axis=1), unknown)
        self.p["cls_b"] = np.log(np.maximum(mass, 0.5) / max(1.0, mass.sum())).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.p["word_b"] = np.where(np.arange(len(padded)) < self.size, np.log(np.maximum(padded, 0.5)), -1e9).astype(np.float32)
        # spelling: P(byte | previous byte), ends included, add-half
        grams = spelling.reshape(256, 256) + 0.5
        self.spelling = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32).reshape(-1)

    @cached_property
    def places(self) -> Places:
        return Places(self.sorted)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        return np.append(self.rank, self.size)[self.places(hashes)]  # -1: the last

    def by_gate(self) -> tuple[np.ndarray, np.ndarray]:
        """Inputs (gate, token) and weights of the gates apart, so that what a step works on
        lies together."""
        inputs = self.p["input"].reshape(-1, 3, HIDDEN).transpose(1, 0, 2)
        return np.ascontiguousarray(inputs), np.stack((self.p["gates"][:, :HIDDEN], self.p["gates"][:, HIDDEN:]))

    def step(self, x: np.ndarray, h: np.ndarray, by_gate=None):
        inputs, gates = by_gate or self.by_gate()
        a = inputs.take(x, axis=1, mode="clip")
        g = h @ gates
        g += a[:2]
        z, r = _sigmoid(g)
        n = (r * h) @ self.p["cand"]
        n += a[2]
        np.tanh(n, out=n)
        h = h - n
        h *= z
        h += n
        return h, z, r, n

    def output(self) -> tuple[np.ndarray, np.ndarray, bool, bool]:
        """Weights of classes and words with their biases as a last column (the
        state gets a last component 1), and whether their exponentials can
        neither overflow nor all vanish: components of a state are within 1."""
        cls = np.concatenate((self.p["cls"].T, self.p["cls_b"][:, None]), axis=1)
        word = np.concatenate((self.p["word"], self.p["word_b"][:, None]), axis=1)

        def calm(table: np.ndarray, group: int) -> bool:
            most = np.sqrt(HIDDEN * np.einsum("ij,ij->i", table[:, :-1], table[:, :-1]))
            high, low = (table[:, -1] + most).max(initial=0), (table[:, -1] - most).reshape(-1, group).max(axis=1).min(initial=0)
            return high < 60 and low > -60

        return cls, word, calm(cls, len(cls)), calm(word, self.in_class)

    def log_prob(self, h: np.ndarray, y: np.ndarray, output=None) -> np.ndarray:
        """Natural log P(y | state), the spelling of unknown words apart; the
        states may have their last component 1 already."""
        by_class, by_word, calm_class, calm_word = output or self.output()
        if h.shape[1] == HIDDEN:
            h = np.concatenate((h, np.ones((len(h), 1), np.float32)), axis=1)
        cls, group = self.cls[y], self.in_class
        hit, total = np.empty((2, len(y)), h.dtype)
        s = np.empty((min(ROWS_AT_ONCE, len(y)), max(self.classes, group)), h.dtype).reshape(-1)

        def part(rows: np.ndarray, weights: np.ndarray, target: np.ndarray, calm: bool, lo: int, hi: int) -> None:
            for a in range(lo, hi, ROWS_AT_ONCE):
                b = min(a + ROWS_AT_ONCE, hi)
                at = np.matmul(rows[a:b], weights.T, out=s[: (b - a) * len(weights)].reshape(b - a, -1))
                _softmax_parts(at, target[a:b], calm, hit[a:b], total[a:b])

        part(h, by_class, cls, calm_class, 0, len(y))
        out = hit - np.log(total)
        order, cuts = self.known(cls)
        h, target = h[order], self.hit[y[order]]
        for c in range(self.classes - 1):
            part(h, by_word[c * group : (c + 1) * group], target, calm_word, int(cuts[c]), int(cuts[c + 1]))
        out[order] += hit[: len(order)] - np.log(total[: len(order)])
        return out

    def known(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Known words ordered by class, and where each class begins."""
        cuts = np.append(0, np.cumsum(np.bincount(cls, minlength=self.classes)))
        return np.argsort(cls, kind="stable")[: cuts[self.classes - 1]], cuts

    def score(self, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of natural logs per text; ``y``: all texts' tokens end to end.
        Texts of about the same length are lanes of one batch."""
        total = np.zeros(len(counts))
        order, starts = np.argsort(-counts, kind="stable"), np.cumsum(counts) - counts
        output, by_gate = self.output(), self.by_gate()
        for lo in range(0, len(order), BATCH):
            lane = order[lo : lo + BATCH]
            total[lane] = self._score_lanes(y, starts[lane], counts[lane], output, by_gate)
        return total

    def _score_lanes(self, y: np.ndarray, first: np.ndarray, size: np.ndarray, output, by_gate) -> np.ndarray:
        total, longest = np.zeros(len(size)), int(size[0])
        live = np.searchsorted(-size, -np.arange(longest), "left")
        h = np.zeros((len(size), HIDDEN), np.float32)
        prev = np.full(len(size), self.size + 1)
        states = np.ones((int(live[:WINDOW].sum()), HIDDEN + 1), np.float32)
        targets = np.empty(len(states), np.int64)
        for lo in range(0, longest, WINDOW):
            ends = np.append(0, np.cumsum(live[lo : lo + WINDOW])).tolist()
            for t, (a, b) in enumerate(zip(ends, ends[1:]), lo):
                h = self.step(prev[: b - a], h[: b - a], by_gate)[0]
                states[a:b, :HIDDEN] = h
                prev = targets[a:b] = y[first[: b - a] + t]
            logs = self.log_prob(states[: ends[-1]], targets[: ends[-1]], output)
            for a, b in zip(ends, ends[1:]):
                total[: b - a] += logs[a:b]
        return total

    # ------------------------------------------------------------- training

    def window_gradients(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, inside: np.ndarray | None = None, g: dict | None = None):
        """One truncated window: x, y, fresh, inside (steps, lanes); gradients
        of the mean loss, the loss, and the state to carry on. Places that are
        not ``inside`` lie behind the end of their lane and do not count. ``g``:
        gradients of an earlier window, whose tables are used again."""
        p, steps, lanes = self.p, *x.shape
        inputs, w_gates = self.by_gate()
        new = fresh.any(axis=1)
        hp, rh, out = (np.empty((steps, lanes, HIDDEN), np.float32) for _ in range(3))
        gates, n = np.empty((steps, 2, lanes, HIDDEN), np.float32), np.empty((steps, lanes, HIDDEN), np.float32)
        z, r = gates[:, 0], gates[:, 1]
        for t, (prev, g_t, r_t, z_t, rh_t, n_t, next_h) in enumerate(zip(hp, gates, r, z, rh, n, out)):
            prev[:] = h
            if new[t]:
                prev[fresh[t]] = 0
            np.matmul(prev, w_gates, out=g_t)
            a = inputs.take(x[t], axis=1, mode="clip")
            g_t += a[:2]
            _sigmoid(g_t)
            np.multiply(r_t, prev, out=rh_t)
            np.matmul(rh_t, p["cand"], out=n_t)
            n_t += a[2]
            np.tanh(n_t, out=n_t)
            h = np.subtract(prev, n_t, out=next_h)
            h *= z_t
            h += n_t
        flat, target = out.reshape(-1, HIDDEN), y.reshape(-1)
        at = slice(None) if inside is None or inside.all() else np.flatnonzero(inside.reshape(-1))
        flat, target = flat[at], target[at]
        d_all, whole = np.zeros((steps * lanes, HIDDEN), np.float32), at
        count, group = len(target), self.in_class
        cls = self.cls[target]
        g = g or {k: np.zeros(p[k].shape, p[k].dtype) for k in ("input", "word", "word_b")} | {"both": np.empty((len(p["word"]), HIDDEN + 1), p["word"].dtype)}
        g["input"].fill(0)
        by_class, by_word, calm_class, calm_word = self.output()
        with_one = np.concatenate((flat, np.ones((count, 1), np.float32)), axis=1)
        share = np.float32(1 / max(1, count))

        def miss(s: np.ndarray, hit: np.ndarray, calm: bool) -> float:
            """Turns logits into (probabilities less the target) / count; the loss."""
            loss = 0.0
            for lo in range(0, len(s), ROWS_AT_ONCE):
                part, goal = s[lo : lo + ROWS_AT_ONCE], hit[lo : lo + ROWS_AT_ONCE]
                wanted, total = np.empty((2, len(part)), s.dtype)
                _softmax_parts(part, goal, calm, wanted, total)
                part *= (share / total)[:, None]
                part[np.arange(len(part)), goal] -= share
                loss += float((np.log(total) - wanted).sum(dtype=np.float64))
            return loss

        prob = with_one @ by_class.T
        loss = miss(prob, cls, calm_class)
        both = prob.T @ with_one
        g["cls"], g["cls_b"] = both[:, :-1].T, both[:, -1]
        d_out = prob @ by_class[:, :-1]
        order, cuts = self.known(cls)
        cuts = cuts[: self.classes].tolist()
        parts = [(slice(lo, hi), slice(c * group, (c + 1) * group)) for c, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
        sorted_h = with_one[order]
        s, d_sorted = np.empty((len(order), group), sorted_h.dtype), np.empty((len(order), HIDDEN), np.float32)
        for rows, w in parts:
            np.matmul(sorted_h[rows], by_word[w].T, out=s[rows])
        loss += miss(s, self.hit[target[order]], calm_word)
        for rows, w in parts:
            np.matmul(s[rows].T, sorted_h[rows], out=g["both"][w])
            np.matmul(s[rows], p["word"][w], out=d_sorted[rows])
        g["word"][:], g["word_b"][:] = g["both"][:, :-1], g["both"][:, -1]
        d_out[order] += d_sorted
        d_all[whole] = d_out
        d_out = d_all.reshape(steps, lanes, HIDDEN)
        # how the inputs of the three gates move the next state
        off = 1 - gates
        off *= gates
        by_n = n * n
        np.subtract(1, by_n, out=by_n)
        by_n *= 1 - z
        by_z = hp - n
        by_z *= off[:, 0]
        by_r = np.multiply(hp, off[:, 1])
        d = np.zeros((lanes, HIDDEN), np.float32)
        d_in = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        dz, dr, dn = (d_in[:, :, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        to_cand, to_gates = np.ascontiguousarray(p["cand"].T), np.ascontiguousarray(p["gates"].T)
        every = list(zip(d_out, by_n, by_z, by_r, z, r, dn, dz, dr, d_in[:, :, : 2 * HIDDEN]))
        for t in range(steps - 1, -1, -1):
            d_t, n_t, bz_t, br_t, z_t, r_t, dn_t, dz_t, dr_t, gates_t = every[t]
            d += d_t
            dn_t[:] = d_n = d * n_t
            np.multiply(d, bz_t, out=dz_t)
            drh = d_n @ to_cand
            np.multiply(drh, br_t, out=dr_t)
            d *= z_t
            drh *= r_t
            d += drh
            d += gates_t @ to_gates
            if new[t]:
                d[fresh[t]] = 0
        d_in = d_in.reshape(-1, 3 * HIDDEN)
        g["cand"] = rh.reshape(-1, HIDDEN).T @ d_in[:, 2 * HIDDEN :]
        g["gates"] = hp.reshape(-1, HIDDEN).T @ d_in[:, : 2 * HIDDEN]
        rows, sums = _sums_by(x.reshape(-1), d_in)
        g["input"][rows] = sums
        g["used"] = rows, np.flatnonzero(np.diff(cuts))
        return g, loss / max(1, count), h

    def train(self, texts: list[np.ndarray], passes: int = 1, rate: float = RATE, adam: Adam | None = None) -> int:
        """Adam over windows of the texts, all of each; the tokens trained on."""
        adam, tokens = adam or Adam(self.p), 0
        for _ in range(passes):
            pieces = []
            for t in texts:
                prev = np.append(self.size + 1, t[:-1])
                pieces += [(prev[lo : lo + STRETCH], t[lo : lo + STRETCH]) for lo in range(0, len(t), STRETCH)]
            # the longest first, each to the shortest lane; in a lane as they came
            dealt: list[list[int]] = [[] for _ in range(min(LANES, len(pieces)))]
            load = [(0, i) for i in range(len(dealt))]
            for k in sorted(range(len(pieces)), key=lambda k: -len(pieces[k][1])):
                n, i = load[0]
                dealt[i].append(k)
                heapq.heapreplace(load, (n + len(pieces[k][1]), i))
            lanes = [[pieces[k] for k in sorted(ks)] for ks in dealt]
            lanes.sort(key=lambda lane: -sum(len(t) for _, t in lane))
            size = np.array([sum(len(t) for _, t in lane) for lane in lanes], np.int64)
            x, y = (np.zeros((int(size.max(initial=0)), len(lanes)), np.int32) for _ in range(2))
            begins = np.zeros(x.shape, bool)
            for i, lane in enumerate(lanes):
                x[: size[i], i] = np.concatenate([a for a, _ in lane])
                y[: size[i], i] = np.concatenate([t for _, t in lane])
                begins[np.cumsum([0] + [len(t) for _, t in lane[:-1]]), i] = True
            h, g = np.zeros((len(lanes), HIDDEN), np.float32), None
            for lo in range(0, len(x), TRAIN_WINDOW):
                live = int(np.searchsorted(-size, -lo, "left"))
                s = slice(lo, lo + TRAIN_WINDOW), slice(0, live)
                inside = np.arange(lo, lo + len(x[s]))[:, None] < size[:live]
                g, _, h = self.window_gradients(x[s], y[s], begins[s], h[:live], inside, g)
                inputs, cls = g["used"]
                words = (cls[:, None] * self.in_class + np.arange(self.in_class)).reshape(-1)
                # the end of a batch, with few lanes left, takes smaller steps
                adam.step(self.p, g, {"input": inputs, "word": words, "word_b": words}, rate, inside.sum() / (TRAIN_WINDOW * len(lanes)))
            tokens += int(size.sum())
        return tokens


class Adam:
    """Moments of the weights; of a table most of whose rows are not in use only
    those in use are moved."""

    def __init__(self, p: dict):
        self.m, self.v = ({k: np.zeros(a.shape, a.dtype) for k, a in p.items()} for _ in range(2))
        self.n = 0

    def step(self, p: dict, g: dict, rows: dict, rate: float, share: float) -> None:
        self.n += 1
        at = {k: rows[k] if k in rows and 2 * len(rows[k]) < len(p[k]) else None for k in p}
        used = {k: g[k] if at[k] is None else g[k][at[k]] for k in p}
        norm = share * np.sqrt(sum(float(np.vdot(a, a)) for a in used.values()))
        scale = np.float32(share * min(1.0, 1.0 / (norm + 1e-9)))
        least = np.float32(1e-7 * np.sqrt(1 - 0.99**self.n))
        speed = np.float32(rate * np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n))
        for k, a in used.items():
            i, tables = at[k], (self.m[k], self.v[k], p[k])
            some = tables if i is None else [x[i] for x in tables]
            a, *flat = (x.reshape(-1) for x in (a, *some))
            for lo in range(0, len(a), AT_ONCE):
                m, v, w = (x[lo : lo + AT_ONCE] for x in flat)
                b = np.multiply(a[lo : lo + AT_ONCE], scale)
                t = np.subtract(b, m)
                t *= np.float32(0.1)
                m += t
                np.multiply(b, b, out=b)
                b -= v
                b *= np.float32(0.01)
                v += b
                np.sqrt(v, out=t)
                t += least
                np.divide(m, t, out=t)
                t *= speed
                w -= t
            if i is not None:
                for x, new in zip(tables, some):
                    x[i] = new


# ------------------------------------------------------------------- the query


def _sequence(model: GruModel, words: C.Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all texts end to end, each with its end."""
    counts = words.counts + 1
    y = np.empty(int(counts.sum()), np.int64)
    at = np.cumsum(counts) - 1
    inside = np.ones(len(y), bool)
    inside[at] = False
    y[inside] = model.numbers(h)
    y[at] = model.numbers(np.array([END]))[0]
    return y, counts


def _score(batches: Iterator[pa.RecordBatch], model: GruModel, hot: np.ndarray, hot_n: np.ndarray) -> Iterator[pa.RecordBatch]:
    places, log_n = Places(hot), np.log10(hot_n + 0.5)
    held: list[tuple] = []

    def flush():
        columns, y, counts, spelled = zip(*held)
        total = model.score(np.concatenate(y), np.concatenate(counts)) + np.concatenate(spelled)
        lo = 0
        for some, n in zip(columns, map(len, counts)):
            yield pa.RecordBatch.from_arrays([*some, pa.array(total[lo : lo + n] / np.log(10))], ["doc_id", "th", "n_tokens", "hot_sum", "hot_known", "score"])
            lo += n

    for piece in C.text_slices(batches, limit=SLICE):
        n = piece.num_rows
        words = C.Words(piece.column("text"))
        h = words.hashes(lower=True)
        doc = words.doc()
        at = places(h)
        of_hot, at = doc[at >= 0], at[at >= 0]
        hot_sum = np.bincount(of_hot, log_n[at], minlength=n)
        hot_known = np.bincount(of_hot, hot_n[at] > 0, minlength=n).astype(np.int64)
        y, counts = _sequence(model, words, h)
        spelled = np.zeros(n)
        end = np.cumsum(counts) - 1
        unknown = np.flatnonzero(np.delete(y, end) == model.size)
        if len(unknown):
            code, first = _bigrams(words, unknown)
            spelled += np.bincount(doc[unknown], np.add.reduceat(model.spelling[code], first), minlength=n)
        columns = [piece.column("doc_id"), piece.column("th"), pa.array(counts.astype(np.int64)), pa.array(hot_sum), pa.array(hot_known)]
        held.append((columns, y.astype(np.int32), counts, spelled))
        if sum(len(x[1]) for x in held) >= TOGETHER:
            yield from flush()
            held.clear()
    if held:
        yield from flush()


_WEIGHTS = "piece int, part int, tokens long, w binary"


def _train_part(batches: Iterator[pa.RecordBatch], model: GruModel) -> Iterator[pa.RecordBatch]:
    """A partition's round: its weights after all its texts, in pieces."""
    own = copy.copy(model)
    own.p = {k: v.copy() for k, v in model.p.items()}  # the broadcast stays as it is
    adam, tokens = Adam(own.p), 0
    for piece in C.text_slices(batches, limit=SLICE):
        words = C.Words(piece.column("text"))
        y, sizes = _sequence(own, words, words.hashes(lower=True))
        tokens += own.train(np.split(y, np.cumsum(sizes)[:-1]), adam=adam)
    if tokens:
        flat = np.concatenate([own.p[k].reshape(-1) for k in sorted(own.p)])
        part = TaskContext.get().partitionId()
        for i, lo in enumerate(range(0, len(flat), PIECE)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([tokens]), pa.array([C.blob(flat[lo : lo + PIECE])], pa.binary())], ["piece", "part", "tokens", "w"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece and group (``to``) the mean weights, summed up as they come;
    rows come sorted, so that reruns agree."""
    now, total, n = None, None, 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([n]), pa.array([C.blob((total / n).astype(np.float32))], pa.binary())], ["piece", "part", "tokens", "w"])

    for batch in batches:
        for piece, to, tokens, w in zip(*(batch.column(c) for c in ("piece", "to", "tokens", "w"))):
            if (piece.as_py(), to.as_py()) != now:
                if now is not None:
                    yield out()
                now, total, n = (piece.as_py(), to.as_py()), 0.0, 0
            total = total + np.frombuffer(w.as_py(), np.float32).astype(np.float64) * tokens.as_py()
            n += tokens.as_py()
    if now is not None:
        yield out()


def _averaged(parts: DataFrame, tasks: int, to) -> DataFrame:
    rows = parts.withColumn("to", to.cast("int")).repartition(tasks, "piece", "to").sortWithinPartitions("piece", "to", "part")
    return rows.mapInArrow(C.frugal(_average), _WEIGHTS)


def train_rounds(rows: DataFrame, model: GruModel, rounds: int = ROUNDS) -> int:
    """Train ``model`` on all training rows (doc_id, text, th, train), each in
    one of the rounds; the number of tokens trained on."""
    spark, seen = rows.sparkSession, 0
    size = sum(v.size for v in model.p.values())
    pieces, tasks = -(-size // PIECE), C.partitions(spark, 0, 1)
    groups = max(1, isqrt(rows.select("text")._jdf.rdd().getNumPartitions()))
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        mine = rows.where(F.col("train") & (F.pmod(F.xxhash64(F.lit("round"), "doc_id", "th"), F.lit(rounds)) == r))
        parts = mine.select("text").mapInArrow(C.frugal(lambda b, sent=sent: _train_part(b, sent.value)), _WEIGHTS)
        some = _averaged(parts, min(pieces * groups, tasks), F.pmod(F.col("part"), F.lit(groups)))
        mean = _averaged(some, min(pieces, tasks), F.lit(0))
        got = sorted(mean.select("piece", "tokens", "w").collect())  # one model
        sent.unpersist()
        if not got:
            continue
        seen += got[0]["tokens"]
        flat, at = np.concatenate([np.frombuffer(x["w"], np.float32) for x in got]), 0
        for k in sorted(model.p):
            v = model.p[k]
            model.p[k] = flat[at : at + v.size].reshape(v.shape).copy()
            at += v.size
    return seen


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"), (C.crc_mod5(F.col("doc_id")) != 1).alias("train"))
    report = C.cut(rows.select("text", "train").mapInArrow(_scan, _REPORT))
    tokens = report.where("kind = 0").agg(F.sum("count")).first()[0] or 0
    train_docs = rows.where("train").count()
    hot, _ = C.hot_keys(report.where("kind = 1").select("key", "count"), tokens)
    grams = report.where("kind = 2").groupBy("key").agg(F.sum("count").alias("n")).collect()  # at most 65,536
    spelling = np.zeros(1 << 16)
    for r in grams:
        spelling[r["key"]] = r["n"]

    least = max(LEAST, int(np.ceil(round(tokens ** (2 / 3), 6) / SPREAD)))
    tasks = C.partitions(spark, tokens * 5 // 4, PER_TASK)
    sent = rows.mapInArrow(lambda b: _tokens(b, hot, 8 * tasks), _ROWS)
    counted = C.cut(sent.repartition(tasks, "key").mapInArrow(lambda b: _count(b, least), _ROWS))
    others = counted.where("kind = 3").agg(F.sum("key")).first()[0] or 0
    found = {}
    for r in counted.where("kind = 2").select("a", "b").toLocalIterator():  # at most 2^18 hot words
        found |= dict(zip(np.frombuffer(r["a"], np.uint64).tolist(), np.frombuffer(r["b"], np.int64).tolist()))
    hot_n = np.array([found.get(k, 0) for k in hot.tolist()], np.int64)
    distinct = others + int((hot_n > 0).sum()) + (1 if train_docs else 0)

    often = [(k, n) for k, n in zip(hot.tolist(), hot_n.tolist()) if n >= least]
    for r in counted.where("kind = 4").select("a", "b").toLocalIterator():  # at most SPREAD * N^(1/3) words
        often += zip(np.frombuffer(r["a"], np.uint64).tolist(), np.frombuffer(r["b"], np.int64).tolist())
    often.sort(key=lambda x: (-x[1], x[0]))
    names, counts = np.array([int(END)] + [k for k, _ in often], np.uint64), np.array([train_docs] + [n for _, n in often], float)
    model = GruModel(names, counts, tokens - counts.sum(), spelling)
    train_rounds(rows, model)
    sent_model = spark.sparkContext.broadcast((model, hot, hot_n))

    cold = counted.where("kind in (0, 1)").repartition(tasks, "chunk").mapInArrow(_collect_chunks, "doc_id long, th long, cold_sum double, cold_known long")
    cold = cold.groupBy("doc_id", "th").agg(F.min("cold_sum").alias("cold_sum"), F.min("cold_known").alias("cold_known")).withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    scored = rows.select("doc_id", "th", "text").mapInArrow(C.frugal(lambda b: _score(b, *sent_model.value)), "doc_id long, th long, n_tokens long, hot_sum double, hot_known long, score double")
    both = scored.join(cold, scored["doc_id"].eqNullSafe(cold["_d"]) & scored["th"].eqNullSafe(cold["_t"]), "left")
    end = float(np.log10(train_docs + 0.5))
    shared = float(np.log10(tokens + 0.5 * (distinct + 1)))
    base = F.col("cold_sum") + F.col("hot_sum") + F.lit(end) - F.col("n_tokens") * F.lit(shared)
    known = F.col("cold_known") + F.col("hot_known") + F.lit(1 if train_docs else 0)
    return both.select("doc_id", "n_tokens", known.alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(C.read(spark, sf_dir, "documents"))
    held = (C.crc_mod5(F.col("doc_id")) == 1).alias("held_out")
    return scored.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")
