"""Operator 2 - language identification of code-switched text by a
linear-chain conditional random field over words.

Each word has a language; a text's result is the language with the largest
expected number of words. Emission features of a word (A-Z lower-cased
bytes): its byte bigrams and trigrams, prefixes and suffixes of 1 to 3 bytes,
and the lexicon it is in (words that the training texts use almost only in
one language). Transitions between languages are learned with them, from
training sequences that switch language every few words.

Inference is exact forward-backward. The chain is cut into blocks of
``STEP`` words: the transfer matrix of every block is a product over its
words (all blocks of a slice at once), messages pass from block to block
within each text, and then within all blocks at once. The cost does not
depend on how long a single text is.

The model is fitted at the driver on a bounded sample (about ``SAMPLE`` texts
of each language, by hash of the id, up to ``LONGEST`` characters, and of
their words at most ``TRAIN_WORDS`` a language, in runs from all over the
texts) of rows with a language whose crc32(doc_id) mod 5 is not 0, and
broadcast (its size depends on the number of languages only).

Defined results: null text, or text without letters: ``und`` with score 0;
null doc_id: held_out is null, never trained on; without any labelled row
everything is ``und``; repeated rows are scored each; ties go to the language
first by name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C
from surgecast.operators.joins import as_side

SAMPLE = 300
LONGEST = 20_000
STEP = 64
EPOCHS = 30
TRAIN_WORDS = 60_000  # of each language, in runs drawn from all of its sampled texts
SLICE = 1 << 19  # bytes of text at once; scratch memory is some 60 times that
LEXICON = 3  # occurrences that make a lexicon word
UNDETERMINED = "und"
_BINS = 1 << 16


class Features:
    """Feature numbers of the words of some texts. ``two``/``three``: per
    byte, the n-gram that starts there (``_BINS`` where none does)."""

    def __init__(self, column: pa.Array):
        self.words = w = C.Words(column)
        b = C.fold(w.data).astype(np.int32)
        n = len(b)
        # how many bytes of its word lie at and after each byte
        room = np.zeros(n + 1, np.int32)
        if len(w):
            size = w.end - w.start
            at = C.ranges(w.start, size)
            room[at] = np.repeat(w.end, size) - at
            del at
        nxt, nxt2 = np.roll(b, -1), np.roll(b, -2)
        self.two = np.where(room[:n] >= 2, b * 256 + nxt, _BINS)
        self.three = np.where(room[:n] >= 3, (b * 65599 + nxt * 257 + nxt2 * 40503) & (_BINS - 1), _BINS)
        self.hash = w.hashes(lower=True)
        size = w.end - w.start
        self.affixes = []
        for k in (1, 2, 3):
            for side in (0, 1):
                code = np.full(len(w), 7919 * k + 104729 * side, np.int64)  # passes 32 bits
                for j in range(k):
                    place = np.minimum(w.start + j, n - 1) if side == 0 else np.maximum(w.end - 1 - j, 0)
                    code = code * 263 + b[place] if n else code
                self.affixes.append(np.where(size >= k, (code ^ (code >> 15)) & (_BINS - 1), _BINS).astype(np.int32))
        letter = ((b >= 97) & (b <= 122)) | (b >= 128)
        self.lettered = np.add.reduceat(letter, w.start) > 0 if len(w) else np.zeros(0, bool)


class Corpus:
    """Features of the words of all training texts, made a slice of texts at
    a time: the driver holds 8 bytes a byte of text and 44 a word."""

    def __init__(self, texts: list[str], limit: int = SLICE):
        parts, counts, start, size, base = [], [], [], [], 0
        column = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
        for piece in C.text_slices(iter([column]), limit=limit):
            f = Features(piece.column("text"))
            counts.append(f.words.counts)
            start.append(f.words.start + base)
            size.append((f.words.end - f.words.start).astype(np.int32))
            base += len(f.words.data)
            parts.append((f.two, f.three, f.hash, *f.affixes))
        self.counts, self.start, self.size = (np.concatenate(x) for x in (counts, start, size))
        self.two, self.three, self.hash, *self.affixes = (np.concatenate(x) for x in zip(*parts))


class CrfModel:
    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.two, self.three, self.affix = (np.zeros((k, _BINS + 1), np.float32) for _ in range(3))
        self.lexicon = np.zeros(0, np.uint64)
        self.lexicon_of = np.zeros(0, np.int64)
        self.lex = np.zeros((k, k + 1), np.float32)
        self.bias = np.zeros(k, np.float32)
        self.switch = np.eye(k, dtype=np.float64) * 2.0  # log potentials

    def lexicon_index(self, hashes: np.ndarray) -> np.ndarray:
        at = C.member(hashes, self.lexicon)
        return np.where(at >= 0, self.lexicon_of[at] if len(self.lexicon_of) else 0, len(self.languages))

    def emissions(self, f: Features) -> np.ndarray:
        """Log potentials (words, languages)."""
        out = np.empty((len(f.words), len(self.languages)), np.float32)
        index = self.lexicon_index(f.hash)
        for j in range(len(self.languages)):
            per_byte = self.two[j][f.two] + self.three[j][f.three]
            total = np.add.reduceat(per_byte, f.words.start) if len(f.words) else np.zeros(0, np.float32)
            for code in f.affixes:
                total = total + self.affix[j][code]
            out[:, j] = total + self.lex[j][index] + self.bias[j]
        return out


class Chains:
    """Forward-backward over texts of any length, in blocks of STEP words."""

    def __init__(self, counts: np.ndarray, step: int = STEP):
        blocks = -(-counts // step)
        self.step, self.counts, self.blocks = step, counts, blocks
        self.first = np.cumsum(blocks) - blocks
        n = int(blocks.sum())
        self.doc = np.repeat(np.arange(len(counts)), blocks)
        number = C.ranges(np.zeros(len(blocks), np.int64), blocks)
        self.size = np.minimum(step, counts[self.doc] - number * step)
        self.n = n
        # words in block order: (place in block, block)
        word = np.arange(int(counts.sum()))
        within = C.ranges(np.zeros(len(counts), np.int64), counts)
        self.block = np.repeat(self.first, counts) + within // step
        self.place = within % step
        self.word = word

    def run(self, log_emission: np.ndarray, switch: np.ndarray, pairs: bool = False):
        """Marginals (words, labels); with ``pairs`` also the expected number
        of each label pair."""
        k = log_emission.shape[1]
        e = np.ones((self.step, self.n, k))
        if len(self.word):
            e[self.place, self.block] = np.exp(log_emission - log_emission.max(axis=1, keepdims=True)) + 1e-30
        t = np.exp(switch - switch.max())
        live = [np.flatnonzero(self.size > i) for i in range(self.step)]
        whole = [len(x) == self.n for x in live]
        starts = np.zeros(self.n, bool)
        starts[self.first[self.blocks > 0]] = True
        first = np.flatnonzero(starts)
        product = np.broadcast_to(np.eye(k), (self.n, k, k)).copy()
        for i in range(self.step):
            at = slice(None) if whole[i] else live[i]
            p = (product[at].reshape(-1, k) @ t).reshape(-1, k, k)
            if i == 0:
                p[first] = 1.0 / k  # a text starts in any label
            p *= e[i][at][:, None, :]
            product[at] = p / p.sum(axis=(1, 2), keepdims=True)
        enter = np.full((self.n, k), 1.0 / k)
        leave = np.ones((self.n, k))
        order = np.argsort(-self.blocks, kind="stable")
        longest = int(self.blocks.max()) if len(self.blocks) else 0
        many = np.searchsorted(-self.blocks[order], -np.arange(longest + 1), "left")  # texts with more than j blocks
        for j in range(1, longest):
            b = self.first[order[: many[j]]] + j
            v = np.einsum("bi,bij->bj", enter[b - 1], product[b - 1])
            enter[b] = v / v.sum(axis=1, keepdims=True)
        for j in range(longest - 1, 0, -1):
            b = self.first[order[: many[j]]] + j
            v = np.einsum("bij,bj->bi", product[b], leave[b])
            leave[b - 1] = v / v.sum(axis=1, keepdims=True)
        alpha = np.empty((self.step, self.n, k))
        v = enter
        before = []
        for i in range(self.step):
            a = v @ t
            if i == 0:
                a[first] = 1.0 / k
            a = a * e[i]
            a /= a.sum(axis=1, keepdims=True)
            before.append(v)
            v = a if whole[i] else np.where((self.size > i)[:, None], a, v)
            alpha[i] = v
        expected = np.zeros((k, k))
        v = leave
        for i in range(self.step - 1, -1, -1):
            alpha[i] *= v
            pull = v * e[i]
            if pairs:
                joint = before[i][:, :, None] * t[None] * pull[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                use = (self.size > i) & ~(starts if i == 0 else np.zeros(self.n, bool))
                expected += joint[use].sum(axis=0)
            back = pull @ t.T
            back /= back.sum(axis=1, keepdims=True)
            v = back if whole[i] else np.where((self.size > i)[:, None], back, v)
        m = alpha[self.place, self.block] if len(self.word) else np.zeros((0, k))
        m /= m.sum(axis=1, keepdims=True)
        return (m, expected) if pairs else m


def fit(texts: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> CrfModel:
    """Train on (language, text) pairs: maximum likelihood, Adagrad."""
    languages = sorted({lang for lang, _ in texts})
    model = CrfModel(languages)
    k = len(languages)
    if k < 2:
        return model
    f = Corpus([t for _, t in texts])
    counts = f.counts
    last = np.cumsum(counts)
    label = np.repeat([languages.index(lang) for lang, _ in texts], counts)
    # lexicon: words found at least LEXICON times, nine in ten of them in one language
    names, at = np.unique(f.hash, return_inverse=True)
    seen = np.stack([np.bincount(at, label == j, minlength=len(names)) for j in range(k)])
    total = seen.sum(axis=0)
    own = (total >= LEXICON) & (seen.max(axis=0) >= 0.9 * total)
    model.lexicon, model.lexicon_of = names[own], seen.argmax(axis=0)[own]
    # training sequences: runs of 4 to 24 words, shuffled over all texts
    rng = np.random.default_rng(seed)
    runs = []
    for lo, hi in zip((last - counts).tolist(), last.tolist()):
        while lo < hi:
            size = int(rng.integers(4, 25))
            runs.append((lo, min(hi, lo + size)))
            lo += size
    order, left = [], [TRAIN_WORDS] * k
    for i in rng.permutation(len(runs)).tolist():
        lo, hi = runs[i]
        if left[label[lo]] > 0:  # each language has its own share of the words
            left[label[lo]] -= hi - lo
            order.append(i)
    word = np.concatenate([np.arange(*runs[i]) for i in order]) if order else np.zeros(0, np.int64)
    word = word[: len(word) // STEP * STEP] if len(word) >= STEP else word
    chains = Chains(np.full(max(1, len(word) // STEP), min(STEP, len(word)), np.int64))
    gold = label[word]
    target = np.zeros((len(word), k))
    target[np.arange(len(word)), gold] = 1.0
    same = np.arange(1, len(word)) % STEP != 0
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[:-1][same], gold[1:][same]), 1.0)
    bytes_of = C.ranges(f.start[word], f.size[word])
    owner = np.repeat(np.arange(len(word)), f.size[word])
    two, three = f.two[bytes_of], f.three[bytes_of]
    affixes = [a[word] for a in f.affixes]
    index = model.lexicon_index(f.hash)
    del f, bytes_of
    # the lexicon is made of the same texts: hide it from a third of the words
    index[rng.random(len(index)) < 0.33] = k
    index = index[word]
    squares = {name: np.full_like(getattr(model, name), 1e-2, dtype=np.float64) for name in ("two", "three", "affix", "lex", "bias", "switch")}
    rate = 0.3

    def climb(name: str, j, g: np.ndarray) -> None:
        table, square = getattr(model, name), squares[name]
        square[j] += g * g
        table[j] += rate * g / np.sqrt(square[j])

    for _ in range(epochs):
        e = np.empty((len(word), k))
        for j in range(k):
            total = np.bincount(owner, model.two[j][two] + model.three[j][three], minlength=len(word))
            for a in affixes:
                total += model.affix[j][a]
            e[:, j] = total + model.lex[j][index] + model.bias[j]
        marginal, pairs = chains.run(e, model.switch, pairs=True)
        miss = (target - marginal) / len(word) * 1000
        for j in range(k):
            g = miss[:, j]
            per_byte = g[owner]
            for name, code in (("two", two), ("three", three)):
                grad = np.bincount(code, per_byte, minlength=_BINS + 1)
                grad[_BINS] = 0
                climb(name, j, grad)
            grad = sum(np.bincount(a, g, minlength=_BINS + 1) for a in affixes)
            grad[_BINS] = 0
            climb("affix", j, grad)
            climb("lex", j, np.bincount(index, g, minlength=k + 1))
            climb("bias", j, g.sum())
        climb("switch", slice(None), (gold_pairs - pairs) / len(word) * 1000)
    return model


def trained(docs: DataFrame) -> CrfModel:
    """The model of a table's sample; the driver's memory for it is given back."""
    try:
        return fit(training_sample(docs))
    finally:
        C.give_back()


def training_sample(docs: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """(lang, text) of about ``per_language`` texts of each language, in order."""
    train = docs.where(F.col("lang").isNotNull() & (C.crc_mod5(F.col("doc_id")) != 0))
    counts = train.groupBy("lang").count()
    u = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = train.select("doc_id", "lang", "text").where(F.col("text").isNotNull() & (F.length("text") <= LONGEST)).join(as_side(counts, "languages").for_join(), "lang")
    found = rows.where(u * F.col("count") < per_language).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).collect()
    return [(r["lang"], r["text"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["lang"], r["text"]))]


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _predict(batches: Iterator[pa.RecordBatch], model: CrfModel) -> Iterator[pa.RecordBatch]:
    for piece in C.text_slices(batches, limit=SLICE):
        n = piece.num_rows
        pred, score = [UNDETERMINED] * n, np.zeros(n)
        f = Features(piece.column("text"))
        if model.languages and len(f.words):
            counts = f.words.counts
            marginal = Chains(counts).run(model.emissions(f), model.switch)
            doc = f.words.doc()
            lettered = np.bincount(doc, f.lettered, minlength=n)
            weight = (f.lettered | (lettered[doc] == 0)).astype(float)
            mass = np.stack([np.bincount(doc, marginal[:, j] * weight, minlength=n) for j in range(len(model.languages))], axis=1)
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            plain = np.bincount(doc, np.add.reduceat((C.fold(f.words.data) - 97) < 26, f.words.start) > 0, minlength=n) > 0
            for i in np.flatnonzero(total > 0).tolist():
                if plain[i] or _has_letter(piece.column("text")[i].as_py()):
                    pred[i] = model.languages[best[i]]
                    score[i] = min(1.0, mass[i, best[i]] / total[i])
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(pred), pa.array(score)], ["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: CrfModel) -> DataFrame:
    """(doc_id, lang_pred, score) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(C.frugal(lambda b: _predict(b, sent.value)), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: CrfModel) -> DataFrame:
    """``docs`` without the rows whose language is undetermined (null text, or
    text without letters); all columns unchanged. Text in several languages
    stays, however its words are shared among them. A model without languages
    tells nothing, and all rows stay."""
    if not model.languages:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for piece in C.text_slices(batches, limit=SLICE):
            (got,) = _predict(iter([piece]), sent.value)
            yield piece.filter(pa.array([p != UNDETERMINED for p in got.column("lang_pred").to_pylist()], pa.bool_()))

    return docs.mapInArrow(C.frugal(rows), docs.schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents")
    found = predict(docs, trained(docs))
    held = (C.crc_mod5(F.col("doc_id")) == 0).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")
