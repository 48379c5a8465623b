"""Operator 3 - byte-level BPE encoding and decoding.

* Pre-tokenisation without regex. Code points become classes (letter, number,
  other, apostrophe that would start a contraction, last space of a run, ...;
  what a character needs to know of its right neighbours is in its class).
  A class is a transition function of an eight-state automaton. Functions
  compose associatively: the functions that can arise form a small monoid,
  so a prefix scan over all characters of many documents is a table look-up
  per character, block by block, and then across blocks. The state before a
  character and its class say whether a piece starts there.
* Pair merging. Each distinct piece is merged once and cached; what a slice of
  documents misses is merged together: all pieces of similar length as one
  matrix, one lowest-rank (leftmost) merge per piece and round. Pieces over
  ``LONG`` bytes use a heap. A piece that is itself a token is taken whole.
* Decoding looks the bytes of the ids up; each token's byte offset in its
  document is kept (``encoded``).

The vocabulary is read at the driver from a path and broadcast (50 thousand
entries; size fixed by the file). No shuffle: documents stay where the scan
puts them, in slices of bounded size.

Defined results: null text is empty (no tokens); bytes that are no UTF-8 are
first replaced by U+FFFD; special tokens do not exist; null doc_id and
repeated rows are ordinary rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C

VOCABULARY = "byte_bpe_50k.tiktoken"
LONG = 64
CACHE = 100_000  # pieces a worker remembers

# ------------------------------------------------------------ pre-tokenisation

LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, SPACE_LAST, WHITE_LAST, WHITE = range(8)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, JOINS, ONE_LEFT, TWO_LEFT = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The automaton: state after a character, and whether a piece starts at it."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return FRESH, False
    if kind in (LETTER, NUMBER, OTHER):
        own = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
        return own, state not in (own, JOINS)
    if kind in (QUOTE2, QUOTE3):
        if state in (IN_OTHERS, JOINS):
            return IN_OTHERS, False
        return (ONE_LEFT if kind == QUOTE2 else TWO_LEFT), True
    if kind == SPACE_LAST:
        return JOINS, True
    if kind == WHITE_LAST:
        return FRESH, True
    return IN_WHITE, state != IN_WHITE


@lru_cache(maxsize=1)
def automaton():
    """The monoid of transition functions: (id of each class, the same at a
    document's first character, products, images of each function, starts)."""
    step = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    first = [(f[FRESH],) * 8 for f in step]
    names = {tuple(range(8)): 0}
    for f in step + first:
        names.setdefault(f, len(names))
    todo = list(names)
    gens = list(names)
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in names:
                names[h] = len(names)
                todo.append(h)
    images = np.array(list(names), np.uint8)
    code = (images.astype(np.uint64) * (np.uint64(8) ** np.arange(8, dtype=np.uint64))).sum(axis=1)
    order = np.argsort(code)
    then = images[np.arange(len(images))[None, :, None], images[:, None, :]]  # f, then g
    product = order[np.searchsorted(code[order], (then.astype(np.uint64) * (np.uint64(8) ** np.arange(8, dtype=np.uint64))).sum(axis=2))]
    starts = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])
    return np.array([names[f] for f in step]), np.array([names[f] for f in first]), product.astype(np.uint16), images, starts


def scan(ids: np.ndarray, block: int = 256) -> np.ndarray:
    """Inclusive prefix products of monoid elements."""
    _, _, product, _, _ = automaton()
    n = len(ids)
    if n <= block:
        out = ids.astype(np.uint16)
        for i in range(1, n):
            out[i] = product[out[i - 1], out[i]]
        return out
    count = -(-n // block)
    grid = np.zeros((count, block), np.uint16)
    grid.reshape(-1)[:n] = ids
    grid = np.ascontiguousarray(grid.T)
    for i in range(1, block):
        grid[i] = product[grid[i - 1], grid[i]]
    before = np.concatenate((np.zeros(1, np.uint16), scan(grid[-1])[:-1]))
    return product[before[None, :], grid].T.reshape(-1)[:n]


_ASIDE = 0x110000  # code points


@lru_cache(maxsize=1)
def _codepoints() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE of every code point."""
    import regex

    kinds = np.full(_ASIDE, OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, _ASIDE))))
    at = np.concatenate((np.arange(0xD800), np.arange(0xE000, _ASIDE)))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", WHITE)):
        for m in regex.finditer(pattern, every):
            kinds[at[m.start() : m.end()]] = kind
    return kinds


def piece_starts(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters start a piece; ``first``: index of each non-empty
    document's first character."""
    n = len(cps)
    kind = _codepoints()[cps]
    opens = np.zeros(n + 1, bool)
    opens[first] = True
    opens[n] = True
    ends = opens[1:]  # the document ends after this character
    white = kind == WHITE
    next_ink = np.zeros(n, bool)
    next_ink[:-1] = ~white[1:]
    next_ink &= ~ends
    last = white & next_ink
    kind[last] = np.where(cps[last] == 32, SPACE_LAST, WHITE_LAST)
    quote = np.flatnonzero((cps == 39) & ~ends)
    if len(quote):
        one = cps[quote + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        far = np.minimum(quote + 2, n - 1)
        two = np.where(ends[quote + 1], 0, cps[far])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        kind[quote[short]] = QUOTE2
        kind[quote[long]] = QUOTE3
    gen, gen_first, _, images, starts = automaton()
    ids = gen[kind]
    ids[first] = gen_first[kind[first]]
    after = images[scan(ids), FRESH]
    before = np.empty(n, np.uint8)
    before[1:] = after[:-1]
    before[first] = FRESH
    return starts[before, kind]


# ------------------------------------------------------------------- vocabulary


def read_vocabulary(path: str) -> list[bytes]:
    """Token bytes in order of rank (id = rank, no gaps)."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [t for _, t in pairs]


class Codec:
    """Encoder and decoder of one vocabulary, with its piece cache."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.text = [str(i) for i in range(len(tokens))]
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.pairs = {}
        for rank, t in enumerate(tokens):
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    self.pairs[(a << 20) | b] = rank
        self._hash_pairs()
        self.cache: dict[bytes, tuple[tuple, str]] = {}

    def _hash_pairs(self) -> None:
        """Open addressing, so that a whole matrix of pairs is looked up at once."""
        self.bits = max(4, (4 * max(1, len(self.pairs))).bit_length())
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        values = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.slots[slot[left]] < 0
            take, where = left[free], slot[left[free]]
            _, once = np.unique(where, return_index=True)
            self.slots[where[once]], self.values[where[once]] = keys[take[once]], values[take[once]]
            left = left[self.slots[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    NONE = 1 << 40

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, NONE if there is none or a side is -1."""
        out = np.full(a.shape, self.NONE, np.int64)
        left = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        key = (a.ravel()[left] << 20) | b.ravel()[left]
        slot = self._slot(key)
        flat = out.reshape(-1)
        while len(left):
            got = self.slots[slot]
            hit = got == key
            flat[left[hit]] = self.values[slot[hit]]
            go = (got >= 0) & ~hit
            left, key, slot = left[go], key[go], (slot[go] + 1) & (len(self.slots) - 1)
        return out

    def merge(self, pieces: list[bytes]) -> list[tuple]:
        """Token ids of each piece."""
        out: list = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = (whole,)
            elif len(p) > LONG:
                out[i] = tuple(self._merge_long(p))
            else:
                by_width.setdefault(-(-len(p) // 4) * 4, []).append(i)
        for width, members in by_width.items():
            for lo in range(0, len(members), 1 << 14):
                part = members[lo : lo + (1 << 14)]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], width)):
                    out[i] = tuple(ids)
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        size = np.array([len(p) for p in pieces], np.int64)
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        row = np.repeat(np.arange(len(pieces)), size)
        ids[row, C.ranges(np.zeros(len(size), np.int64), size)] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        live, work = np.arange(len(pieces)), ids
        columns = np.arange(width + 1)
        while len(live):
            ranks = self.pair_ranks(work[:, :-1], work[:, 1:])
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            done = best >= self.NONE
            if done.any():
                ids[live[done]] = work[done]
                live, work, at, best = live[~done], work[~done], at[~done], best[~done]
                if not len(live):
                    break
            move = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width)
            work = np.take_along_axis(work, move, axis=1)
            work[:, -1] = -1
            work[np.arange(len(live)), at] = best
            size[live] -= 1
        return [r[:n] for r, n in zip(ids.tolist(), size.tolist())]

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (rank := self.pairs.get((ids[i] << 20) | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [x for x in ids if x >= 0]

    def entries(self, pieces: list[bytes]) -> list[tuple[tuple, str]]:
        """(ids, ids as text) of each piece, through the cache."""
        cache = self.cache
        miss = [p for p in pieces if p not in cache]
        if len(cache) + len(miss) > CACHE:
            cache = self.cache = {p: cache[p] for p in pieces if p in cache}
        for p, ids in zip(miss, self.merge(miss)):
            cache[p] = (ids, " ".join([self.text[i] for i in ids]))
        return [cache[p] for p in pieces]

    def encode(self, column: pa.Array) -> "Encoded":
        return Encoded(self, column)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, end to end."""
        return self.bytes[C.ranges(self.at[ids], self.size[ids])]


class Encoded:
    """A column of texts as tokens: ``ids`` end to end, ``bounds`` of each
    document, ``offsets`` (byte offset of each token in its document)."""

    def __init__(self, codec: Codec, column: pa.Array):
        data, offsets = C.text_bytes(column)
        try:
            text = data.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            fixed = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:])]
            data, offsets = C.text_bytes(pa.array(fixed, pa.binary()))
            text = data.tobytes().decode("utf-8")
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        docs = offsets[:-1][np.diff(offsets) > 0]
        start = at[piece_starts(cps, np.searchsorted(at, docs))] if len(cps) else np.zeros(0, np.int64)
        end = np.append(start[1:], len(data)) if len(start) else start
        h = C.word_hashes(data, start, end, lower=False) if len(start) else np.zeros(0, np.uint64)
        _, one, self.inverse = np.unique(h, return_index=True, return_inverse=True)
        raw = data.tobytes()
        self.entries = codec.entries([raw[a:b] for a, b in zip(start[one].tolist(), end[one].tolist())])
        self.pieces = np.searchsorted(start, offsets)  # bounds of each document, in pieces
        n = np.fromiter((len(e[0]) for e in self.entries), np.int64, len(self.entries))
        flat = np.fromiter(chain.from_iterable(e[0] for e in self.entries), np.int64, int(n.sum()))
        per = n[self.inverse] if len(start) else np.zeros(0, np.int64)
        self.ids = flat[C.ranges((np.cumsum(n) - n)[self.inverse], per)] if len(start) else flat
        self.bounds = np.concatenate(([0], np.cumsum(per)))[self.pieces]
        self.codec = codec

    def offsets(self) -> np.ndarray:
        size = self.codec.size[self.ids]
        at = np.cumsum(size) - size
        counts = np.diff(self.bounds)
        first = np.concatenate((at, [int(size.sum())]))[self.bounds[:-1]]
        return at - np.repeat(first, counts)


def _digests(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    codec = Codec(sent.value)
    for piece in C.text_slices(batches):
        e = codec.encode(piece.column("text"))
        texts = [x[1] for x in e.entries]
        inverse = e.inverse.tolist()
        decoded = codec.decode(e.ids)
        cut = np.concatenate(([0], np.cumsum(codec.size[e.ids])))[e.bounds].tolist()
        decoded = memoryview(decoded)
        ids_sha, text_sha = [], []
        for i, (a, b) in enumerate(zip(e.pieces[:-1].tolist(), e.pieces[1:].tolist())):
            ids_sha.append(hashlib.sha256(" ".join([texts[k] for k in inverse[a:b]]).encode()).hexdigest())
            text_sha.append(hashlib.sha256(decoded[cut[i] : cut[i + 1]]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.diff(e.bounds), pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _token_rows(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    codec = Codec(sent.value)
    for piece in C.text_slices(batches):
        e = codec.encode(piece.column("text"))
        lists = [pa.ListArray.from_arrays(pa.array(e.bounds, pa.int32()), pa.array(x.astype(np.int32))) for x in (e.ids, e.offsets())]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *lists], ["doc_id", "ids", "offsets"])


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, offsets array<int>) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    return _slim(docs).mapInArrow(C.frugal(lambda b: _token_rows(b, sent)), "doc_id long, ids array<int>, offsets array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    sent = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def rows(batches):
        codec = Codec(sent.value)
        for batch in batches:
            texts = [None if x is None else codec.decode(np.array(x, np.int64)).tobytes().decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(C.frugal(rows), "doc_id long, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    return _slim(docs).mapInArrow(C.frugal(lambda b: _digests(b, sent)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(C.read(spark, sf_dir, "documents"), default_path())
