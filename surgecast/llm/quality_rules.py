"""Operator 7 - quality rules by distribution divergence (DataFrame functions only).

Every document is compared with the reference of its own language (rows
without one: with the reference of all documents) in two histograms: the
classes of its characters, and its common words. The references are the sums
over all documents of the language. Both distances are Jensen-Shannon
distances (base 2, 0 to 1). Short histograms are noise: the character rule
needs ``MIN_CHARS`` characters, the word rule ``MIN_WORDS`` words; below that
a rule passes.

The base rules (contract of the query): fewer than 50 words, or over half of
the words in repeated 3-word windows, fail.

Nothing is exploded to rows: words, windows and lines of a document are
arrays within its row, and each step is linear or a sort in them. A
document's measures are written once (checkpoint); the references are one
grouped sum over them and come back as one row a language.

Defined results: null or blank text has no words and fails the base rule;
null doc_id and repeated rows are ordinary rows; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import common as C
from surgecast.llm.mixing import words_of

MIN_WORDS_BASE = 50
REPEAT_PERCENT = 50
MIN_CHARS = 200
MIN_WORDS = 100
MOST_CHAR_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.75
MOST_LANGUAGES_BROADCAST = 10_000

# Character classes by code point, the last one is the rest (mostly letters
# beyond ASCII); whitespace is left out.
CHAR_CLASSES = {
    "lower": "a-z",
    "upper": "A-Z",
    "digit": "0-9",
    "stop": ".,;:!?'\"()\\-",
    "symbol": "#*$%&|<>",
}

# Common words of the languages at hand; the references give their shares.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was with as be at by this are from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words within 3-word windows that occur twice or more, the first one
    included: sort the windows' hashes with their places, keep those with an
    equal neighbour, put their places in order, and add up what each covers."""
    some = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    windows = F.array_sort(F.transform(some, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))))
    twice = let(windows, lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True)))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    steps = let(places, lambda p: F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(C.WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _count(letters: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(letters, f"[^{chars}]+", "")).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of each document (``chars``: by class,
    ``common``: by word of WORDS)."""
    base = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("words", words_of(F.col("text"))).withColumn("letters", F.array_join("words", ""))
    known = [_count(F.col("letters"), c) for c in CHAR_CLASSES.values()]
    rest = F.length("letters").cast("long")
    for c in known:
        rest = rest - c
    hits = F.filter(F.transform(F.filter("words", lambda w: F.length(w) <= 8), lambda w: F.lower(F.regexp_replace(w, "[.,;:!?]+$", ""))), lambda w: w.isin(WORDS))
    common = let(hits, lambda h: F.transform(F.array(*[F.lit(w) for w in WORDS]), lambda w: F.size(F.filter(h, lambda x: x == w)).cast("long")))
    return base.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length("letters").cast("long").alias("word_chars"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array(*known, rest).alias("chars"),
        common.alias("common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence of two share arrays."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def references(measured: DataFrame) -> DataFrame:
    """(lang, ref_chars, ref_common): summed counts of each language; null
    lang holds the sums of all documents."""
    sums = [F.sum(F.col(c)[i]).cast("double") for c, n in (("chars", len(CHAR_CLASSES) + 1), ("common", len(WORDS))) for i in range(n)]
    k = len(CHAR_CLASSES) + 1
    named = lambda: [F.array(*sums[:k]).alias("ref_chars"), F.array(*sums[k:]).alias("ref_common")]
    some = measured.where("lang is not null").groupBy("lang").agg(*named())
    return some.unionByName(measured.agg(F.lit(None).cast("string").alias("lang"), *named()))


def judge(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts, base_failed, char_distance, word_distance, kept."""
    m = C.cut(measures(docs))
    refs = C.cut(references(m))
    small = refs.count() <= MOST_LANGUAGES_BROADCAST
    refs = refs.withColumnRenamed("lang", "ref_lang")
    rows = m.join(F.broadcast(refs) if small else refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    of = lambda a, b: js_distance(_shares(F.col(a)), _shares(F.col(b)))
    rows = rows.withColumn("char_distance", F.when(F.col("word_chars") >= MIN_CHARS, of("chars", "ref_chars")))
    hits = F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    none = F.aggregate("ref_common", F.lit(0.0), lambda a, x: a + x) == 0
    word = F.when(none, 0.0).when(hits == 0, 1.0).otherwise(of("common", "ref_common"))
    rows = rows.withColumn("word_distance", F.when(F.col("n_words") >= MIN_WORDS, word))
    failed = (F.col("n_words") < MIN_WORDS_BASE) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= MOST_CHAR_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_DISTANCE)
    symbols = F.element_at("chars", list(CHAR_CLASSES).index("symbol") + 1)
    return rows.select(
        "doc_id", "n_words", "word_chars", symbols.alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & near).alias("kept"), "char_distance", "word_distance",
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.read(spark, sf_dir, "documents"))
