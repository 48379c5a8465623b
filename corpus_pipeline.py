"""From raw documents to token digests, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; all but the last return the columns of ``documents``. ``run`` writes
each result as Parquet into the shared folder and reads it again for the
next stage.

* language_id: documents without a determined language go, that is with null
  text or without letters; text in several languages stays. If no row is
  labelled with a language, all rows stay.
* ngram_join: of each group of linked documents the one with the smallest
  doc_id stays; so does one of rows that repeat a doc_id.
* substring_dedup: words in passages of 50 or more that a smaller doc_id has
  too are cut out; ``n_chars`` follows the text.
* mixing: rows are repeated or left out so that sources meet their targets.
* byte_bpe: doc_id, n_tokens, ids_sha256, decoded_sha256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import byte_bpe, language_id, mixing, ngram_join, substring_dedup
from surgecast.session import work_path

#: SQL cannot express the trained first stage; tests compare with brute force.
ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.trained(docs))


def drop_linked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_duplicates(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(docs, byte_bpe.default_path())


STAGES = [
    ("language_id", identify),
    ("ngram_join", drop_linked),
    ("substring_dedup", cut_passages),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = work_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
