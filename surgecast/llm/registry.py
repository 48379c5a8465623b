"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from surgecast.llm import byte_bpe, chat_format, divergence, html_extract, language_id, lm_score, merkle, mixing, ngram_join, quality_rules, substring_dedup, topk_search, toxicity

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_language_id": language_id.op2_language_id,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_source_mixing": mixing.op6_source_mixing,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_lm_score": lm_score.op8_lm_score,
    "op9_exact_top_k": topk_search.op9_exact_top_k,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_html_extract": html_extract.op13_html_extract,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op5_chat_format": chat_format.ORACLE,
    "op9_exact_top_k": topk_search.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
