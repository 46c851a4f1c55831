"""Registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    byte_bpe, centroids, chat_format, conversation_repair, fingerprints, language_id, lm_scoring, mixing, near_dedup, pii,
    quality_rules, token_counts, toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_language_id": language_id.op6_language_id,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_lm_scoring": lm_scoring.op8_lm_scoring,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_pii": pii.op10_pii,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_centroids": centroids.op12_centroids,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op2_chat_format": chat_format.OP2_SQL,
    "op12_centroids": centroids.OP12_SQL,
}
