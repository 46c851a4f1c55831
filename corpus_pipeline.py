"""Raw documents to token ids: language, near-duplicates, personal data, source mix, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor, and is written as Parquet and
read again before the next one. All stages but the last return the columns of documents. They are not expressible
in SQL, so there is no ORACLE_SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import byte_bpe, language_id, mixing, near_dedup, pii
from basketry.llm.common import crc_mod, stage_table, table

#: Documents whose language is less sure than this go, as do those without a letter.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; learned from the part that is not held out."""
    return language_id.accepted(docs, *language_id.fit(docs, crc_mod("doc_id", 3) != 1), least=LEAST_SCORE)


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.without_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256): token ids per document, and the digest of the text that they decode to."""
    ranks, pattern = byte_bpe.vocabulary()
    read = byte_bpe.round_trip(docs, ranks, pattern)
    return read.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("deduplication", deduplication), ("personal_data", personal_data), ("source_mix", source_mix), ("encoding", encoding),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir))
    return docs
