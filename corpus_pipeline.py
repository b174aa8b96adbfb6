"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deslinde.llm import decontam, langid, neardup, packing, secrets
from deslinde.llm.common import ready, saved, table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no text, no letter, or no language likely enough."""
    ready(spark)
    return langid.accepted(docs, langid.train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies: five-word shingles, similarity of 0.8."""
    ready(spark)
    return neardup.keep_one(docs, words=5, percent=80)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a test item."""
    return decontam.clean(docs, table(ready(spark), sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret, encoded ones as well."""
    ready(spark)
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack what is left into sequences of at most 2048 tokens."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("language id", languages), ("near copies", near_copies), ("benchmark leaks", leaks), ("secrets", masked), ("packing", packed),
]
# Language models, signatures, tiles, decoded layers and tokenizers are not SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again as the next one's documents."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
