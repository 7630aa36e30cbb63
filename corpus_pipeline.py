"""The corpus pipeline: quality rules, exact and near deduplication, mixing, tokens; each stage is written and read again.

Stages take (spark, docs, sf_dir) and return a DataFrame. All but the last return the columns of documents. Nulls, empty
texts, repeated rows and further columns are handled as the operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm import exactdup, mixing, neardup, quality, unigram
from stratiform.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy web-3 rejects go; none goes for its length, be it short or long."""
    return quality.kept_documents(docs, "web-3")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exactdup.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    return neardup.distinct_documents(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids, n_tokens of each document."""
    return unigram.encoded(docs, keep=tuple(c for c in ("doc_id", "source", "lang") if c in docs.columns))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
