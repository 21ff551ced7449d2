"""A training corpus from ``documents``: quality, exact copies, near copies, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxledger.llm import bpe, decontamination, exact_dedup, jaccard_join, quality
from voxledger.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return bpe.token_digests(docs, path("byte_bpe_50k.json"))


STAGES = [("quality", good_quality), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
          ("decontamination", without_benchmark), ("tokens", tokenised)]

#: Fitted scores and token merges have no SQL; tests/llm holds the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
