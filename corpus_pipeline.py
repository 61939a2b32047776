"""The corpus pipeline: documents through the stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import byte_pairs, jaccard, language_id, mixing, quality_rules
from gridmart.llm.common import read_documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly by compression."""
    return language_id.confident_documents(docs)


def rule_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and every rule with a threshold in their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.kept_documents(docs, labels)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8: the smallest id."""
    return jaccard.representatives(docs, words_each=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, a row for each copy taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left, by byte-level BPE."""
    return byte_pairs.encode_decode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("quality_rules", rule_out),
    ("ngram_jaccard", deduplicate),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode),
]

# Compression and byte-level merges have no SQL. Tests check the stages one by one, not yet run() against a plain pipeline.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
