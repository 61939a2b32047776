"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import alignment, byte_pairs, collocations, jaccard, language_id, licenses, mixing, nearest, quality_rules, records, sharding, token_counts, weak_labels
from gridmart.llm.common import read_documents
from gridmart.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_by_bytes(read_documents(spark, sf_dir))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(read_documents(spark, sf_dir), words_each=3, percent=90)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(read_documents(spark, sf_dir))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(spark, read_documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ruled = quality_rules.apply_rules(read_documents(spark, sf_dir), labels)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return ruled.select("doc_id", *counts, "base_failed", "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(embeddings, F.col("vec_id") % 20 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir)).drop("row_key")


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.encode_decode(read_documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_documents(spark, sf_dir))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.find_licenses(read_documents(spark, sf_dir)))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_token_records": op5_token_records,
    "op6_quality_rules": op6_quality_rules,
    "op8_nearest": op8_nearest,
    "op9_mixing": op9_mixing,
    "op7_byte_level_bpe": op7_byte_level_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_license_scan": op11_license_scan,
    "op12_collocations": op12_collocations,
    "op13_token_alignment": op13_token_alignment,
}
