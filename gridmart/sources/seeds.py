"""Seed CSV files with a header line; empty cells are null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.schemas import AUTHORITY_SEED_COLUMNS, TYPE_SEED_COLUMNS


def _read_seed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Columns are found by the names in the header, in whatever order it has them."""
    rows = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    lacking = [c for c in columns if c not in rows.columns]
    if lacking:
        raise ValueError(f"the seed {path} has no column {', '.join(lacking)}")
    return rows.select(*(F.col(f"`{c}`") for c in columns))


def read_authority_seed(spark: SparkSession, path: str) -> DataFrame:
    return _read_seed(spark, path, AUTHORITY_SEED_COLUMNS)


def read_type_seed(spark: SparkSession, path: str) -> DataFrame:
    return _read_seed(spark, path, TYPE_SEED_COLUMNS)


def write_seed(seed: DataFrame, path: str) -> None:
    seed.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
