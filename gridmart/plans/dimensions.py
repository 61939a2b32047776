"""The four dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.calendar import date_attributes, hour_attributes
from gridmart.schemas import (
    AUTHORITY_SEED_COLUMNS,
    CALENDAR_END,
    CALENDAR_START,
    DIM_BA_SCHEMA,
    DIM_TYPE_SCHEMA,
    TYPE_SEED_COLUMNS,
    TYPES,
)


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    days = spark.range(0, 1, 1, 1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
        ).alias("day")
    )
    return days.select(*date_attributes(F.col("day")))


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    return spark.range(0, 24, 1, 1).select(*hour_attributes(F.col("id").cast("int")))


def type_seed(spark: SparkSession) -> DataFrame:
    """The built-in types in the shape of their seed file."""
    rows = F.array(
        *(
            F.struct(*(F.lit(str(v)).alias(c) for v, c in zip(row, TYPE_SEED_COLUMNS, strict=True)))
            for row in TYPES
        )
    )
    return spark.range(0, 1, 1, 1).select(F.inline(rows))


def _typed(seed: DataFrame, columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """Seed columns, in order, under the dimension's names and types."""
    return seed.select(
        *(
            F.col(column).cast(field.dataType).alias(field.name)
            for column, field in zip(columns, schema.fields, strict=True)
        )
    )


def dim_type(seed: DataFrame) -> DataFrame:
    return _typed(seed, TYPE_SEED_COLUMNS, DIM_TYPE_SCHEMA)


def dim_ba(seed: DataFrame) -> DataFrame:
    return _typed(seed, AUTHORITY_SEED_COLUMNS, DIM_BA_SCHEMA)
