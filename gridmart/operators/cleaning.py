"""Raw feed rows to typed rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridmart.functions.parsing import hour_period, whole_number
from gridmart.schemas import Feed


def conform(raw: DataFrame, feed: Feed) -> DataFrame:
    """Snake-case names, ``period`` as timestamp, ``value`` as int; no row dropped."""
    return raw.withColumns(
        {"period": hour_period(F.col("period")), "value": whole_number(F.col("value"))}
    ).withColumnsRenamed(feed.renames)


def lacks_required(feed: Feed) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in feed.required))


def clean(raw: DataFrame, feed: Feed, rejected: Observation | None = None) -> DataFrame:
    """Conformed rows that have every required column.

    Give an ``Observation`` to count the dropped rows in the same pass.
    """
    rows = conform(raw, feed)
    if rejected is not None:
        rows = rows.observe(rejected, F.count_if(lacks_required(feed)).alias("rejected"))
    return rows.na.drop(subset=list(feed.required)).select(
        *(feed.renames.get(c, c) for c in feed.raw_columns)
    )


def readable(raw: DataFrame, feed: Feed) -> DataFrame:
    """The raw rows that ``clean`` keeps, as they came, with their hour in ``_hour``."""
    names = {new: old for old, new in feed.renames.items()}
    typed = {"period": hour_period(F.col("period")), "value": whole_number(F.col("value"))}
    present = (typed.get(c, F.col(f"`{names.get(c, c)}`")).isNotNull() for c in feed.required)
    return raw.filter(reduce(and_, present)).withColumn("_hour", typed["period"])


def rejected_rows(raw: DataFrame, feed: Feed) -> DataFrame:
    """One row: how many rows a feed has and how many of them ``clean`` drops."""
    return conform(raw, feed).agg(
        F.lit(feed.name).alias("feed"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(lacks_required(feed)).alias("rejected_rows"),
    )
