"""The fact and the star it belongs to."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.keys import date_key
from gridmart.schemas import CALENDAR_END, CALENDAR_START, FACT_COLUMNS, FACT_SCHEMA
from gridmart.sources.tables import Table


@dataclass(frozen=True)
class Dimensions:
    ba: DataFrame
    type: DataFrame
    date: DataFrame
    time_of_day: DataFrame


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dims: Dimensions

    def register_views(self) -> None:
        """Temp views under the table names the reporting SQL uses."""
        self.fact.createOrReplaceTempView("fct_grid_operation")
        self.dims.ba.createOrReplaceTempView("dim_ba")
        self.dims.type.createOrReplaceTempView("dim_type")
        self.dims.date.createOrReplaceTempView("dim_date")
        self.dims.time_of_day.createOrReplaceTempView("dim_time_of_day")


def grid_fact(unified: DataFrame, dims: Dimensions) -> DataFrame:
    """Unified rows with their dimension keys; a code no dimension knows gives a null key.

    Every lookup is a left join to a dimension, so no row is lost. No broadcast is
    forced: Catalyst broadcasts a dimension when its size is under the session's limit
    and falls back to a sort-merge join, which AQE can split on hot keys, beyond it.
    """
    rows = unified.withColumns({"_day": date_key(F.col("period")), "_hour": F.hour("period")})
    own = dims.ba.select(F.col("ba_code").alias("_own"), "ba_id")
    related = dims.ba.select(F.col("ba_code").alias("_related"), F.col("ba_id").alias("related_ba_id"))
    kinds = dims.type.select(F.col("type_code").alias("_kind"), "type_id")
    days = dims.date.select("date_id")
    hours = dims.time_of_day.select("time_id")
    return (
        rows.join(own, F.col("ba_code") == F.col("_own"), "left")
        .join(kinds, F.col("type_code") == F.col("_kind"), "left")
        .join(related, F.col("related_ba") == F.col("_related"), "left")
        .join(days, F.col("_day") == F.col("date_id"), "left")
        .join(hours, F.col("_hour") == F.col("time_id"), "left")
        .withColumn("value", F.col("value").cast("bigint"))
        .select(*FACT_COLUMNS)
    )


def _laid_out(fact: DataFrame) -> DataFrame:
    """Rows of a day together and in hour order.

    AQE splits days that are too large and merges small ones. The writer sorts by the
    day anyway; adding the hour lets a query for one hour skip row groups.
    """
    return fact.hint("rebalance", "date_id").sortWithinPartitions("date_id", "time_id")


def fact_table(target: str) -> Table:
    """All reporting queries filter on the day key, so that is the partition column."""
    return Table(target, FACT_SCHEMA, "date_id")


def write_fact(fact: DataFrame, table: Table) -> None:
    """Rebuild the stored fact."""
    table.replace(_laid_out(fact))


def refresh_fact(fact: DataFrame, table: Table, first: date, last: date) -> None:
    """Replace the stored days ``first..last`` and leave all others alone."""
    if first < date.fromisoformat(CALENDAR_START) or last > date.fromisoformat(CALENDAR_END):
        # Days off the calendar share one null partition, which a few days must not replace.
        raise ValueError(f"days must lie within {CALENDAR_START}..{CALENDAR_END}")
    days = fact.filter(F.col("date_id").between(*day_keys(first, last)))
    table.replace_partitions(_laid_out(days))


def in_calendar(day: date) -> bool:
    return date.fromisoformat(CALENDAR_START) <= day <= date.fromisoformat(CALENDAR_END)


def replace_days(fact: DataFrame, table: Table) -> None:
    """Replace the stored days that the rows belong to; days off the calendar are one of them."""
    table.replace_partitions(_laid_out(fact))


def day_keys(first: date, last: date) -> tuple[int, int]:
    """Day keys of a date range, as constants Catalyst can prune partitions with."""
    return int(first.strftime("%Y%m%d")), int(last.strftime("%Y%m%d"))
