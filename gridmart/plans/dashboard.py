"""Reporting queries over the star.

Day ranges become constant ``date_id`` bounds, so a stored fact is pruned to the days
asked for while planning. Facts are summed by their integer keys before any dimension
joins: the partial sums are bounded by days x hours x types (or authorities x types),
so the shuffle stays small however many rows or copies a key has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.calendar import day_and_hour
from gridmart.functions.labels import category
from gridmart.plans.star import Star, day_keys
from gridmart.schemas import FLOW_TYPE, GENERATION_TYPE_IDS, MIX_TYPE_CODES


def _between_days(star: Star, first: date, last: date) -> DataFrame:
    return star.fact.filter(F.col("date_id").between(*day_keys(first, last)))


def _sum_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("value")).otherwise(0)).cast("bigint")


def timeseries(star: Star, first: date, last: date) -> DataFrame:
    """Hourly demand, forecast, interchange and net generation.

    Net generation sums type ids 4 to 19. That range holds "all energy sources" next to
    the single sources, so a feed that delivers both is counted twice.
    """
    per_type = (
        _between_days(star, first, last)
        .groupBy("date_id", "time_id", "type_id")
        .agg(F.sum("value").alias("value"))
    )
    return (
        per_type.join(star.dims.date.select("date_id", "full_date"), "date_id")
        .join(star.dims.time_of_day.select("time_id", "hour_24"), "time_id")
        .join(star.dims.type.select("type_id", "type_code"), "type_id")
        .groupBy("full_date", "hour_24")
        .agg(
            _sum_where(F.col("type_code") == "D").alias("demand"),
            _sum_where(F.col("type_code") == "DF").alias("demand_forecast"),
            _sum_where(F.col("type_code") == FLOW_TYPE).alias("total_interchange"),
            _sum_where(F.col("type_id").between(*GENERATION_TYPE_IDS)).alias("net_generation"),
        )
        .select(
            "full_date",
            "hour_24",
            day_and_hour(F.col("full_date"), F.col("hour_24")).alias("timestamp"),
            "demand",
            "demand_forecast",
            "total_interchange",
            "net_generation",
        )
        .orderBy("full_date", "hour_24")
    )


def regional_summary(star: Star, first: date, last: date) -> DataFrame:
    """Totals by region and category, largest first; types without a category are left out."""
    per_authority = (
        _between_days(star, first, last)
        .filter(F.col("type_id") != -1)
        .groupBy("ba_id", "type_id")
        .agg(F.sum("value").alias("value"))
    )
    return (
        per_authority.join(star.dims.ba.select("ba_id", "region_country_name"), "ba_id")
        .join(star.dims.type.select("type_id", "type_code"), "type_id")
        .withColumn("category", category(F.col("type_code"), F.col("type_id")))
        .filter(F.col("category").isNotNull())
        .groupBy("region_country_name", "category")
        .agg(F.sum("value").alias("total_value"))
        .orderBy(F.desc("total_value"))
    )


def category_totals(summary: DataFrame) -> DataFrame:
    """Categories of a regional summary in the order a chart shows them, largest first."""
    return (
        summary.groupBy("category")
        .agg(F.sum("total_value").alias("total_value"))
        .orderBy(F.desc("total_value"))
    )


def generation_mix(star: Star, first: date, last: date) -> DataFrame:
    """Hourly generation by source.

    Shows 10 of the 16 source types, so its total is below ``net_generation``.
    """
    shown = star.dims.type.filter(F.col("type_code").isin(*MIX_TYPE_CODES))
    per_type = (
        _between_days(star, first, last)
        .join(shown.select("type_id", "type_description"), "type_id")
        .groupBy("date_id", "time_id", "type_description")
        .agg(F.sum("value").alias("value"))
    )
    return (
        per_type.join(star.dims.date.select("date_id", "full_date"), "date_id")
        .join(star.dims.time_of_day.select("time_id", "hour_24"), "time_id")
        .groupBy("full_date", "hour_24", F.col("type_description").alias("source"))
        .agg(F.sum("value").alias("value"))
        .withColumn("timestamp", day_and_hour(F.col("full_date"), F.col("hour_24")))
        .orderBy("full_date", "hour_24")
    )
