"""Date and hour attributes of the two generated dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.functions.keys import date_key

FISCAL_SHIFT_MONTHS = 3  # the fiscal year starts in October


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_quarter(day: Column) -> Column:
    return F.date_format(day, "yyyy'Q'Q")


def date_attributes(day: Column) -> list[Column]:
    fiscal = F.add_months(day, FISCAL_SHIFT_MONTHS)
    return [
        date_key(day).alias("date_id"),
        day.alias("full_date"),
        F.date_format(day, "yyyy/MM/dd").alias("date_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday").alias("weekday_weekend"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.month(day).alias("month_of_year"),
        F.when(day == F.last_day(day), "Y").otherwise("N").alias("is_last_day_of_month"),
        F.quarter(day).alias("calendar_quarter"),
        F.year(day).alias("calendar_year"),
        year_month(day).alias("calendar_year_month"),
        year_quarter(day).alias("calendar_year_quarter"),
        F.month(fiscal).alias("fiscal_month_of_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
        F.year(fiscal).alias("fiscal_year"),
        year_month(fiscal).alias("fiscal_year_month"),
        year_quarter(fiscal).alias("fiscal_year_quarter"),
    ]


def hour_attributes(hour: Column) -> list[Column]:
    """``time_actual`` is text (HH:mm:ss): Parquet readers differ on a TIME type."""
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    am_pm = F.when(hour < 12, "AM").otherwise("PM")
    day_part = (
        F.when(hour.between(5, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 20), "Evening")
        .otherwise("Night")
    )
    return [
        hour.alias("time_id"),
        F.format_string("%02d:00:00", hour).alias("time_actual"),
        F.format_string("%02d:00", hour).alias("time_name_24"),
        F.format_string("%02d %s", twelve, am_pm).alias("time_name_12"),
        hour.alias("hour_24"),
        twelve.cast("int").alias("hour_12"),
        am_pm.alias("am_pm"),
        day_part.alias("day_part"),
        F.when(hour.between(7, 22), "Peak").otherwise("Off-Peak").alias("peak_period"),
    ]


def day_and_hour(day: Column, hour: Column) -> Column:
    """A date and an hour as one timestamp without time zone."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, F.lit(0), F.lit(0))
