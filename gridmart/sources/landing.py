"""Daily landing zone: ``root/<route>/day=<run day>/*.parquet``, all columns text."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.parsing import as_text
from gridmart.schemas import Feed


def parse_day(text: str) -> date:
    """``YYYY/MM/DD``, the form a run takes its day in."""
    return datetime.strptime(text, "%Y/%m/%d").date()


def lookback_window(feed: Feed, run_day: date) -> tuple[date, date]:
    """First and last observation day one run fetches."""
    return run_day - timedelta(days=feed.lookback_days), run_day


def _observation_day() -> Column:
    return F.expr("try_cast(substring(period, 1, 10) AS date)")


def within_window(records: DataFrame, feed: Feed, run_day: date) -> DataFrame:
    """Records of a run's window; those without a readable day stay, to be counted when staged."""
    day = _observation_day()
    return records.filter(day.isNull() | day.between(*lookback_window(feed, run_day)))


def by_run_day(records: DataFrame, feed: Feed, first: date, last: date) -> DataFrame:
    """Records once for every run in ``first..last`` whose window covers them.

    This is a whole backfill as one narrow step; records overlap between runs exactly as
    separate daily runs would make them. Records without a readable day go once, with the
    first run, so that staging can count them.
    """
    offsets = F.sequence(F.lit(0), F.lit(feed.lookback_days))
    covering = F.transform(offsets, lambda n: F.date_add(_observation_day(), n))
    run_days = F.when(_observation_day().isNull(), F.array(F.lit(first))).otherwise(covering)
    return records.withColumn("day", F.explode(run_days)).filter(F.col("day").between(first, last))


def land(records: DataFrame, root: str, feed: Feed) -> None:
    """Write records that carry their run day in ``day``.

    Only days present are replaced: a repeated run overwrites its own day, and an empty
    batch changes nothing. AQE sizes the files, splitting a day that is too large.
    """
    _write_days(records, f"{root}/{feed.route}", feed)


def land_runs(records: DataFrame, root: str, feed: Feed, first: date, last: date) -> None:
    """Write records for every run in ``first..last`` whose window covers them, as ``land`` writes ``by_run_day``.

    Each record is shuffled once, by its observation day, and multiplied by the task that writes it.
    """
    near = records.withColumn("_observed", _observation_day()).hint("rebalance", "_observed")
    _save_days(by_run_day(near, feed, first, last), f"{root}/{feed.route}", feed)


def _write_days(records: DataFrame, folder: str, feed: Feed) -> None:
    _save_days(records.select(*feed.raw_columns, "day").hint("rebalance", "day"), folder, feed)


def _save_days(records: DataFrame, folder: str, feed: Feed) -> None:
    (
        records.select(*feed.raw_columns, "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(folder)
    )


def land_day(records: DataFrame, root: str, feed: Feed, run_day: date) -> None:
    land(records.withColumn("day", F.lit(run_day)), root, feed)


def _observed_root(root: str, feed: Feed) -> str:
    return f"{root}/observed/{feed.route}"


def land_observed(records: DataFrame, root: str, feed: Feed, first: date, last: date) -> None:
    """Write a backfill of the runs ``first..last`` by observation day, every record once.

    Daily runs of a feed with a lookback land a record again and again; here it lies under
    its own day, apart from what daily runs landed, and ``read_runs`` derives the runs from it. Records
    without a readable day lie under ``first``. Days present are replaced whole, so that a
    repeated backfill changes nothing.
    """
    day = _observation_day()
    fetched = day.isNull() | day.between(first - timedelta(days=feed.lookback_days), last)
    rows = records.filter(fetched).withColumn("day", F.coalesce(day, F.lit(first)))
    _write_days(rows, _observed_root(root, feed), feed)


def read_observed(
    spark: SparkSession, root: str, feed: Feed, first: date | None = None, last: date | None = None
) -> DataFrame:
    """A backfill's records, each once, with their observation day; what staging wants."""
    return _read_days(spark, _observed_root(root, feed), feed, first, last)


def read_runs(spark: SparkSession, root: str, feed: Feed, first: date, last: date) -> DataFrame:
    """A backfill's records as the runs ``first..last`` fetched them, a row for every run, in ``day``.

    Reads the days that these runs cover and no others; nothing is shuffled. Records without
    a readable day belong to the first run of the backfill that landed them.
    """
    rows = read_observed(spark, root, feed, first - timedelta(days=feed.lookback_days), last)
    ahead = F.when(_observation_day().isNull(), 0).otherwise(feed.lookback_days)
    runs = F.sequence(F.col("day"), F.date_add("day", ahead))
    return rows.withColumn("day", F.explode(runs)).filter(F.col("day").between(first, last))


def landed_schema(feed: Feed) -> T.StructType:
    return T.StructType([*feed.raw_schema.fields, T.StructField("day", T.DateType())])


def read_landed(
    spark: SparkSession, root: str, feed: Feed, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Landed rows with their run day; bounds prune the day folders."""
    return _read_days(spark, f"{root}/{feed.route}", feed, first, last)


def _read_days(
    spark: SparkSession, folder: str, feed: Feed, first: date | None, last: date | None
) -> DataFrame:
    rows = spark.read.schema(landed_schema(feed)).parquet(folder)
    if first is not None:
        rows = rows.filter(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("day") <= F.lit(last))
    return rows


def scan_day(spark: SparkSession, root: str, feed: Feed, run_day: str) -> DataFrame:
    """Raw rows of one run, given its day as ``YYYY/MM/DD``."""
    day = parse_day(run_day)
    return read_landed(spark, root, feed, day, day).drop("day")


def read_foreign(spark: SparkSession, paths: Iterable[str], feed: Feed) -> DataFrame:
    """Daily Parquet written elsewhere, where a column's type can differ by day.

    Paths of one schema are read by one scan and cast to text before the union, so the plan
    grows with the number of different schemas, not of days.
    """
    by_schema: dict[str, list[str]] = {}
    for path in paths:
        by_schema.setdefault(spark.read.parquet(path).schema.json(), []).append(path)

    def one(alike: list[str]) -> DataFrame:
        rows = spark.read.parquet(*alike)
        return rows.select(
            *(
                as_text(rows[f"`{f.name}`"], f.dataType).alias(f.name)
                for f in rows.schema.fields
                if f.name in feed.raw_columns
            )
        )

    empty = spark.createDataFrame([], feed.raw_schema)
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, by_schema.values()), empty
    )
