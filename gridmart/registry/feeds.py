"""Raw feeds, seeds and a warehouse derived from the given tables."""

from __future__ import annotations

import functools
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.plans.dimensions import type_seed
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import FEEDS, FUEL_TYPE, INTERCHANGE, PAGE_ROWS, REGION, Feed
from gridmart.session import new_table_path

# Nations that stand for aggregate codes, so the filter on those has work.
AGGREGATE_NATIONS = {20: "CAL", 21: "CAR", 22: "CENT", 23: "FLA", 24: "US48"}

# Source type by order key; ZZZ is in no dimension.
FUEL_CODES = (
    "SYS",
    "BAT",
    "WNB",
    "SNB",
    "PS",
    "OES",
    "UES",
    "WND",
    "SUN",
    "WAT",
    "GEO",
    "OTH",
    "OIL",
    "NG",
    "COL",
    "NUC",
    "ZZZ",
)

# Region series by event type.
EVENT_SERIES = {"view": "D", "error": "D", "click": "DF", "signup": "NG", "purchase": "TI"}

UNITS = "megawatthours"
FIRST_DAY = "2024-01-01"
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")
FILE_ROWS = 1_000_000  # of the raw feeds, so that a task reads few
HOURS = 720  # both order keys are spread over 30 days


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _codes(spark: SparkSession, sf_dir: str, key: str, code: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    name = F.col("n_name")
    for nation_key, aggregate in AGGREGATE_NATIONS.items():
        name = F.when(F.col("n_nationkey") == nation_key, aggregate).otherwise(name)
    return nation.select(F.col("n_nationkey").alias(key), name.alias(code))


def _raw(feed: Feed, period: Column, code: Column, series: Column, value: Column) -> list[Column]:
    return [
        period.alias("period"),
        code.alias(feed.code),
        F.concat(F.lit("Authority "), code).alias(feed.code_label),
        series.alias(feed.series),
        F.concat(F.lit("Series "), series).alias(feed.series_label),
        value.cast("bigint").cast("string").alias("value"),
        F.lit(UNITS).alias("value-units"),
    ]


def _period(day: Column, hour: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("T"), F.lpad(hour.cast("string"), 2, "0"))


def _spread_hour(key: Column) -> Column:
    hour = (key % HOURS).cast("int")
    return _period(F.date_add(F.lit(FIRST_DAY).cast("date"), (hour / 24).cast("int")), hour % 24)


def _events_with_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = F.lit(None).cast("string")
    for event_type, code in EVENT_SERIES.items():
        series = F.when(F.col("event_type") == event_type, code).otherwise(series)
    value = F.when(F.col("event_type") != "error", F.floor(F.col("value") * 100))
    return (
        table(spark, sf_dir, "events")
        .withColumn("_nation", F.col("user_id") % 25)
        .join(_codes(spark, sf_dir, "_nation", "_code"), "_nation")
        .select(
            "event_id",
            "event_type",
            *_raw(REGION, _period(F.to_date("ts"), F.hour("ts")), F.col("_code"), series, value),
        )
    )


def raw_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_with_record(spark, sf_dir).select(*REGION.raw_columns)


def _orders_with_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    series = F.element_at(
        F.array(*(F.lit(c) for c in FUEL_CODES)),
        (F.col("o_orderkey") % len(FUEL_CODES) + 1).cast("int"),
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_codes(spark, sf_dir, "c_nationkey", "_code"), "c_nationkey")
        .select(
            "o_orderkey",
            *_raw(
                FUEL_TYPE,
                _spread_hour(F.col("o_orderkey")),
                F.col("_code"),
                series,
                F.floor("o_totalprice"),
            ),
        )
    )


def raw_fuel_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_record(spark, sf_dir).select(*FUEL_TYPE.raw_columns)


def raw_interchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_codes(spark, sf_dir, "s_nationkey", "_from"), "s_nationkey")
        .join(_codes(spark, sf_dir, "c_nationkey", "_to"), "c_nationkey")
    )
    period = _spread_hour(F.col("l_orderkey"))
    # Here the second key column is an authority too, so its label is one.
    return rows.select(
        *_raw(INTERCHANGE, period, F.col("_from"), F.col("_to"), signed)
    ).withColumn("toba-name", F.concat(F.lit("Authority "), F.col("toba")))


_DERIVED = {"region": raw_region, "fuel_type": raw_fuel_type, "interchange": raw_interchange}


def authority_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations below 20 as authorities, plus the Unknown member without coordinates."""
    region = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    known = (
        table(spark, sf_dir, "nation")
        .filter(key < min(AGGREGATE_NATIONS))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (key + 1).cast("string").alias("BA Id"),
            F.col("n_name").alias("BA Code"),
            F.col("n_name").alias("BA Name"),
            F.lit("Central").alias("Time Zone"),
            F.upper(F.substring("r_name", 1, 4)).alias("Region_Country Code"),
            F.col("r_name").alias("Region_Country Name"),
            F.lit("No").alias("Generation Only BA"),
            F.lit("No").alias("Demand by BA Subregion"),
            F.lit("Yes").alias("US_BA"),
            F.when(key % 7 == 0, "No").otherwise("Yes").alias("Active BA"),
            F.lit("1900-01-01").alias("Activation Date"),
            F.lit("9999-12-31").alias("Retirement Date"),
            (key + 25).cast("string").alias("LATITUDE"),
            (key * 2 - 120).cast("string").alias("LONGITUDE"),
        )
    )
    unknown = spark.range(0, 1, 1, 1).select(
        F.lit("-1").alias("BA Id"),
        *(F.lit("Unknown").alias(c) for c in known.columns[1:10]),
        F.lit("1900-01-01").alias("Activation Date"),
        F.lit("9999-12-31").alias("Retirement Date"),
        F.lit(None).cast("string").alias("LATITUDE"),
        F.lit(None).cast("string").alias("LONGITUDE"),
    )
    return known.unionByName(unknown)


def _state(sf_dir: str, spark: SparkSession) -> tuple:
    """What the given tables are made of now: a table that is rewritten is derived from anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = []
    for name in TABLES:
        root = path(f"{sf_dir}/{name}.parquet")
        listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
        files += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in listed]
    return tuple(files)


@functools.cache
def _raw_root(spark: SparkSession, application: str, sf_dir: str, state: tuple) -> str:
    root = new_table_path(spark, "raw")
    for name, derive in _DERIVED.items():
        derive(spark, sf_dir).write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{root}/{name}")
    return root


@functools.cache
def _observation_days(spark: SparkSession, root: str) -> tuple[date, date]:
    bounds = [
        spark.read.schema(feed.raw_schema)
        .parquet(f"{root}/{name}")
        .agg(F.min(F.substring("period", 1, 10)), F.max(F.substring("period", 1, 10)))
        .first()
        for name, feed in FEEDS.items()
    ]
    days = [date.fromisoformat(day) for row in bounds for day in row if day]
    return min(days), max(days)


def observation_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last day of the raw feeds."""
    return _observation_days(spark, _raw_root(spark, spark.sparkContext.applicationId, sf_dir, _state(sf_dir, spark)))


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw feeds, derived from the whole tables once per application and stored."""
    root = _raw_root(spark, spark.sparkContext.applicationId, sf_dir, _state(sf_dir, spark))
    return {
        name: spark.read.schema(feed.raw_schema).parquet(f"{root}/{name}")
        for name, feed in FEEDS.items()
    }


@functools.cache
def _warehouse(spark: SparkSession, application: str, sf_dir: str, state: tuple) -> Warehouse:
    house = Warehouse(spark, new_table_path(spark, "warehouse"))
    for name, raw in raw_feeds(spark, sf_dir).items():
        house.append(raw, FEEDS[name])
    house.load_seeds(authority_seed(spark, sf_dir), type_seed(spark))
    house.build_fact()
    return house


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Staged feeds, dimensions and fact, built from the raw feeds once per application."""
    return _warehouse(spark, spark.sparkContext.applicationId, sf_dir, _state(sf_dir, spark))


def _pages(records: DataFrame, feed: Feed, page_key: list[str]) -> DataFrame:
    """Pages of at most PAGE_ROWS records: ``page_key`` holds a block of unique row keys, and is their request."""
    records = records.withColumn("day", F.substring("period", 1, 10).cast("date"))
    totals = records.groupBy("day").agg(F.count(F.lit(1)).cast("string").alias("total"))
    data = records.groupBy("day", *page_key).agg(
        F.collect_list(F.struct(*feed.raw_columns)).alias("data")
    )
    return data.join(totals, "day").select(
        *page_key, "day", F.to_json(F.struct(*page_key)).alias("request"), F.struct("total", "data").alias("response")
    )


def region_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by event type; ``event_type`` is left in so that a caller can lose some."""
    records = _events_with_record(spark, sf_dir).withColumn(
        "_block", F.expr(f"event_id div {PAGE_ROWS}")
    )
    return _pages(records, REGION, ["event_type", "_block"]).drop("_block")


def fuel_type_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _orders_with_record(spark, sf_dir).withColumn(
        "_block", F.expr(f"o_orderkey div {PAGE_ROWS}")
    )
    return _pages(records, FUEL_TYPE, ["_block"]).drop("_block")


def write_pages(pages: DataFrame, root: str, feed: Feed) -> None:
    pages.select("day", "request", "response").write.mode("overwrite").partitionBy("day").json(
        f"{root}/{feed.route}"
    )
