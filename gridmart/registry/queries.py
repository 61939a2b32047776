"""Registered queries, each ``(spark, sf_dir) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators.cleaning import clean, rejected_rows
from gridmart.operators.dedup import unseen, with_content_id
from gridmart.operators.unify import single_authority
from gridmart.plans import dashboard, dimensions, grid_map, quality
from gridmart.plans.star import Star, fact_table, write_fact
from gridmart.plans.warehouse import Warehouse
from gridmart.registry import feeds as source
from gridmart.schemas import FEEDS, FUEL_TYPE, INTERCHANGE, REGION, Feed
from gridmart.session import apply_settings, new_table_path
from gridmart.sources import landing, pages, seeds, staging
from gridmart.sources.staging import stage
from gridmart.sources.tables import Table
from gridmart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# A day in the middle to split appends at, and the one the map shows.
SPLIT_DAY = date(2024, 1, 16)
MAP_DAY, MAP_HOUR = date(2024, 1, 15), 8

REGISTERED: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as other engines type them."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def _register(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(query(apply_settings(spark), sf_dir))

    REGISTERED[query.__name__] = run
    return run


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _star(spark: SparkSession, sf_dir: str) -> Star:
    return source.warehouse(spark, sf_dir).star()


def _days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last observation day of all feeds."""
    return source.observation_days(spark, sf_dir)


def _empty_table(spark: SparkSession, feed: Feed) -> Table:
    return staging.staged_table(new_table_path(spark, "staged"), feed)


# Pages, landing and staging


@_register
def page_flatten(spark, sf_dir):
    root = new_table_path(spark, "pages")
    source.write_pages(source.region_pages(spark, sf_dir), root, REGION)
    return pages.flatten_pages(pages.read_pages(spark, root, REGION))


@_register
def page_completeness(spark, sf_dir):
    """Region pages of one event type and of a whole day never arrive; fuel pages all do, those
    of a day twice."""
    root = new_table_path(spark, "pages")
    arrived = source.region_pages(spark, sf_dir).filter(
        (F.col("event_type") != "error") & (F.col("day") != F.lit(MAP_DAY))
    )
    source.write_pages(arrived, root, REGION)
    fuel = source.fuel_type_pages(spark, sf_dir)
    twice = fuel.unionByName(fuel.filter(F.col("day") == F.lit(MAP_DAY)))
    source.write_pages(twice, root, FUEL_TYPE)
    days = _days(spark, sf_dir)
    return _stack(
        [
            pages.page_completeness(pages.read_pages(spark, root, feed), feed, days)
            for feed in (REGION, FUEL_TYPE)
        ]
    )


def _land_all(spark: SparkSession, sf_dir: str, feed: Feed, root: str) -> None:
    """Every run that fetches any of the feed's days; the last ones come after its last day."""
    raw = source.raw_feeds(spark, sf_dir)[feed.name]
    first, last = _days(spark, sf_dir)
    last_run = last + timedelta(days=feed.lookback_days)
    landing.land_runs(raw, root, feed, first, last_run)


@_register
def land_daily(spark, sf_dir):
    """Rows per landed run; every run is landed twice, the second replacing the first."""
    root = new_table_path(spark, "landing")
    for feed in FEEDS.values():
        _land_all(spark, sf_dir, feed, root)
        _land_all(spark, sf_dir, feed, root)
    return _stack(
        [
            landing.read_landed(spark, root, feed)
            .groupBy("day")
            .agg(F.count(F.lit(1)).alias("landed_rows"), F.count("value").alias("landed_values"))
            .select(F.lit(feed.name).alias("feed"), "day", "landed_rows", "landed_values")
            for feed in FEEDS.values()
        ]
    )


@_register
def scan_day(spark, sf_dir):
    root = new_table_path(spark, "landing")
    _land_all(spark, sf_dir, INTERCHANGE, root)
    return landing.scan_day(spark, root, INTERCHANGE, f"{MAP_DAY:%Y/%m/%d}")


@_register
def lookback_window(spark, sf_dir):
    """Rows every run of every feed fetches."""
    first, last = _days(spark, sf_dir)
    return _stack(
        [
            landing.by_run_day(raw, FEEDS[name], first, last + timedelta(days=FEEDS[name].lookback_days))
            .groupBy(F.lit(name).alias("feed"), F.col("day").alias("run_day"))
            .agg(F.count(F.lit(1)).alias("fetched_rows"))
            for name, raw in source.raw_feeds(spark, sf_dir).items()
        ]
    )


@_register
def backfill_range(spark, sf_dir):
    """All runs of the feed with the longest lookback, landed and staged in one go."""
    root = new_table_path(spark, "landing")
    _land_all(spark, sf_dir, INTERCHANGE, root)
    table = _empty_table(spark, INTERCHANGE)
    staging.append_new(spark, landing.read_landed(spark, root, INTERCHANGE), table, INTERCHANGE)
    return table.read(spark).drop("day")


def _land_observed(spark: SparkSession, sf_dir: str, feed: Feed, root: str) -> tuple[date, date]:
    """The same runs as ``_land_all``, every record landed once."""
    first, last = _days(spark, sf_dir)
    runs = first, last + timedelta(days=feed.lookback_days)
    landing.land_observed(source.raw_feeds(spark, sf_dir)[feed.name], root, feed, *runs)
    return runs


@_register
def backfill_observed(spark, sf_dir):
    """A backfill landed without multiplied rows, then staged."""
    root = new_table_path(spark, "landing")
    _land_observed(spark, sf_dir, INTERCHANGE, root)
    table = _empty_table(spark, INTERCHANGE)
    staging.append_new(spark, landing.read_observed(spark, root, INTERCHANGE), table, INTERCHANGE)
    return table.read(spark).drop("day")


@_register
def backfill_runs(spark, sf_dir):
    """Rows every run of such a backfill covers, derived when read."""
    root = new_table_path(spark, "landing")
    runs = {name: _land_observed(spark, sf_dir, feed, root) for name, feed in FEEDS.items()}
    return _stack(
        [
            landing.read_runs(spark, root, feed, *runs[name])
            .groupBy(F.lit(name).alias("feed"), F.col("day").alias("run_day"))
            .agg(F.count(F.lit(1)).alias("fetched_rows"))
            for name, feed in FEEDS.items()
        ]
    )


@_register
def existing_ids(spark, sf_dir):
    table = _empty_table(spark, FUEL_TYPE)
    staging.append_new(spark, source.raw_feeds(spark, sf_dir)["fuel_type"], table, FUEL_TYPE)
    return staging.existing_ids(spark, table)


@_register
def first_load(spark, sf_dir):
    """Appending to a table that does not exist yet."""
    table = _empty_table(spark, REGION)
    staging.append_new(spark, source.raw_feeds(spark, sf_dir)["region"], table, REGION)
    return table.read(spark).drop("day")


@_register
def append_incremental(spark, sf_dir):
    """The first half of the days, then all of them: each observation is stored once."""
    stored = []
    for name, raw in source.raw_feeds(spark, sf_dir).items():
        table = _empty_table(spark, FEEDS[name])
        staging.append_new(spark, raw.filter(F.col("period") < f"{SPLIT_DAY}"), table, FEEDS[name])
        staging.append_new(spark, raw, table, FEEDS[name])
        stored.append(table.read(spark).select(F.lit(name).alias("feed"), "id", "period", "value"))
    return _stack(stored)


@_register
def seed_authorities(spark, sf_dir):
    path = new_table_path(spark, "seed")
    seeds.write_seed(source.authority_seed(spark, sf_dir), path)
    return seeds.read_authority_seed(spark, path)


@_register
def seed_types(spark, sf_dir):
    """The type seed read from CSV, with the number of observations of each type."""
    path = new_table_path(spark, "seed")
    seeds.write_seed(dimensions.type_seed(spark), path)
    return _observed(
        dimensions.dim_type(seeds.read_type_seed(spark, path)),
        source.warehouse(spark, sf_dir).unified(),
        "type_code",
    )


@_register
def fact_write_roundtrip(spark, sf_dir):
    table = fact_table(new_table_path(spark, "fact"))
    write_fact(source.warehouse(spark, sf_dir).fact_from_staged(), table)
    return table.read(spark)


# Cleaning, ids and de-duplication


@_register
def clean_region(spark, sf_dir):
    return clean(source.raw_feeds(spark, sf_dir)["region"], REGION)


@_register
def clean_fuel(spark, sf_dir):
    return clean(source.raw_feeds(spark, sf_dir)["fuel_type"], FUEL_TYPE)


@_register
def clean_interchange(spark, sf_dir):
    return clean(source.raw_feeds(spark, sf_dir)["interchange"], INTERCHANGE)


@_register
def null_row_count(spark, sf_dir):
    return _stack(
        [rejected_rows(raw, FEEDS[name]) for name, raw in source.raw_feeds(spark, sf_dir).items()]
    )


@_register
def content_id(spark, sf_dir):
    return _stack(
        [
            with_content_id(clean(raw, FEEDS[name]), FEEDS[name]).select(
                F.lit(name).alias("feed"), "id", "period", "value"
            )
            for name, raw in source.raw_feeds(spark, sf_dir).items()
        ]
    )


@_register
def staged_rows(spark, sf_dir):
    """De-duplicated rows of the feed with the most copies."""
    return stage(source.raw_feeds(spark, sf_dir)["interchange"], INTERCHANGE)


@_register
def dedup_anti_join(spark, sf_dir):
    """Rows whose id is not among those of the earlier days."""
    staged = source.warehouse(spark, sf_dir).staged()["region"]
    batch = stage(source.raw_feeds(spark, sf_dir)["region"], REGION)
    stored = staged.filter(F.col("period") < F.lit(SPLIT_DAY))
    return unseen(batch, stored)


# Model


@_register
def unioned(spark, sf_dir):
    return source.warehouse(spark, sf_dir).unified()


@_register
def exclude_aggregates(spark, sf_dir):
    """Cleaned rows per reporting code that the aggregate filter keeps."""
    return _stack(
        [
            clean(raw, FEEDS[name])
            .filter(single_authority(F.col(FEEDS[name].code)))
            .groupBy(F.lit(name).alias("feed"), F.col(FEEDS[name].code).alias("ba_code"))
            .agg(F.count(F.lit(1)).alias("kept_rows"))
            for name, raw in source.raw_feeds(spark, sf_dir).items()
        ]
    )


def _observed(dim: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """A dimension with the number of rows that refer to each member."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("observations"))
    return dim.join(counts, key, "left").select(
        *dim.columns, F.coalesce("observations", F.lit(0)).alias("observations")
    )


def _observed_dim(spark: SparkSession, sf_dir: str, dim: str, key: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return _observed(getattr(star.dims, dim), star.fact, key)


@_register
def dim_ba(spark, sf_dir):
    return _observed_dim(spark, sf_dir, "ba", "ba_id")


@_register
def dim_type(spark, sf_dir):
    return _observed_dim(spark, sf_dir, "type", "type_id")


@_register
def dim_date(spark, sf_dir):
    return _observed_dim(spark, sf_dir, "date", "date_id")


@_register
def dim_time_of_day(spark, sf_dir):
    return _observed_dim(spark, sf_dir, "time_of_day", "time_id")


@_register
def fact(spark, sf_dir):
    return source.warehouse(spark, sf_dir).fact_from_staged()


# Reporting


@_register
def timeseries(spark, sf_dir):
    return dashboard.timeseries(_star(spark, sf_dir), *_days(spark, sf_dir))


@_register
def regional_summary(spark, sf_dir):
    return dashboard.regional_summary(_star(spark, sf_dir), *_days(spark, sf_dir))


@_register
def category_totals(spark, sf_dir):
    return dashboard.category_totals(
        dashboard.regional_summary(_star(spark, sf_dir), *_days(spark, sf_dir))
    )


@_register
def generation_mix(spark, sf_dir):
    return dashboard.generation_mix(_star(spark, sf_dir), *_days(spark, sf_dir))


@_register
def grid_topology(spark, sf_dir):
    return grid_map.grid_topology(_star(spark, sf_dir), MAP_DAY)


@_register
def grid_skeleton(spark, sf_dir):
    return grid_map.grid_skeleton(_star(spark, sf_dir), MAP_DAY)


@_register
def hourly_telemetry(spark, sf_dir):
    return grid_map.hourly_telemetry(_star(spark, sf_dir), MAP_DAY, MAP_HOUR)


def _map_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return grid_map.map_frame(
        grid_map.grid_skeleton(star, MAP_DAY), grid_map.hourly_telemetry(star, MAP_DAY, MAP_HOUR)
    )


@_register
def map_frame(spark, sf_dir):
    return _map_frame(spark, sf_dir)


@_register
def node_summary(spark, sf_dir):
    return grid_map.node_summary(_map_frame(spark, sf_dir))


@_register
def node_bubbles(spark, sf_dir):
    bubbles = grid_map.node_bubbles(grid_map.node_summary(_map_frame(spark, sf_dir)))
    return bubbles.withColumn("bubble_size", F.round("bubble_size", 6))


@_register
def active_flows(spark, sf_dir):
    return grid_map.active_flows(_map_frame(spark, sf_dir))


@_register
def edge_list(spark, sf_dir):
    return grid_map.edge_list(grid_map.grid_skeleton(_star(spark, sf_dir), MAP_DAY))


# Data checks


def _hashed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cleaned rows with ids but with their copies, so that the checks have failures."""
    return {
        name: with_content_id(clean(raw, FEEDS[name]), FEEDS[name])
        for name, raw in source.raw_feeds(spark, sf_dir).items()
    }


@_register
def dq_not_null(spark, sf_dir):
    unified = source.warehouse(spark, sf_dir).unified()
    return quality.not_null_checks(_hashed(spark, sf_dir), unified, _star(spark, sf_dir))


@_register
def dq_unique(spark, sf_dir):
    return quality.unique_checks(_hashed(spark, sf_dir), _star(spark, sf_dir))


@_register
def dq_relationships(spark, sf_dir):
    """References of the fact, and of one whose authorities are the active ones only."""
    star = _star(spark, sf_dir)
    active = star.dims.ba.filter(F.col("is_active") == "Yes")
    return quality.relationship_checks(star).unionByName(
        quality.relationships(
            star.fact,
            "fct_grid_operation_active",
            [("ba_id", active, "ba_id"), ("related_ba_id", active, "ba_id")],
        )
    )


@_register
def dq_report(spark, sf_dir):
    unified = source.warehouse(spark, sf_dir).unified()
    return quality.report(_hashed(spark, sf_dir), unified, _star(spark, sf_dir))


# Streams


@_register
def stream_append(spark, sf_dir):
    """Overlapping runs, appended as a stream: each observation is stored once."""
    root = new_table_path(spark, "landing")
    _land_all(spark, sf_dir, FUEL_TYPE, root)
    table = _empty_table(spark, FUEL_TYPE)
    ingest.start_append(
        ingest.landed_stream(spark, root, FUEL_TYPE, max_files_per_trigger=16),
        table,
        FUEL_TYPE,
        new_table_path(spark, "progress"),
    ).awaitTermination()
    return table.read(spark).drop("day")


@_register
def stream_dedup(spark, sf_dir):
    """The same runs in several micro-batches, the newest files first: repeats are dropped by the
    stream's state, and the older days, all late by then, by comparing with what is stored."""
    root = new_table_path(spark, "landing")
    _land_all(spark, sf_dir, FUEL_TYPE, root)
    table = _empty_table(spark, FUEL_TYPE)
    progress = new_table_path(spark, "progress")
    ingest.append_deduplicated(spark, root, table, FUEL_TYPE, progress, max_files_per_trigger=64, newest_first=True)
    return table.read(spark).drop("day")


# Late rows and runs that overlap


@_register
def append_overlapping(spark, sf_dir):
    """Two runs append the same feed at the same time: each observation is stored once."""
    raw = source.raw_feeds(spark, sf_dir)["region"]
    table = _empty_table(spark, REGION)
    with ThreadPoolExecutor(2) as runs:
        for run in [runs.submit(staging.append_new, spark, raw, table, REGION) for _ in range(2)]:
            run.result()
    return table.read(spark).drop("day")


@_register
def append_late_hour(spark, sf_dir):
    """All hours but one, then the whole day of that one: the stored day is narrowed to the batch's keys."""
    raw = source.raw_feeds(spark, sf_dir)["interchange"]
    table = _empty_table(spark, INTERCHANGE)
    hour = f"{MAP_DAY}T{MAP_HOUR:02d}"
    staging.append_new(spark, raw.filter(~F.col("period").eqNullSafe(hour)), table, INTERCHANGE)
    staging.append_new(spark, raw.filter(F.col("period").startswith(f"{MAP_DAY}")), table, INTERCHANGE)
    return table.read(spark).drop("day")


@_register
def refresh_changed(spark, sf_dir):
    """A fact built without the rows of one day, which then come late and are found by the change log."""
    house = Warehouse(spark, new_table_path(spark, "warehouse"))
    late = F.col("period").startswith(f"{MAP_DAY}")
    feeds = source.raw_feeds(spark, sf_dir)
    for name, raw in feeds.items():
        house.append(raw.filter(~F.coalesce(late, F.lit(False))), FEEDS[name])
    house.load_seeds(source.authority_seed(spark, sf_dir), dimensions.type_seed(spark))
    house.build_fact()
    for name, raw in feeds.items():
        house.append(raw.filter(late), FEEDS[name])
    house.refresh_changed()
    return house.fact_table.read(spark)
