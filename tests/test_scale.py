"""Hot keys, large days and joins without broadcast."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridmart.operators.joins import keep_all_small
from gridmart.plans import dashboard, grid_map, quality
from gridmart.registry import feeds
from gridmart.schemas import INTERCHANGE, REGION
from gridmart.session import new_table_path, shared_folder
from gridmart.sources import landing, staging

SMALLEST = "/root/testdata/sf0.001"
DAYS = (date(2024, 1, 1), date(2024, 1, 30))


@contextmanager
def settings(spark, **values):
    names = {key.replace("_", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def hourly_rows(spark, hot, others):
    """Distinct region rows, ``hot`` of them on one day."""
    n = F.col("id")
    day = F.when(n < hot, F.lit("2024-01-05")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad((n % 20 + 6).cast("string"), 2, "0"))
    )
    return spark.range(0, hot + others, 1, 8).select(
        F.concat(day, F.lit("T"), F.lpad((n % 24).cast("string"), 2, "0")).alias("period"),
        F.lit("AAA").alias("respondent"),
        F.lit("AAA name").alias("respondent-name"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type-name"),
        n.cast("string").alias("value"),
        F.lit("megawatthours").alias("value-units"),
    )


def files_of_day(rows, day):
    return rows.filter(F.col("day") == F.lit(day)).select(F.input_file_name()).distinct().count()


def test_a_day_with_most_rows_is_written_by_several_tasks(spark):
    table = staging.staged_table(new_table_path(spark, "staged"), REGION)
    with settings(
        spark,
        spark_sql_adaptive_advisoryPartitionSizeInBytes="64KB",
        spark_sql_adaptive_coalescePartitions_minPartitionSize="16KB",
    ):
        staging.append_new(spark, hourly_rows(spark, 40_000, 2_000), table, REGION)
    stored = table.read(spark)
    assert stored.count() == 42_000
    assert files_of_day(stored, date(2024, 1, 5)) > 2 * files_of_day(stored, date(2024, 1, 7))


def test_a_landed_day_with_most_rows_is_split_too(spark):
    root = new_table_path(spark, "landing")
    with settings(spark, spark_sql_adaptive_advisoryPartitionSizeInBytes="256KB"):
        raw = hourly_rows(spark, 40_000, 2_000)
        landing.land(landing.by_run_day(raw, REGION, *DAYS), root, REGION)
    landed = landing.read_landed(spark, root, REGION)
    assert landed.count() == 42_000
    assert files_of_day(landed, date(2024, 1, 5)) > 2


@pytest.fixture(scope="module")
def house(spark):
    return feeds.warehouse(spark, SMALLEST)


def _reports(house):
    star = house.star()
    frame = grid_map.map_frame(
        grid_map.grid_skeleton(star, DAYS[0]), grid_map.hourly_telemetry(star, DAYS[0], 0)
    )
    return {
        "fact": house.fact_from_staged(),
        "timeseries": dashboard.timeseries(star, *DAYS),
        "regional_summary": dashboard.regional_summary(star, *DAYS),
        "map_frame": frame,
        "fact_checks": quality.fact_checks(star),
    }


@pytest.mark.parametrize(
    "name", ["fact", "timeseries", "regional_summary", "map_frame", "fact_checks"]
)
def test_results_without_any_broadcast_are_the_same(spark, house, name):
    expected = sorted(map(str, _reports(house)[name].collect()))
    with settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_autoBroadcastJoinThreshold="-1",
    ):
        frame = _reports(house)[name]
        assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, frame.collect())) == expected
    assert expected


def test_a_hot_edge_is_split_in_the_join(spark):
    small = spark.createDataFrame([(a, b) for a in range(5) for b in range(5)], "a int, b int")
    large = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 5).cast("int")).alias("a"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 7).cast("int")).alias("b"),
        F.col("id").alias("v"),
    )
    with settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="64KB",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="64KB",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.5",
    ):
        joined = keep_all_small(small, large, ["a", "b"])
        matched = joined.filter("v IS NOT NULL").agg(F.count("v"), F.sum("v")).first()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    expected = large.filter("a < 5 AND b < 5").agg(F.count("v"), F.sum("v")).first()
    assert tuple(matched) == tuple(expected)
    assert "skew=true" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_table_path(spark, "x") != new_table_path(spark, "x")


class _Cluster:
    """A session that only answers for its settings."""

    def __init__(self, **values):
        self.values = values
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_folder(_Cluster(**{"spark.master": "yarn"}))
    named = _Cluster(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(named) == "hdfs:///shared"




def test_a_split_of_packed_files_is_small_whatever_the_session_says(spark):
    from gridmart.session import apply_settings

    with settings(spark, spark_sql_files_maxPartitionBytes="128m"):
        apply_settings(spark)
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 16 << 20
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        apply_settings(spark)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"


def test_no_file_of_a_raw_feed_has_many_rows(spark, monkeypatch):
    monkeypatch.setattr(feeds, "FILE_ROWS", 100)
    root = feeds._raw_root.__wrapped__(spark, "once", SMALLEST, ())
    rows = spark.read.parquet(f"{root}/fuel_type").groupBy(F.input_file_name()).count()
    assert rows.agg(F.max("count")).first()[0] <= 100 < rows.agg(F.sum("count")).first()[0]


def test_runs_are_landed_with_one_shuffle_of_each_record(spark, monkeypatch):
    raw = hourly_rows(spark, 300, 200).unionByName(hourly_rows(spark, 3, 0).withColumn("period", F.lit("no day")))
    raw = raw.toDF(*INTERCHANGE.raw_columns)
    kept, root = [], new_table_path(spark, "landing")
    save = landing._save_days
    monkeypatch.setattr(landing, "_save_days", lambda rows, *rest: (kept.append(rows), save(rows, *rest)))
    landing.land_runs(raw, root, INTERCHANGE, *DAYS)
    key = lambda frame: sorted(map(str, frame.select(*INTERCHANGE.raw_columns, "day").collect()))
    assert key(landing.read_landed(spark, root, INTERCHANGE)) == key(landing.by_run_day(raw, INTERCHANGE, *DAYS))
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate") < plan.find("RebalancePartitions")
