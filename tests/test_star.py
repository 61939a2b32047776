from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import authorities, fuel, interchange, region, rows_of
from pyspark.sql import functions as F

from gridmart.plans import dashboard, grid_map
from gridmart.plans.dimensions import dim_date, dim_time_of_day, dim_type, type_seed
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import FACT_COLUMNS, FUEL_TYPE, INTERCHANGE, REGION
from gridmart.session import new_table_path

SEED = [
    (1, "AAA", "North", "Yes", 40.0, -100.0),
    (2, "BBB", "South", "Yes", 30.0, -90.0),
    (3, "CCC", "South", "No", 31.0, -91.0),
    (4, "DDD", "North", "Yes", 42.0, -101.0),
]
REGION_ROWS = [
    ("2024-01-01T00", "AAA", "D", "100"),
    ("2024-01-01T00", "AAA", "DF", "90"),
    ("2024-01-01T00", "AAA", "NG", "70"),
    ("2024-01-01T00", "AAA", "TI", "7"),
    ("2024-01-01T00", "US48", "D", "1000"),
    ("2024-01-01T01", "BBB", "D", "50"),
    ("2024-01-02T00", "ZZZ", "D", "5"),
    ("2035-01-01T00", "AAA", "D", "3"),
]
FUEL_ROWS = [
    ("2024-01-01T00", "AAA", "SUN", "10"),
    ("2024-01-01T00", "AAA", "NG", "20"),
    ("2024-01-01T00", "AAA", "SYS", "30"),
    ("2024-01-01T00", "AAA", "NEW", "1"),
    ("2024-01-01T00", "TEX", "SUN", "500"),
]
FLOW_ROWS = [
    ("2024-01-01T00", "AAA", "BBB", "-40"),
    ("2024-01-01T00", "BBB", "AAA", "40"),
    ("2024-01-01T00", "AAA", "TEX", "6"),
    ("2024-01-01T00", "TEX", "AAA", "9"),
]


def build(spark, root):
    warehouse = Warehouse(spark, root)
    warehouse.append(region(spark, *REGION_ROWS), REGION)
    warehouse.append(fuel(spark, *FUEL_ROWS), FUEL_TYPE)
    warehouse.append(interchange(spark, *FLOW_ROWS), INTERCHANGE)
    warehouse.load_seeds(authorities(spark, *SEED), type_seed(spark))
    warehouse.build_fact()
    return warehouse


@pytest.fixture(scope="module")
def house(spark):
    return build(spark, new_table_path(spark, "warehouse"))


def test_dimension_sizes(spark):
    assert dim_date(spark).count() == 4383
    assert dim_time_of_day(spark).count() == 24
    assert dim_type(type_seed(spark)).count() == 20


def test_calendar_edges(spark):
    days = {r["full_date"]: r for r in dim_date(spark).collect()}
    day = days[date(2021, 1, 3)]
    assert (day["day_of_week"], day["weekday_weekend"], day["week_of_year"]) == (1, "Weekend", 53)
    day = days[date(2024, 11, 30)]
    assert (day["is_last_day_of_month"], day["fiscal_year_month"]) == ("Y", "2025-02")
    assert (day["fiscal_year"], day["fiscal_year_quarter"]) == (2025, "2025Q1")
    assert days[date(2024, 2, 29)]["day_of_year"] == 60
    assert days[date(2024, 2, 28)]["is_last_day_of_month"] == "N"


def test_hours(spark):
    hours = {r["time_id"]: r for r in dim_time_of_day(spark).collect()}
    assert [hours[h]["time_name_12"] for h in (0, 1, 12, 13)] == ["12 AM", "01 AM", "12 PM", "01 PM"]
    assert [hours[h]["hour_12"] for h in (0, 12, 23)] == [12, 12, 11]
    assert [hours[h]["day_part"] for h in (4, 5, 12, 17, 21)] == [
        "Night",
        "Morning",
        "Afternoon",
        "Evening",
        "Night",
    ]
    assert [hours[h]["peak_period"] for h in (6, 7, 22, 23)] == ["Off-Peak", "Peak", "Peak", "Off-Peak"]
    assert hours[9]["time_actual"] == "09:00:00"


def test_union_filters_each_feed_on_its_own(house):
    counts = {r["type_code"]: r["count"] for r in house.unified().groupBy("type_code").count().collect()}
    # NG survives once, from the fuel feed; TI never; aggregate codes only as far end.
    assert counts == {"D": 4, "DF": 1, "SUN": 1, "NG": 1, "SYS": 1, "NEW": 1, "FLOW": 3}


def test_fact_keeps_every_row_and_its_value(house):
    fact, unified = house.star().fact, house.unified()
    assert fact.columns == list(FACT_COLUMNS)
    assert fact.count() == unified.count()
    total = F.sum("value")
    assert fact.agg(total).first()[0] == unified.agg(total).first()[0]


def test_unknown_codes_and_days_give_null_keys(house):
    fact = house.star().fact
    assert rows_of(fact.filter("type_id IS NULL"), "value") == [(1,)]
    assert rows_of(fact.filter("ba_id IS NULL"), "value") == [(5,)]
    assert rows_of(fact.filter("date_id IS NULL"), "value") == [(3,)]
    assert rows_of(fact.filter("related_ba_id IS NULL"), "value") == [(6,)]
    assert fact.filter("related_ba_id = -1").count() == 9


@pytest.fixture(params=["folder", "catalog"])
def other(request, spark):
    if request.param == "folder":
        yield build(spark, new_table_path(spark, "warehouse"))
    else:
        spark.sql(f"CREATE DATABASE grid LOCATION '{new_table_path(spark, 'database')}'")
        yield build(spark, "grid")
        spark.sql("DROP DATABASE grid CASCADE")


def test_refresh_replaces_only_its_days(spark, house, other):
    late = [("2024-01-02T03", "AAA", "D", "8"), ("2024-01-01T09", "AAA", "D", "4")]
    for _ in range(2):
        other.append(region(spark, *late), REGION)
        other.refresh_fact(date(2024, 1, 2), date(2024, 1, 2))
    fact = other.star().fact
    assert fact.count() == house.star().fact.count() + 1
    assert rows_of(fact.filter("date_id = 20240102"), "value") == [(5,), (8,)]
    assert fact.filter("date_id IS NULL").count() == 1
    with pytest.raises(ValueError):
        other.refresh_fact(date(2030, 12, 31), date(2031, 1, 1))


DAYS = (date(2024, 1, 1), date(2024, 1, 2))


def test_timeseries(house):
    rows = dashboard.timeseries(house.star(), *DAYS).collect()
    assert [tuple(r) for r in rows] == [
        (date(2024, 1, 1), 0, datetime(2024, 1, 1, 0), 100, 90, 6, 60),
        (date(2024, 1, 1), 1, datetime(2024, 1, 1, 1), 50, 0, 0, 0),
        (date(2024, 1, 2), 0, datetime(2024, 1, 2, 0), 5, 0, 0, 0),
    ]


def test_regional_summary_and_category_order(house):
    summary = dashboard.regional_summary(house.star(), *DAYS)
    assert [tuple(r) for r in summary.collect()] == [
        ("North", "Demand", 100),
        ("North", "Demand Forecast", 90),
        ("North", "Net Generation", 60),
        ("South", "Demand", 50),
        ("South", "Total Interchange", 40),
        ("North", "Total Interchange", -34),
    ]
    assert [r["category"] for r in dashboard.category_totals(summary).collect()] == [
        "Demand",
        "Demand Forecast",
        "Net Generation",
        "Total Interchange",
    ]


def test_generation_mix_leaves_some_sources_out(house):
    rows = rows_of(dashboard.generation_mix(house.star(), *DAYS), "source", "value")
    assert rows == [("Natural gas", 20), ("Solar", 10)]


def test_the_views_answer_sql(spark, house):
    """Short queries of our own over the registered views agree with the frames."""
    star = house.star()
    star.register_views()
    hours = dashboard.timeseries(star, *DAYS).collect()
    by_sql = spark.sql(
        "SELECT date_id, time_id, sum(value) AS demand FROM fct_grid_operation "
        "NATURAL JOIN dim_type WHERE type_code = 'D' AND date_id IS NOT NULL GROUP BY ALL"
    ).collect()
    demand = {(int(f"{r['full_date']:%Y%m%d}"), r["hour_24"]): r["demand"] for r in hours if r["demand"]}
    assert {(r["date_id"], r["time_id"]): r["demand"] for r in by_sql if r["demand"]} == demand
    names = spark.sql("SELECT count(*) AS n FROM dim_ba WHERE is_active = 'Yes'").first()["n"]
    assert names == grid_map.grid_skeleton(star, DAYS[0]).select("ba_id").distinct().count()


def _scan(plan):
    return [line for line in plan.split("\n") if "FileScan" in line and "time_id" in line]


def test_reporting_prunes_days_and_columns(house):
    star = house.star()
    frame = dashboard.timeseries(star, DAYS[0], DAYS[0])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    (scan,) = _scan(plan)
    assert "(date_id" in scan and ">= 20240101" in scan and "<= 20240101" in scan
    assert "value_units" not in scan and "period" not in scan
    for plan_of in (frame, dashboard.regional_summary(star, *DAYS), dashboard.generation_mix(star, *DAYS)):
        text = plan_of._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "Cartesian" not in text
        assert text.count("BroadcastHashJoin") >= 2
