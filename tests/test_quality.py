from __future__ import annotations

from helpers import authorities, fuel, interchange, region

from gridmart.plans import quality
from gridmart.plans.dimensions import type_seed
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import FUEL_TYPE, INTERCHANGE, REGION
from gridmart.session import new_table_path


def _warehouse(spark, regions, fuels, flows):
    house = Warehouse(spark, new_table_path(spark, "warehouse"))
    house.append(region(spark, *regions), REGION)
    house.append(fuel(spark, *fuels), FUEL_TYPE)
    house.append(interchange(spark, *flows), INTERCHANGE)
    house.load_seeds(
        authorities(spark, (1, "AAA", "North", "Yes", 1, 1), (2, "BBB", "North", "Yes", 2, 2)),
        type_seed(spark),
    )
    house.build_fact()
    return house


def _failures(report):
    return {
        (r["model"], r["column_name"], r["test"]): r["failures"] for r in report.collect() if r["failures"]
    }


HOUR = "2024-01-01T00"
CLEAN = ([(HOUR, "AAA", "D", "1")], [(HOUR, "AAA", "SUN", "1")], [(HOUR, "AAA", "BBB", "1")])


def test_clean_data_passes_all_thirty_checks(spark):
    house = _warehouse(spark, *CLEAN)
    report = house.check()
    rows = report.collect()
    assert len(rows) == len({r[:3] for r in rows}) == 30
    assert [r["test"] for r in rows].count("not_null") == 18
    assert [r["test"] for r in rows].count("unique") == 7
    assert _failures(report) == {}


def test_bad_data_fails_exactly_where_it_is_bad(spark):
    house = _warehouse(
        spark,
        [(HOUR, "ZZZ", "D", "1"), ("2035-01-01T00", "AAA", "D", "1")],
        [(HOUR, "AAA", "NEW", "1")],
        [(HOUR, "AAA", "TEX", "1"), (HOUR, "AAA", "BBB", "1")],
    )
    assert _failures(house.check()) == {
        ("fct_grid_operation", "ba_id", "not_null"): 1,
        ("fct_grid_operation", "date_id", "not_null"): 1,
        ("fct_grid_operation", "type_id", "not_null"): 1,
        ("fct_grid_operation", "related_ba_id", "not_null"): 1,
    }


def test_unique_ignores_nulls_and_counts_values(spark):
    keys = ["a", "a", "a", "b", "c", "c", None, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    assert _failures(quality.key_checks(rows, "t", "k")) == {
        ("t", "k", "not_null"): 2,
        ("t", "k", "unique"): 2,
    }
    assert _failures(quality.unique(rows, "t", "k")) == {("t", "k", "unique"): 2}
    assert _failures(quality.not_null(rows, "t", ["k"])) == {("t", "k", "not_null"): 2}


def test_checks_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "k string")
    assert [r["failures"] for r in quality.key_checks(rows, "t", "k").collect()] == [0, 0]


def test_relationships_count_orphans_only(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "p int")
    assert _failures(quality.relationships(child, "t", [("k", parent, "p")])) == {
        ("t", "k", "relationships"): 2
    }


def test_fact_is_read_once_for_its_ten_checks(spark):
    house = _warehouse(spark, *CLEAN)
    plan = quality.fact_checks(house.star())._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "related_ba_id" in line]
    assert len(scans) == 1
