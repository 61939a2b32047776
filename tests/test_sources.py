from __future__ import annotations

import json
from datetime import date

import pytest
from helpers import MWH, fuel, interchange, region, rows_of
from pyspark.sql import functions as F

from gridmart.operators.cleaning import clean
from gridmart.plans.dimensions import dim_ba, dim_type
from gridmart.schemas import AUTHORITY_SEED_COLUMNS, FUEL_TYPE, INTERCHANGE, REGION
from gridmart.session import new_table_path
from gridmart.sources import landing, pages, seeds
from gridmart.sources.tables import Table
from pyspark.sql import types as T


def _record(value, period="2024-01-01T00"):
    return {
        "period": period,
        "respondent": "A",
        "respondent-name": "A name",
        "type": "D",
        "type-name": "Demand",
        "value": value,
        "value-units": MWH,
    }


def _page_file(tmp_path, day, name, *documents, indent=None):
    folder = tmp_path / REGION.route / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(d if isinstance(d, str) else json.dumps(d, indent=indent) for d in documents)
    (folder / name).write_text(text)


def _page(total, *values):
    return {"response": {"total": total, "data": [_record(v) for v in values]}}


def test_pages_become_records(spark, tmp_path):
    _page_file(tmp_path, "2024-01-01", "p0.json", _page("3", "1", "2"))
    _page_file(tmp_path, "2024-01-01", "p1.json", _page(3, "3"))
    records = pages.flatten_pages(pages.read_pages(spark, str(tmp_path), REGION))
    assert records.columns == list(REGION.raw_columns)
    assert rows_of(records, "value") == [("1",), ("2",), ("3",)]


def test_pretty_printed_pages_and_numbers_as_values(spark, tmp_path):
    _page_file(tmp_path, "2024-01-01", "p0.json", _page("2", 12.7, None), indent=2)
    records = pages.flatten_pages(pages.read_pages(spark, str(tmp_path), REGION, multi_line=True))
    assert {r["value"] for r in records.collect()} == {"12.7", None}
    assert rows_of(clean(records, REGION), "value") == [(12,)]


def test_completeness(spark, tmp_path):
    _page_file(tmp_path, "2024-01-01", "p0.json", _page("3", "1", "2"), _page("3", "3"))
    _page_file(tmp_path, "2024-01-02", "p0.json", _page("3", "1", "2"))
    _page_file(tmp_path, "2024-01-03", "p0.json", _page("0"))
    _page_file(tmp_path, "2024-01-04", "p0.json", "{broken")
    report = pages.page_completeness(pages.read_pages(spark, str(tmp_path), REGION), REGION)
    assert rows_of(report, "day", "collected", "announced", "is_incomplete") == [
        (date(2024, 1, 1), 3, 3, False),
        (date(2024, 1, 2), 2, 3, True),
        (date(2024, 1, 3), 0, 0, False),
        (date(2024, 1, 4), 0, None, True),
    ]


def test_landing_a_day_again_replaces_only_that_day(spark):
    root = new_table_path(spark, "landing")
    landing.land_day(region(spark, ("2024-01-01T00", "A", "D", "1")), root, REGION, date(2024, 1, 1))
    landing.land_day(region(spark, ("2024-01-02T00", "A", "D", "2")), root, REGION, date(2024, 1, 2))
    landing.land_day(region(spark, ("2024-01-02T00", "A", "D", "3")), root, REGION, date(2024, 1, 2))
    assert rows_of(landing.read_landed(spark, root, REGION), "value") == [("1",), ("3",)]
    landing.land_day(region(spark), root, REGION, date(2024, 1, 1))
    assert landing.read_landed(spark, root, REGION).count() == 2
    assert rows_of(landing.scan_day(spark, root, REGION, "2024/01/02"), "value") == [("3",)]


def test_scan_of_a_day_prunes_partitions(spark):
    root = new_table_path(spark, "landing")
    landing.land_day(region(spark, ("2024-01-01T00", "A", "D", "1")), root, REGION, date(2024, 1, 1))
    plan = landing.scan_day(spark, root, REGION, "2024/01/01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_day_argument():
    assert landing.parse_day("2024/01/31") == date(2024, 1, 31)
    with pytest.raises(ValueError):
        landing.parse_day("2024-01-31")


def test_lookback_windows():
    day = date(2024, 3, 1)
    assert landing.lookback_window(REGION, day) == (day, day)
    assert landing.lookback_window(FUEL_TYPE, day) == (date(2024, 2, 29), day)
    assert landing.lookback_window(INTERCHANGE, day) == (date(2024, 2, 28), day)


def test_backfill_gives_every_run_its_window(spark):
    records = interchange(
        spark, *((f"2024-01-0{d}T05", "A", "B", str(d)) for d in range(1, 6)), ("bad", "A", "B", "9")
    )
    first, last = date(2024, 1, 2), date(2024, 1, 4)
    runs = landing.by_run_day(records, INTERCHANGE, first, last)
    for run_day in (first, date(2024, 1, 3), last):
        window = landing.within_window(records, INTERCHANGE, run_day)
        if run_day != first:  # the unreadable row went with the first run
            window = window.filter("period <> 'bad'")
        assert rows_of(runs.filter(runs.day == run_day), "value") == rows_of(window, "value")
    assert runs.count() == 2 + 3 + 3 + 1


def test_backfill_landed_once_gives_the_same_runs(spark, tmp_path):
    days = (f"2024-01-0{d}T05" for d in range(1, 8))
    records = interchange(spark, *((p, "A", "B", p[9]) for p in days), ("bad", "A", "B", "9"), (None, "A", "B", "8"))
    first, last = date(2024, 1, 3), date(2024, 1, 5)
    for _ in range(2):  # a repeated backfill changes nothing
        landing.land_observed(records, str(tmp_path), INTERCHANGE, first, last)
    once = landing.read_observed(spark, str(tmp_path), INTERCHANGE)
    assert rows_of(once, "value") == [(v,) for v in "1234589"]  # every record of the windows, once

    runs = landing.read_runs(spark, str(tmp_path), INTERCHANGE, first, last)
    assert rows_of(runs, "day", "value") == rows_of(landing.by_run_day(records, INTERCHANGE, first, last), "day", "value")
    assert "Exchange" not in runs._jdf.queryExecution().executedPlan().toString()

    later = landing.read_runs(spark, str(tmp_path), INTERCHANGE, last, last)
    assert rows_of(later, "value") == [("3",), ("4",), ("5",)]


def test_backfill_of_nothing_lands_nothing(spark, tmp_path):
    day = date(2024, 1, 3)
    records = interchange(spark, ("2024-01-03T05", "A", "B", "1"))
    landing.land_observed(records, str(tmp_path), INTERCHANGE, day, day)
    landing.land_observed(records.limit(0), str(tmp_path), INTERCHANGE, day, day)
    assert landing.read_runs(spark, str(tmp_path), INTERCHANGE, day, day).count() == 1


def test_foreign_days_with_changing_types(spark, tmp_path):
    text = fuel(spark, ("2024-01-01T00", "A", "SUN", "5"), ("2024-01-01T01", "A", "SUN", None))
    for name, kind in (("a", "string"), ("b", "bigint"), ("c", "double")):
        text.withColumn("value", text["value"].cast(kind)).write.parquet(str(tmp_path / name))
    wide = fuel(spark, ("2024-01-01T02", "A", "SUN", "x")).withColumn("value", F.lit(1.0e7))
    wide.write.parquet(str(tmp_path / "d"))
    rows = landing.read_foreign(spark, [str(tmp_path / n) for n in "abcd"], FUEL_TYPE)
    assert rows.schema == FUEL_TYPE.raw_schema
    assert rows_of(clean(rows, FUEL_TYPE), "value") == [(5,), (5,), (5,), (10_000_000,)]


def test_foreign_without_paths(spark):
    assert landing.read_foreign(spark, [], REGION).count() == 0


SEED = """BA Id,BA Code,BA Name,Time Zone,Region_Country Code,Region_Country Name,Generation Only BA,\
Demand by BA Subregion,US_BA,Active BA,Activation Date,Retirement Date,LATITUDE,LONGITUDE
7,ABC,"Alpha, ""Best"" Co.",Central,MID,Middle,No,No,Yes,Yes,1900-01-01,9999-12-31,31.32,-86.46
-1,Unknown,Unknown,Unknown,Unknown,Unknown,Unknown,Unknown,Unknown,Unknown,1900-01-01,9999-12-31,,
"""


def test_authority_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(SEED)
    seed = seeds.read_authority_seed(spark, str(path))
    assert tuple(seed.columns) == AUTHORITY_SEED_COLUMNS
    rows = {r["ba_id"]: r for r in dim_ba(seed).collect()}
    assert rows[7]["ba_name"] == 'Alpha, "Best" Co.'
    assert (rows[7]["latitude"], rows[7]["longitude"]) == (31.32, -86.46)
    assert rows[7]["retirement_date"] == date(9999, 12, 31)
    assert (rows[-1]["latitude"], rows[-1]["longitude"]) == (None, None)


def test_seed_round_trip(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(SEED)
    seed = seeds.read_authority_seed(spark, str(tmp_path / "seed.csv"))
    seeds.write_seed(seed, str(tmp_path / "copy"))
    copy = seeds.read_authority_seed(spark, str(tmp_path / "copy"))
    assert sorted(map(str, copy.collect())) == sorted(map(str, seed.collect()))


def test_type_seed(spark, tmp_path):
    (tmp_path / "types.csv").write_text("Type ID,Type,Type Name\n1,D,Demand\n-1,UNK,Unknown\n")
    rows = dim_type(seeds.read_type_seed(spark, str(tmp_path / "types.csv"))).collect()
    assert sorted(tuple(r) for r in rows) == [(-1, "UNK", "Unknown"), (1, "D", "Demand")]


def test_seed_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "types.csv").write_text("Type,Type ID,Type Name\nD,1,Demand\n")
    assert [tuple(r) for r in seeds.read_type_seed(spark, str(tmp_path / "types.csv")).collect()] == [("1", "D", "Demand")]
    (tmp_path / "bad.csv").write_text("Type,Id\nD,1\n")
    with pytest.raises(ValueError, match="Type ID"):
        seeds.read_type_seed(spark, str(tmp_path / "bad.csv"))


def test_a_failed_rebuild_leaves_the_table(spark):
    table = Table(new_table_path(spark, "kept"), T.StructType([T.StructField("a", T.LongType())]))
    table.replace(spark.range(3).toDF("a"))
    broken = spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('no') ELSE id END AS a")
    with pytest.raises(Exception, match="no"):
        table.replace(broken.selectExpr("CAST(a AS BIGINT) AS a"))
    assert rows_of(table.read(spark)) == [(0,), (1,), (2,)]
    table.replace(spark.range(1).toDF("a"))
    assert rows_of(table.read(spark)) == [(0,)]


def test_a_page_landed_twice_hides_no_lost_one(spark):
    page = lambda *values: ("4", [("2024-01-01T00", "A", "A", "D", "D", v, "MWh") for v in values])
    day = date(2024, 1, 1)
    rows = [(page("1", "2"), day), (page("1", "2"), day), (page("3", "4"), date(2024, 1, 3)), (page("1", "2"), date(2024, 1, 3))]
    found = spark.createDataFrame(rows, pages.page_schema(REGION))
    checked = pages.page_completeness(found, REGION, (day, date(2024, 1, 3)))
    assert rows_of(checked, "day", "collected", "is_incomplete") == [
        (day, 2, True), (date(2024, 1, 2), 0, True), (date(2024, 1, 3), 4, False)
    ]


def test_pages_of_different_requests_are_not_one_page(spark, tmp_path):
    asked = lambda offset, *values: {"request": {"params": {"offset": offset}}, **_page("4", *values)}
    # Equal records under two offsets; one offset landed twice, its records in another order.
    _page_file(tmp_path, "2024-01-01", "p0.json", asked(0, "1", "2"), asked(2, "1", "2"))
    _page_file(tmp_path, "2024-01-02", "p0.json", asked(0, "1", "2"), asked(0, "2", "1"))
    report = pages.page_completeness(pages.read_pages(spark, str(tmp_path), REGION), REGION)
    assert rows_of(report, "day", "collected", "announced", "is_incomplete") == [
        (date(2024, 1, 1), 4, 4, False),
        (date(2024, 1, 2), 2, 4, True),
    ]
