"""Leases, change logs, late rows in the fact, small batches against large days."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from helpers import authorities, fuel, interchange, region, rows_of

from gridmart.plans.dimensions import type_seed
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import FEEDS, FUEL_TYPE, REGION
from gridmart.session import new_table_path
from gridmart.sources import control, landing, staging
from gridmart.sources.control import ChangeLog, LeaseLost, exclusive
from gridmart.streaming import ingest


def new_table(spark, feed=REGION):
    return staging.staged_table(new_table_path(spark, "staged"), feed)


def demand(*hours, day="2024-01-01", value="1"):
    return [(f"{day}T{h:02d}", "A", "D", value) for h in hours]


def test_runs_at_the_same_time_store_each_row_once(spark):
    table = new_table(spark)
    rows = region(spark, *demand(*range(24)), *demand(*range(24), day="2024-01-02"))
    with ThreadPoolExecutor(3) as runs:
        list(runs.map(lambda _: staging.append_new(spark, rows, table, REGION), range(3)))
    assert table.read(spark).count() == 48


def test_a_lease_is_held_by_one_and_given_back(spark):
    table, order = new_table(spark), []

    def run(name):
        with exclusive(spark, table):
            order.append((name, "in"))
            time.sleep(0.3)
            order.append((name, "out"))

    with ThreadPoolExecutor(4) as runs:
        list(runs.map(run, range(4)))
    assert all(order[i][0] == order[i + 1][0] for i in range(0, 8, 2))
    with exclusive(spark, table), pytest.raises(TimeoutError), exclusive(spark, table, wait=0):
        pass
    with pytest.raises(KeyError), exclusive(spark, table):
        raise KeyError
    with exclusive(spark, table, wait=0) as lease:
        lease.check()


def test_an_expired_lease_is_taken_over_and_its_holder_notices(spark):
    table = new_table(spark)
    with exclusive(spark, table) as first:
        time.sleep(1.1)
        with exclusive(spark, table, expires=1.0, wait=0) as second:
            second.check()
            with pytest.raises(LeaseLost):
                first.check()
            with pytest.raises(TimeoutError), exclusive(spark, table, expires=60, wait=0):
                pass
    names = os.listdir(f"{control.control_folder(spark, table)}/lease")
    assert len(names) <= 4


def house_of(spark, *rows):
    house = Warehouse(spark, new_table_path(spark, "house"))
    house.append(region(spark, *rows), REGION)
    house.append(fuel(spark), FUEL_TYPE)
    house.append(interchange(spark), FEEDS["interchange"])
    house.load_seeds(authorities(spark, (1, "A", "North", "Yes", 1.0, 2.0)), type_seed(spark))
    return house


def files_by_day(house):
    found = {}
    for folder, _, names in os.walk(house.fact_table.target.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.basename(folder), set()).add(name)
    return found


def test_late_rows_of_a_stream_reach_the_fact_and_only_their_day_is_rewritten(spark, tmp_path):
    days = ["2024-01-01", "2024-01-02", "2024-02-01"]
    house = house_of(spark, *[r for d in days for r in demand(1, day=d)])
    assert house.refresh_changed() is None
    before = files_by_day(house)
    assert house.refresh_changed() == [] and files_by_day(house) == before

    root = str(tmp_path / "landing")
    # One late row, and one that is stored already: its day gains nothing.
    records = region(spark, *demand(7, day="2024-01-02", value="5"), *demand(1, day="2024-02-01"))
    landing.land_day(records, root, REGION, date(2024, 3, 1))
    stream = ingest.landed_stream(spark, root, REGION)
    ingest.start_append(stream, house.staged_table(REGION), REGION, str(tmp_path / "progress")).awaitTermination()
    assert house.refresh_changed() == [date(2024, 1, 2)]
    after = files_by_day(house)
    assert {day for day in after if after[day] != before[day]} == {"date_id=20240102"}
    fact = house.fact_table.read(spark).filter("date_id = 20240102")
    assert rows_of(fact, "time_id", "value") == [(1, 1), (7, 5)]
    assert house.refresh_changed() == []


def test_days_off_the_calendar_are_rebuilt_together(spark):
    house = house_of(spark, *demand(1), *demand(1, day="1999-01-01"))
    house.build_fact()
    house.append(region(spark, *demand(2, day="2050-01-01")), REGION)
    assert house.refresh_changed() == [date(2050, 1, 1)]
    assert house.fact_table.read(spark).filter("date_id IS NULL").count() == 2
    assert house.fact_table.read(spark).count() == 3


def test_a_crash_loses_no_day(spark, monkeypatch):
    house = house_of(spark, *demand(1), *demand(1, day="2024-01-02"))
    house.build_fact()
    # The run dies after its rows were written and before it says which days gained some.
    with monkeypatch.context() as broken:
        broken.setattr(ChangeLog, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            house.append(region(spark, *demand(1, 2)), REGION)
    # The refresh dies after the fact was written and before the entries are crossed off.
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "_caught_up", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            house.refresh_changed()
    assert house.refresh_changed() == [date(2024, 1, 1)]
    assert house.fact_table.read(spark).count() == 3
    assert house.refresh_changed() == []


def test_a_small_batch_narrows_the_stored_day_to_its_keys(spark, monkeypatch):
    table = new_table(spark)
    many = spark.range(0, 20_000).selectExpr(
        "'2024-01-01T05' AS period", "concat('R', id) AS respondent", "'n' AS `respondent-name`", "'D' AS type",
        "'n' AS `type-name`", "cast(id AS string) AS value", "'u' AS `value-units`",
    )
    staging.append_new(spark, many, table, REGION)
    late = many.limit(3).union(region(spark, *demand(5, value="9")))
    stored = table.read(spark)
    small = staging.stored_candidates(late, stored, REGION, staging.batch_profile(late, REGION))
    assert small.count() == 3
    narrow = rows_of(staging.new_rows(late, stored, REGION))
    monkeypatch.setattr(staging, "SMALL_BATCH_ROWS", 0)
    large = staging.stored_candidates(late, stored, REGION, staging.batch_profile(late, REGION))
    assert large.count() == 20_000
    assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    assert rows_of(staging.new_rows(late, stored, REGION)) == narrow and len(narrow) == 1


def test_repeats_are_dropped_by_a_state_that_stays_small(spark, tmp_path):
    root, table = str(tmp_path / "landing"), new_table(spark, FUEL_TYPE)
    days = [f"2024-01-{d:02d}" for d in range(1, 13)]
    rows = [(f"{d}T{h:02d}", "A", "SUN", "1") for d in days for h in range(0, 24, 6)]
    for d in range(1, 13):
        own = [r for r in rows if r[0].startswith(f"2024-01-{d:02d}")]
        before = [r for r in rows if r[0].startswith(f"2024-01-{d - 1:02d}")]
        landing.land_day(fuel(spark, *own, *before, own[0]).coalesce(1), root, FUEL_TYPE, date(2024, 1, d))
    progress = str(tmp_path / "progress")
    first = ingest.append_deduplicated(spark, root, table, FUEL_TYPE, progress, max_files_per_trigger=2)
    assert table.read(spark).count() == len(rows)
    states = [s for p in first.recentProgress for s in p["stateOperators"]]
    assert {s["operatorName"] for s in states} == {"dedupeWithinWatermark"}
    assert 0 < max(s["numRowsTotal"] for s in states) < len(rows)
    assert sum(s["numRowsRemoved"] for s in states) > 0

    # Too late for the state: kept all the same, and once.
    late = [("2024-01-03T01", "A", "SUN", "7"), rows[0]]
    landing.land_day(fuel(spark, *late, *late), root, FUEL_TYPE, date(2024, 2, 1))
    for _ in range(2):
        ingest.append_deduplicated(spark, root, table, FUEL_TYPE, progress)
        assert table.read(spark).count() == len(rows) + 1
    assert staging.staged_table(table.target, FUEL_TYPE).read(spark).filter("value = 7").count() == 1
