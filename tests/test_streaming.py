from __future__ import annotations

from datetime import date

from helpers import fuel, rows_of

from gridmart.schemas import FUEL_TYPE
from gridmart.session import new_table_path
from gridmart.sources import landing, staging
from gridmart.streaming import ingest

RECORDS = [(f"2024-01-0{d}T{h:02d}", "A", "SUN", str(h)) for d in range(1, 5) for h in (0, 7)]


def _land(spark, root, first, last):
    records = fuel(spark, *RECORDS, RECORDS[0], ("bad", "A", "SUN", "1"))
    landing.land(landing.by_run_day(records, FUEL_TYPE, first, last), root, FUEL_TYPE)


def _run(spark, root, table, checkpoint):
    stream = ingest.landed_stream(spark, root, FUEL_TYPE, max_files_per_trigger=2)
    ingest.start_append(stream, table, FUEL_TYPE, checkpoint).awaitTermination()


def test_stream_and_batch_store_the_same(spark):
    root = new_table_path(spark, "landing")
    staged, batch = (staging.staged_table(new_table_path(spark, n), FUEL_TYPE) for n in ("a", "b"))
    checkpoint = new_table_path(spark, "progress")
    _land(spark, root, date(2024, 1, 1), date(2024, 1, 3))
    _run(spark, root, staged, checkpoint)
    _land(spark, root, date(2024, 1, 4), date(2024, 1, 5))
    _run(spark, root, staged, checkpoint)
    staging.append_new(spark, landing.read_landed(spark, root, FUEL_TYPE), batch, FUEL_TYPE)
    by_stream = rows_of(staged.read(spark))
    assert by_stream == rows_of(batch.read(spark))
    assert len(by_stream) == len(RECORDS)


def test_replay_from_the_start_adds_nothing(spark):
    root = new_table_path(spark, "landing")
    staged = staging.staged_table(new_table_path(spark, "staged"), FUEL_TYPE)
    _land(spark, root, date(2024, 1, 1), date(2024, 1, 5))
    for _ in range(2):
        _run(spark, root, staged, new_table_path(spark, "progress"))
        assert staged.read(spark).count() == len(RECORDS)


def test_late_rows_are_kept_and_repeats_are_not(spark):
    root, checkpoint = new_table_path(spark, "landing"), new_table_path(spark, "progress")
    staged = staging.staged_table(new_table_path(spark, "staged"), FUEL_TYPE)

    def arrive(*days):
        rows = fuel(spark, *[(f"2024-01-{d:02d}T05", "A", "SUN", str(d)) for d in days])
        first, last = date(2024, 1, 1), date(2024, 1, 25)
        landing.land(landing.by_run_day(rows, FUEL_TYPE, first, last), root, FUEL_TYPE)
        stream = ingest.landed_stream(spark, root, FUEL_TYPE, max_files_per_trigger=1, newest_first=True)
        ingest.start_append(stream, staged, FUEL_TYPE, checkpoint).awaitTermination()

    arrive(21)
    arrive(1, 22)
    stored = rows_of(staged.read(spark).selectExpr("day(period) AS day"))
    assert stored == [(1,), (21,), (22,)]


def test_a_backlog_goes_through_the_state_near_its_end_only(spark):
    root, checkpoint = new_table_path(spark, "landing"), new_table_path(spark, "progress")
    staged = staging.staged_table(new_table_path(spark, "staged"), FUEL_TYPE)

    def arrive(*days):
        rows = fuel(spark, *[(f"2024-01-{d:02d}T05", "A", "SUN", str(d)) for d in days], ("bad", "A", "SUN", "1"))
        landing.land(landing.by_run_day(rows, FUEL_TYPE, date(2024, 1, days[0]), date(2024, 1, days[-1] + 1)), root, FUEL_TYPE)
        run = ingest.append_deduplicated(spark, root, staged, FUEL_TYPE, checkpoint, max_files_per_trigger=64, newest_first=True)
        states = [s.numRowsUpdated for p in run.recentProgress for s in p.stateOperators]
        return sum(states), [r[0] for r in rows_of(staged.read(spark).selectExpr("day(period) AS day"))]

    # The days 17 to 20 lie within three days of the last one; each run lands its day and the one before.
    assert arrive(*range(1, 21)) == (4, list(range(1, 21)))
    assert arrive(22, 23)[1] == [*range(1, 21), 22, 23]
