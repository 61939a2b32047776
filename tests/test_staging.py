from __future__ import annotations

import random
from datetime import date

import pytest
from helpers import final_plan, fuel, interchange, region, rows_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from gridmart.operators.cleaning import clean
from gridmart.operators.dedup import distinct_observations, unseen
from gridmart.schemas import FUEL_TYPE, INTERCHANGE, REGION
from gridmart.session import new_table_path
from gridmart.sources import staging

A = ("2024-01-01T00", "A", "D", "1")
REVISED = ("2024-01-01T00", "A", "D", "2")
OTHER_DAY = ("2024-01-02T00", "A", "D", "1")


def new_table(spark, feed):
    return staging.staged_table(new_table_path(spark, "staged"), feed)


def test_copies_in_a_batch_become_one_row(spark):
    staged = staging.stage(region(spark, A, A, A, REVISED), REGION)
    assert rows_of(staged, "respondent", "value") == [("A", 1), ("A", 2)]
    assert staged.columns == list(REGION.staged_columns)


def test_label_of_a_copy_does_not_depend_on_row_order(spark):
    one = region(spark, A).withColumn("type-name", F.lit("b"))
    two = region(spark, A).withColumn("type-name", F.lit("a"))
    for rows in (one.union(two), two.union(one)):
        assert staging.stage(rows, REGION).first()["type_name"] == "a"


def test_content_id_is_the_hash_of_the_rendered_key(spark):
    import hashlib

    expected = hashlib.sha256(b"2024-01-01 00:00:00||A||D||1").hexdigest()
    assert staging.stage(region(spark, A), REGION).first()["id"] == expected


def test_appending_twice_adds_nothing(spark):
    table = new_table(spark, REGION)
    batch = region(spark, A, A, OTHER_DAY)
    for _ in range(2):
        staging.append_new(spark, batch, table, REGION)
        assert table.read(spark).count() == 2


def test_revised_value_is_kept_next_to_the_old_one(spark):
    table = new_table(spark, REGION)
    staging.append_new(spark, region(spark, A), table, REGION)
    staging.append_new(spark, region(spark, A, REVISED), table, REGION)
    assert rows_of(table.read(spark), "value") == [(1,), (2,)]


def test_empty_batch(spark):
    table = new_table(spark, REGION)
    staging.append_new(spark, region(spark, A), table, REGION)
    staging.append_new(spark, region(spark), table, REGION)
    assert table.read(spark).count() == 1


def test_all_feeds_skip_stored_rows(spark):
    for make, feed in ((region, REGION), (fuel, FUEL_TYPE), (interchange, INTERCHANGE)):
        table = new_table(spark, feed)
        for _ in range(2):
            staging.append_new(spark, make(spark, ("2024-01-01T00", "A", "B", "1")), table, feed)
        assert table.read(spark).count() == 1


def test_missing_table_is_a_first_load_but_other_errors_are_not(spark, tmp_path):
    assert staging.staged_table(f"{tmp_path}/none", REGION).read_if_any(spark) is None
    assert staging.staged_table("no_such_table", REGION).read_if_any(spark) is None
    with pytest.raises(Py4JJavaError):
        staging.staged_table("nosuchscheme://x", REGION).read_if_any(spark)


def test_stored_days_outside_the_batch_are_not_read(spark):
    table = new_table(spark, REGION)
    days = [(f"2024-01-{d:02d}T00", "A", "D", "1") for d in range(1, 29)]
    staging.append_new(spark, region(spark, *days), table, REGION)
    stored = table.read(spark)
    assert sorted(r["day"] for r in stored.collect())[0] == date(2024, 1, 1)
    fresh = staging.new_rows(region(spark, days[3], ("2024-01-05T07", "A", "D", "9")), stored, REGION)
    assert rows_of(fresh, "value") == [(9,)]
    assert "PartitionFilters: [day" in (plan := final_plan(fresh)) and "IN (2024-01-04,2024-01-05)" in plan


def test_stray_periods_do_not_open_other_days(spark):
    table = new_table(spark, REGION)
    days = [(f"2024-01-{d:02d}T00", "A", "D", "1") for d in range(1, 11)]
    staging.append_new(spark, region(spark, *days), table, REGION)
    batch = region(spark, days[3], ("1999-01-01T00", "A", "D", "5"), ("2030-01-01T00", "A", "D", "5"), ("2024-01-07T00", "A", "D", "x"))
    assert staging.batch_days(batch, REGION) == [date(1999, 1, 1), date(2024, 1, 4), date(2030, 1, 1)]
    fresh = staging.new_rows(batch, table.read(spark), REGION)
    assert sorted(r["period"].year for r in fresh.collect()) == [1999, 2030]
    assert "IN (1999-01-01,2024-01-04,2030-01-01)" in final_plan(fresh)


def test_stored_side_adds_one_shuffle_only(spark):
    table = new_table(spark, REGION)
    staging.append_new(spark, region(spark, A), table, REGION)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = staging.new_rows(region(spark, A), table.read(spark), REGION)
        plan = fresh._jdf.queryExecution().sparkPlan().toString()
        physical = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan
    # One for the batch (its grouping) and one for the stored keys; the join adds none.
    assert physical.split("Subquery")[0].count("Exchange hashpartitioning") == 2


def test_against_brute_force(spark):
    rng = random.Random(7)

    def some(n):
        return [
            (
                f"2024-01-0{rng.randint(1, 3)}T{rng.randint(0, 3):02d}",
                rng.choice("AB"),
                rng.choice(["D", "DF"]),
                str(rng.randint(0, 4)),
            )
            for _ in range(n)
        ]

    stored, batch = some(60), some(80)
    table = new_table(spark, REGION)
    staging.append_new(spark, region(spark, *stored), table, REGION)
    fresh = staging.new_rows(region(spark, *batch), table.read(spark), REGION)
    expected = {(p.replace("T", " ") + ":00:00", r, t, int(v)) for p, r, t, v in set(batch) - set(stored)}
    actual = fresh.select(F.col("period").cast("string"), "respondent", "type", "value").collect()
    assert len(actual) == len(expected)
    assert {tuple(r) for r in actual} == expected


def test_one_row_making_up_most_of_the_batch_is_merged_before_the_shuffle(spark):
    hot = spark.range(0, 50_000, 1, 4).crossJoin(F.broadcast(region(spark, A)))
    rows = clean(hot.drop("id"), REGION)
    merged = distinct_observations(rows, REGION)
    assert merged.count() == 1
    assert "partial_min" in merged._jdf.queryExecution().executedPlan().toString()


def test_unseen_on_ids(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    stored = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows_of(unseen(batch, stored)) == [("b", 2)]
