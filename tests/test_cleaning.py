from __future__ import annotations

from datetime import datetime

import pytest
from helpers import interchange, region, rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridmart.functions.parsing import hour_period, whole_number
from gridmart.operators.cleaning import clean, conform, rejected_rows
from gridmart.schemas import INTERCHANGE, REGION


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12", 12),
        (" 12 ", 12),
        ("-5", -5),
        ("12.7", 12),
        ("-12.7", -12),
        ("1.9999999", 1),
        (".5", 0),
        ("7.", 7),
        ("x", None),
        ("", None),
        (".", None),
        ("1e3", None),
        ("99999999999", None),
        ("99999999999.5", None),
        (None, None),
    ],
)
def test_whole_number(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "v string")
    assert frame.select(whole_number(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-01T05", datetime(2024, 1, 1, 5)),
        ("2024-02-29T23", datetime(2024, 2, 29, 23)),
        ("2023-02-29T05", None),
        ("2024-01-01", None),
        ("2024-01-01T24", None),
        ("2024-1-1T5", None),
        ("2024-01-01T05:00", None),
        ("02024-1-01T05", None),
        ("", None),
        (None, None),
    ],
)
def test_hour_period(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "p string")
    assert frame.select(hour_period(F.col("p")).cast("timestamp_ntz")).first()[0] == expected


BAD = [
    ("2024-01-01T00", "A", "D", "x"),
    ("2024-01-01", "A", "D", "1"),
    ("2024-01-01T00", None, "D", "1"),
    ("2024-01-01T00", "A", None, "1"),
    ("2024-01-01T00", "A", "D", None),
]
GOOD = [("2024-01-01T00", "A", "D", "1"), ("2024-01-01T01", "A", "D", "12.7")]


def test_clean_keeps_only_complete_rows(spark):
    cleaned = clean(region(spark, *BAD, *GOOD), REGION)
    assert cleaned.columns == list(REGION.staged_columns[1:])
    assert rows_of(cleaned, "respondent", "value") == [("A", 1), ("A", 12)]


def test_conform_drops_nothing(spark):
    assert conform(region(spark, *BAD, *GOOD), REGION).count() == len(BAD) + len(GOOD)


def test_rejected_rows(spark):
    row = rejected_rows(region(spark, *BAD, *GOOD), REGION).first()
    assert (row["feed"], row["total_rows"], row["rejected_rows"]) == ("region", 7, 5)


def test_rejected_rows_are_counted_in_the_same_pass(spark):
    seen = Observation("rejected")
    assert clean(region(spark, *BAD, *GOOD), REGION, seen).count() == 2
    assert seen.get == {"rejected": 5}


def test_missing_label_is_no_reason_to_drop(spark):
    raw = interchange(spark, ("2024-01-01T00", "A", "B", "1")).withColumn(
        "toba-name", F.lit(None).cast("string")
    )
    assert clean(raw, INTERCHANGE).count() == 1
