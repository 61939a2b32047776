"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as contract
from gridmart.registry.queries import REGISTERED

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


# Same types on both sides, so that equal values also hash equally.
TYPE_NAMES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, sf_dir, db, name):
    frame = contract.queries()[name](spark, sf_dir)
    cursor = db.execute(contract.oracle_sql()[name])
    expected_types = {d[0]: TYPE_NAMES[str(d[1])] for d in cursor.description}
    columns = sorted(expected_types)
    position = {d[0]: i for i, d in enumerate(cursor.description)}
    expected = [tuple(row[position[c]] for c in columns) for row in cursor.fetchall()]

    assert dict(frame.dtypes) == expected_types
    actual = [tuple(row[c] for c in columns) for row in frame.collect()]
    assert len(actual) == len(expected)
    assert expected, "an empty result checks nothing"
    assert _sorted(actual) == _sorted(expected)


def test_every_query_has_sql():
    assert set(REGISTERED) <= set(contract.queries())
    assert set(REGISTERED) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    row = contract.entry(spark).first()
    assert isinstance(row["full_date"], dt.date)


def test_fixed_lists():
    """The SQL takes these lists from the library: here they are spelled out."""
    from gridmart.schemas import AGGREGATE_CODES, MIX_TYPE_CODES, TYPES

    assert set(AGGREGATE_CODES) >= {"CAL", "CAR", "CENT", "FLA", "US48"}
    assert {(i, code) for i, code, _ in TYPES} >= {(1, "D"), (2, "DF"), (3, "FLOW"), (17, "NG"), (19, "NUC"), (-1, "UNK")}
    assert len(TYPES) == 20 and len(MIX_TYPE_CODES) == 10
