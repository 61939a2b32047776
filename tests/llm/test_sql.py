"""Corpus queries that have SQL, against it."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from gridmart.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cursor = db.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    expected = Counter(cursor.fetchall())
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in frame.collect()) == expected
