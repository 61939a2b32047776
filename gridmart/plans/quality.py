"""Data checks: not-null, unique and relationship, with failure counts.

Every check is a row (model, column_name, test, failures). All not-null and relationship
checks of a table share one pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.plans.star import Star
from gridmart.schemas import FEEDS, UNIFIED_COLUMNS

REPORT_COLUMNS = ("model", "column_name", "test", "failures")


def _as_rows(counts: DataFrame, model: str, tests: Sequence[tuple[str, str]]) -> DataFrame:
    """One wide row of counts (named ``column:test``) to one row per check."""
    checks = F.array(
        *(
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(test).alias("test"),
                F.col(f"`{column}:{test}`").alias("failures"),
            )
            for column, test in tests
        )
    )
    return counts.select(F.explode(checks).alias("check")).select(F.lit(model).alias("model"), "check.*")


def not_null(rows: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}:not_null") for c in columns))
    return _as_rows(counts, model, [(c, "not_null") for c in columns])


def unique(rows: DataFrame, model: str, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts the values that occur more than once; nulls are not values."""
    return key_checks(rows, model, column, ("unique",), by)


def key_checks(
    rows: DataFrame,
    model: str,
    column: str,
    tests: Sequence[str] = ("not_null", "unique"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Both checks of a key from one grouping of it: nulls are the group of null.

    ``by`` names columns that the key is a digest of. Grouping by those, behind a hash of
    them, shuffles and compares a few bytes instead of the digest's text.
    """
    if by:
        groups = rows.groupBy(F.xxhash64(*by).alias("_hash"), *by).agg(
            F.count(column).alias("_rows"), F.count_if(F.col(column).isNull()).alias("_nulls")
        )
    else:
        groups = rows.groupBy(F.col(column).alias("_key")).agg(
            F.count(column).alias("_rows"), F.count_if(F.col(column).isNull()).alias("_nulls")
        )
    failures = {
        "not_null": F.coalesce(F.sum("_nulls"), F.lit(0)),
        "unique": F.count_if(F.col("_rows") > 1),
    }
    counts = groups.agg(*(failures[t].cast("bigint").alias(f"{column}:{t}") for t in tests))
    return _as_rows(counts, model, [(column, t) for t in tests])


def _with_parents(
    rows: DataFrame, parents: Sequence[tuple[str, DataFrame, str]]
) -> tuple[DataFrame, list[str]]:
    """Left-join the distinct parent keys of each child column, marking what was found.

    One scan serves all child columns; an anti join each would read the child once per
    column.
    """
    for column, parent, key in parents:
        keys = parent.select(F.col(key).alias(f"_{column}")).distinct()
        rows = rows.join(keys, F.col(column) == F.col(f"_{column}"), "left")
    return rows, [column for column, _, _ in parents]


def relationships(
    rows: DataFrame, model: str, parents: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Counts non-null child keys without a parent, for each (column, parent, parent key)."""
    joined, columns = _with_parents(rows, parents)
    counts = joined.agg(
        *(
            F.count_if(F.col(c).isNotNull() & F.col(f"_{c}").isNull()).alias(f"{c}:relationships")
            for c in columns
        )
    )
    return _as_rows(counts, model, [(c, "relationships") for c in columns])


def _fact_parents(star: Star) -> list[tuple[str, DataFrame, str]]:
    dims = star.dims
    return [
        ("date_id", dims.date, "date_id"),
        ("time_id", dims.time_of_day, "time_id"),
        ("type_id", dims.type, "type_id"),
        ("ba_id", dims.ba, "ba_id"),
        ("related_ba_id", dims.ba, "ba_id"),
    ]


def fact_checks(star: Star) -> DataFrame:
    """All ten checks of the fact in one pass."""
    joined, columns = _with_parents(star.fact, _fact_parents(star))
    counts = joined.agg(
        *(F.count_if(F.col(c).isNull()).alias(f"{c}:not_null") for c in columns),
        *(
            F.count_if(F.col(c).isNotNull() & F.col(f"_{c}").isNull()).alias(f"{c}:relationships")
            for c in columns
        ),
    )
    tests = [(c, t) for t in ("not_null", "relationships") for c in columns]
    return _as_rows(counts, "fct_grid_operation", tests)


def _keys(
    staged: dict[str, DataFrame], star: Star
) -> list[tuple[DataFrame, str, str, Sequence[str]]]:
    """Tables with a key of their own, as (rows, model, key column, what the key is made of)."""
    dims = star.dims
    return [
        *((staged[name], name, "id", feed.key) for name, feed in FEEDS.items()),
        (dims.ba, "dim_ba", "ba_id", ()),
        (dims.date, "dim_date", "date_id", ()),
        (dims.time_of_day, "dim_time_of_day", "time_id", ()),
        (dims.type, "dim_type", "type_id", ()),
    ]


def _other_not_null(unified: DataFrame, star: Star) -> list[DataFrame]:
    """Not-null checks of columns that are neither a key nor in the fact."""
    return [
        not_null(unified, "int_grid_data_unioned", UNIFIED_COLUMNS[:-1]),
        not_null(star.dims.ba, "dim_ba", ["ba_code"]),
    ]


def not_null_checks(staged: dict[str, DataFrame], unified: DataFrame, star: Star) -> DataFrame:
    return _stacked(
        [
            *(not_null(rows, model, [key]) for rows, model, key, _ in _keys(staged, star)),
            *_other_not_null(unified, star),
            not_null(star.fact, "fct_grid_operation", [c for c, _, _ in _fact_parents(star)]),
        ]
    )


def unique_checks(staged: dict[str, DataFrame], star: Star) -> DataFrame:
    return _stacked([unique(rows, model, key, by) for rows, model, key, by in _keys(staged, star)])


def relationship_checks(star: Star) -> DataFrame:
    return relationships(star.fact, "fct_grid_operation", _fact_parents(star))


def report(staged: dict[str, DataFrame], unified: DataFrame, star: Star) -> DataFrame:
    """All 30 checks, each table grouped or scanned once."""
    return _stacked(
        [
            *(key_checks(rows, model, key, by=by) for rows, model, key, by in _keys(staged, star)),
            *_other_not_null(unified, star),
            fact_checks(star),
        ]
    )


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).select(*REPORT_COLUMNS)
