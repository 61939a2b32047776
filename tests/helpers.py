"""Small raw feeds for hand-made cases."""

from __future__ import annotations

from gridmart.schemas import FUEL_TYPE, INTERCHANGE, REGION

MWH = "megawatthours"


def region(spark, *rows):
    """Rows of (period, respondent, type, value)."""
    return spark.createDataFrame(
        [(p, r, f"{r} name", t, f"{t} name", v, MWH) for p, r, t, v in rows], REGION.raw_schema
    )


def fuel(spark, *rows):
    return spark.createDataFrame(
        [(p, r, f"{r} name", t, f"{t} name", v, MWH) for p, r, t, v in rows], FUEL_TYPE.raw_schema
    )


def interchange(spark, *rows):
    return spark.createDataFrame(
        [(p, f, f"{f} name", t, f"{t} name", v, MWH) for p, f, t, v in rows],
        INTERCHANGE.raw_schema,
    )


def authorities(spark, *rows):
    """Rows of (id, code, region, active, latitude, longitude) plus the Unknown member."""
    from gridmart.schemas import AUTHORITY_SEED_COLUMNS

    full = [
        (str(i), c, f"{c} name", "Central", r[:3], r, "No", "No", "Yes", a, "1900-01-01", "9999-12-31",
         None if la is None else str(la), None if lo is None else str(lo))
        for i, c, r, a, la, lo in rows
    ]
    unknown = ("-1", *["Unknown"] * 9, "1900-01-01", "9999-12-31", None, None)
    schema = ", ".join(f"`{c}` string" for c in AUTHORITY_SEED_COLUMNS)
    return spark.createDataFrame([*full, unknown], schema)


def rows_of(frame, *columns):
    return sorted(tuple(r[c] for c in columns or frame.columns) for r in frame.collect())


def final_plan(frame):
    return frame._jdf.queryExecution().toString()
