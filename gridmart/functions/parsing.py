"""Text to typed values; anything unreadable becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD_FORMAT = "yyyy-MM-dd'T'HH"  # how a period is written

# Digits with a decimal point, optional sign, blanks around.
_DECIMAL_TEXT = r"^\s*[+-]?(\d+\.\d*|\.\d+)\s*$"


def hour_period(text: Column) -> Column:
    """``2024-01-01T05`` to a timestamp.

    The shape is checked by pattern and the value by the cast, which is about half the
    work of a formatter; it matters because Catalyst evaluates it once to filter rows
    and once more to project them.
    """
    return F.when(
        text.rlike(r"^\d{4}-\d\d-\d\dT\d\d$"), F.concat(text, F.lit(":00")).try_cast("timestamp")
    )


def whole_number(text: Column) -> Column:
    """Text to int, cutting decimals off (``12.7`` is 12).

    The plain cast takes nearly all rows; only text it refuses reaches the slower
    decimal route.
    """
    cut = F.trim(text).try_cast("decimal(38,18)").try_cast("int")
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(_DECIMAL_TEXT), cut))


def as_text(column: Column, data_type: T.DataType) -> Column:
    """Any landed type to the text the raw schema uses.

    Floats go through decimal so that 1.0E7 does not end up in exponent form.
    """
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        column = column.try_cast("decimal(38,18)")
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, PERIOD_FORMAT)
    return column.cast("string")
