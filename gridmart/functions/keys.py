"""Content id and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(key_columns: Sequence[str]) -> Column:
    """SHA-256 of the key columns joined by ``||``; needs a UTC session."""
    return F.sha2(F.concat_ws("||", *(F.col(c) for c in key_columns)), 256)


def date_key(moment: Column) -> Column:
    """yyyymmdd as int, by arithmetic rather than formatting and parsing text."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)
