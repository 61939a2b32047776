"""Join shapes that stay safe when the large side is skewed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_all_small(
    small: DataFrame, large: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """``small LEFT JOIN large`` for a small left side and a large, maybe skewed right side.

    ``small`` must be unique on ``keys``. A plain left join could neither broadcast the
    small side nor split a hot key of the large one, so the result is put together from
    an inner join, which can do both, and the small rows whose key the large side lacks.
    Columns in ``null_safe`` match null with null.
    """
    added = [c for c in large.columns if c not in keys]
    renamed = large.select(*(F.col(k).alias(f"_{k}") for k in keys), *added)
    on = reduce(
        and_,
        (
            F.col(k).eqNullSafe(F.col(f"_{k}")) if k in null_safe else F.col(k) == F.col(f"_{k}")
            for k in keys
        ),
    )
    matched = renamed.join(small, on, "inner").select(*small.columns, *added)
    present = (
        renamed.groupBy(*(f"_{k}" for k in keys))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .select(*(f"_{k}" for k in keys))
    )
    alone = small.join(present, on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
