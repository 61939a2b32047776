"""One row per observation, within a batch and against what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.keys import content_id
from gridmart.schemas import Feed


KEY_HASH = "_key_hash"


def with_key_hash(rows: DataFrame, feed: Feed) -> DataFrame:
    """A hash ahead of the key columns, so that sorts by the key compare one long first.

    Rows are never matched by the hash alone; it always goes with the key itself.
    """
    return rows.withColumn(KEY_HASH, F.xxhash64(*feed.key))


def distinct_observations(cleaned: DataFrame, feed: Feed, keep_hash: bool = False) -> DataFrame:
    """Keep one row per key.

    Copies are merged before the shuffle (partial aggregation), so a heavily repeated
    row costs one row per task. Where copies differ in their labels the smallest label
    tuple wins, whatever the row order. Grouping by the key instead of the id lets
    filters on period and codes pass below the aggregate, and drops the label
    handling altogether when no label is read.
    """
    kept = [*cleaned.columns, KEY_HASH] if keep_hash else cleaned.columns
    return (
        with_key_hash(cleaned, feed)
        .groupBy(KEY_HASH, *feed.key)
        .agg(F.min(F.struct(*feed.attributes)).alias("_labels"))
        .select("*", "_labels.*")
        .select(*kept)
    )


def with_content_id(rows: DataFrame, feed: Feed) -> DataFrame:
    return rows.withColumn("id", content_id(feed.key)).select(*feed.staged_columns)


def unseen(batch: DataFrame, stored: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Batch rows whose key is not stored yet.

    Stored keys are made distinct first, which keeps a key stored many times from piling
    up in one join task. Grouping keeps the key order (``distinct`` does not), so the
    join finds both sides partitioned alike and adds no shuffle of its own.
    """
    present = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).select(*keys)
    return batch.join(present, list(keys), "left_anti")
