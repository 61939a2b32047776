"""Append-only staged tables, partitioned by observation day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.keys import content_id
from gridmart.operators.cleaning import clean
from gridmart.operators.dedup import (
    KEY_HASH,
    distinct_observations,
    unseen,
    with_content_id,
    with_key_hash,
)
from gridmart.schemas import Feed
from gridmart.sources.control import ChangeLog, exclusive
from gridmart.sources.tables import Table

# Batches of at most so many rows send the hashes of their keys (8 bytes each) to the stored days.
SMALL_BATCH_ROWS = 200_000
# Appends to at most so many days tell the days that gained rows; others name all days of the batch.
COUNTED_DAYS = 200


def staged_table(target: str, feed: Feed) -> Table:
    return Table(target, feed.staged_schema, "day")


def existing_ids(spark: SparkSession, table: Table) -> DataFrame:
    return table.read(spark).select("id")


def stage(raw: DataFrame, feed: Feed) -> DataFrame:
    """Raw rows to staged rows: cleaned, one per key, with content id."""
    return with_content_id(distinct_observations(clean(raw, feed), feed), feed)


class BatchProfile(NamedTuple):
    """The observation days of the rows that would be staged, and the number of these rows, copies included."""

    days: list[date]
    rows: int


def batch_profile(raw: DataFrame, feed: Feed) -> BatchProfile:
    counts = clean(raw, feed).groupBy(F.to_date("period").alias("day")).count().collect()  # a row per day
    return BatchProfile(sorted(row["day"] for row in counts), sum(row["count"] for row in counts))


def batch_days(raw: DataFrame, feed: Feed) -> list[date]:
    """Observation days of the rows that would be staged, one each."""
    return batch_profile(raw, feed).days


def stored_candidates(raw: DataFrame, stored: DataFrame, feed: Feed, profile: BatchProfile) -> DataFrame:
    """The stored rows that rows of the batch can equal, with their key hash.

    The key holds the period, so only the stored days that the batch has can match; the list of
    them prunes the stored partitions to these, whatever the table has grown to and however
    far apart they lie. A small batch also sends its key hashes to the scan: of a day with a billion
    rows, one late row then shuffles those of its own hash. Its size is counted before.
    """
    near = with_key_hash(stored.filter(F.col("day").isin(profile.days)), feed)
    if profile.rows <= SMALL_BATCH_ROWS:
        hashes = with_key_hash(clean(raw, feed), feed).select(KEY_HASH)
        near = near.join(F.broadcast(hashes), KEY_HASH, "left_semi")
    return near


def _unseen_observations(
    raw: DataFrame,
    stored: DataFrame | None,
    feed: Feed,
    profile: BatchProfile | None,
    rejected: Observation | None = None,
) -> DataFrame:
    """Cleaned rows that are not stored yet, one per key, with their ``day``.

    The id is a hash of the key columns, so the join compares those: they are a fraction
    of the bytes of the hashed ids, and the batch is already partitioned by them.
    """
    batch = distinct_observations(clean(raw, feed, rejected), feed, keep_hash=True)
    if stored is not None:
        near = stored_candidates(raw, stored, feed, profile or batch_profile(raw, feed))
        batch = unseen(batch, near, (KEY_HASH, *feed.key))
    return batch.withColumn("day", F.to_date("period"))


def new_rows(raw: DataFrame, stored: DataFrame | None, feed: Feed) -> DataFrame:
    """Staged form of the raw rows that are not stored yet."""
    return with_content_id(_unseen_observations(raw, stored, feed, None), feed)


def append_new(
    spark: SparkSession,
    raw: DataFrame,
    table: Table,
    feed: Feed,
    rejected: Observation | None = None,
) -> None:
    """Append the rows not stored yet; running a batch again appends nothing.

    That also makes a retried or half-finished run safe to repeat. Runs on one table take turns: the next one
    looks for stored rows only when this one is done. Before rows are written the batch's days go to the
    table's change log (all days where the table is new), afterwards those that gained rows. Ids are added last, so
    that the shuffle and sort for the file layout do not carry them. An ``Observation``
    counts the rows that cleaning drops, in the same pass.
    """
    with exclusive(spark, table) as lease:
        stored = table.read_if_any(spark)
        profile = None if stored is None else batch_profile(raw, feed)
        log = ChangeLog(spark, table)
        entry = log.begin([None] if profile is None else profile.days)
        rows = _unseen_observations(raw, stored, feed, profile, rejected)
        gained = Observation()
        counted = [] if profile is None or len(profile.days) > COUNTED_DAYS else profile.days
        if counted:
            rows = rows.observe(gained, *[F.count_if(F.col("day") == day).alias(str(day)) for day in counted])
        laid_out = rows.hint("rebalance", "day").sortWithinPartitions("day", "period")
        lease.check()
        table.append(laid_out.withColumn("id", content_id(feed.key)))
        if profile is not None and len(profile.days) == len(counted):
            log.finish(entry, _gained(gained, counted))


def _gained(counts: Observation, days: Sequence[date]) -> list[date]:
    """The days that gained rows; all where the append's own pass was planned away."""
    if not days:
        return []
    try:
        return [day for day in days if counts.get[str(day)]]
    except (Py4JJavaError, KeyError):
        return list(days)
