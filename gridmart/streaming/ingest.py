"""Landed files as a stream."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmart.functions.parsing import hour_period
from gridmart.operators.cleaning import readable
from gridmart.schemas import Feed
from gridmart.sources.landing import landed_schema, read_landed
from gridmart.sources.staging import append_new
from gridmart.sources.tables import Table

# Longer than the longest lag between an observation and its publication.
REPEATS_WITHIN = "3 days"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed_stream(
    spark: SparkSession,
    root: str,
    feed: Feed,
    max_files_per_trigger: int | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """Landed files as they arrive; ``newest_first`` serves a backlog from its end."""
    reader = spark.readStream.schema(landed_schema(feed)).option("latestFirst", newest_first)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{root}/{feed.route}").drop("day")


def start_append(
    raw: DataFrame, table: Table, feed: Feed, checkpoint: str, kept: bool = False
) -> StreamingQuery:
    """Append unseen rows of every micro-batch, then stop when the input is used up.

    Repeats are found among the stored days of a micro-batch, not in a bounded state, so a
    row is stored once however late it comes. A micro-batch that is replayed after a failure
    finds its rows stored and adds none. ``kept`` computes each micro-batch once for the append's several passes,
    as a stateful one has to be.
    """

    def append(batch: DataFrame, _: int) -> None:
        if kept:
            batch.persist()
        try:
            append_new(batch.sparkSession, batch, table, feed)
        finally:
            if kept:
                batch.unpersist()

    return (
        raw.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def _state_on_disk(spark: SparkSession):
    """State of queries started in this block is kept by RocksDB instead of in memory."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before)


def without_repeats(raw: DataFrame, feed: Feed, within: str = REPEATS_WITHIN) -> DataFrame:
    """Readable rows of a stream, equal ones once.

    The state holds the rows of the last ``within`` of observation time. Rows older than that are not
    let through; ``older_rows`` finds them. Rows that differ in a label alone stay apart, so that
    the append chooses among them whatever their order.
    """
    rows = readable(raw, feed).withWatermark("_hour", within)
    return rows.dropDuplicatesWithinWatermark(list(feed.raw_columns)).drop("_hour")


def older_rows(raw: DataFrame, feed: Feed, table: Table, within: str = REPEATS_WITHIN) -> DataFrame:
    """Readable rows that lie more than ``within`` before the last stored observation.

    Every row that ``without_repeats`` let through is stored by then, so that what it held back as late is
    among these.
    """
    last = table.read(raw.sparkSession).agg(F.max("period")).first()[0]
    rows = readable(raw, feed)
    if last is None:
        return rows.drop("_hour").filter(F.lit(False))
    return rows.filter(F.col("_hour") < F.lit(last) - F.expr(f"INTERVAL {within}")).drop("_hour")


def _backlog_start(spark: SparkSession, root: str, feed: Feed, table: Table) -> datetime | None:
    """Where nothing is stored yet, the last landed observation: a backlog has no watermark in its first micro-batch, and
    would go through the state as a whole."""
    if table.read_if_any(spark) is not None:
        return None
    return readable(read_landed(spark, root, feed), feed).agg(F.max("_hour")).first()[0]


def start_deduplicated(raw: DataFrame, table: Table, feed: Feed, checkpoint: str) -> StreamingQuery:
    """As ``start_append``, with repeats inside the watermark dropped before the append sees them."""
    with _state_on_disk(raw.sparkSession):
        return start_append(without_repeats(raw, feed), table, feed, checkpoint, kept=True)


def append_deduplicated(
    spark: SparkSession,
    root: str,
    table: Table,
    feed: Feed,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    newest_first: bool = False,
) -> StreamingQuery:
    """All newly landed files, and then the rows among them that came too late for the state.

    Each pass has its own progress under ``checkpoint``. Both append by comparing with what is stored, so that no
    row is lost or stored twice, however late it comes and wherever a pass was cut off. Returns the
    first pass, finished. Of a backlog, the first pass takes the rows near its last observation; no second pass
    has been over its files, so that the one to come finds all others among its own.
    """
    landed = landed_stream(spark, root, feed, max_files_per_trigger, newest_first)
    last = _backlog_start(spark, root, feed, table)
    if last is not None:
        landed = landed.filter(hour_period(F.col("period")) >= F.lit(last) - F.expr(f"INTERVAL {REPEATS_WITHIN}"))
    first = start_deduplicated(landed, table, feed, f"{checkpoint}/recent")
    first.awaitTermination()
    if table.read_if_any(spark) is not None:
        late = older_rows(landed_stream(spark, root, feed, max_files_per_trigger, newest_first), feed, table)
        start_append(late, table, feed, f"{checkpoint}/older").awaitTermination()
    return first
