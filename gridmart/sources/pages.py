"""Landed pages of the source interface: ``{"response": {"total": .., "data": [..]}}``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.schemas import Feed


def page_schema(feed: Feed) -> T.StructType:
    response = T.StructType(
        [
            T.StructField("total", T.StringType()),
            T.StructField("data", T.ArrayType(feed.raw_schema)),
        ]
    )
    return T.StructType([T.StructField("response", response), T.StructField("day", T.DateType())])


def read_pages(spark: SparkSession, root: str, feed: Feed, multi_line: bool = False) -> DataFrame:
    """Pages under ``root/<route>/day=<run day>/``, one JSON document per line.

    Files holding one pretty-printed page each need ``multi_line``. ``request`` is what the page says it was asked
    for by, an object as its JSON text; null where it says nothing.
    """
    response, day = page_schema(feed)
    return (
        spark.read.schema(T.StructType([T.StructField("request", T.StringType()), response, day]))
        .option("multiLine", multi_line)
        .json(f"{root}/{feed.route}")
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """All records of all pages, one row each; pages that could not be read add none."""
    return pages.select(F.explode("response.data").alias("record")).select("record.*")


def page_completeness(
    pages: DataFrame, feed: Feed, expected: tuple[date, date] | None = None
) -> DataFrame:
    """Records collected against records announced, per run day.

    A request that fails midway leaves fewer rows than announced and no other trace. A page
    that was landed twice counts once: of pages that name their ``request`` those of the same one, in whatever
    order their records came, of others those with the same content. Days of the ``expected`` range (first, last)
    without a single page have a row too: nothing collected, nothing announced.
    """
    request = F.col("request") if "request" in pages.columns else F.lit(None).cast("string")
    content = F.when(request.isNull(), F.xxhash64(F.to_json("response")))
    one_each = pages.groupBy("day", request.alias("_request"), content.alias("_page")).agg(
        F.max(F.coalesce(F.array_size("response.data"), F.lit(0))).alias("_rows"),
        F.max(F.col("response.total").try_cast("bigint")).alias("_total"),
    )
    counts = one_each.groupBy("day").agg(
        F.sum("_rows").cast("bigint").alias("collected"), F.max("_total").alias("announced")
    )
    if expected is not None:
        first, last = (F.lit(day) for day in expected)
        days = pages.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
        counts = days.join(counts, "day", "full").withColumn(
            "collected", F.coalesce("collected", F.lit(0).cast("bigint"))
        )
    complete = F.col("announced").isNotNull() & (F.col("collected") == F.col("announced"))
    return counts.select(
        F.lit(feed.name).alias("feed"), "day", "collected", "announced", (~complete).alias("is_incomplete")
    )
