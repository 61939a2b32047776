"""What the corpus operators share: column choice, working tables, code for the workers."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gridmart
from gridmart.session import new_table_path

# A word is a run of characters other than these; everything here counts words alike.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000

_shipped: set[str] = set()


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: evaluated once, no lineage left."""
    path = new_table_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def settled(frame: DataFrame, name: str) -> DataFrame:
    """``stored``, for queries of many such steps: Spark drops the broadcasts, plans and shuffle files of a step that is
    over when the driver collects its garbage. The hint makes that happen after each step, not once its heap is full."""
    frame = stored(frame, name)
    frame.sparkSession.sparkContext._jvm.System.gc()
    return frame


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, whatever folder the driver was started in."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(gridmart.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="gridmart-code-"), "gridmart.zip")
    with open(path, "wb") as target:
        target.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


_state: dict[object, object] = {}


def worker_state(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: that of the operator it last worked for."""
    if key not in _state:
        _state.clear()
        _state[key] = make()
    return _state[key]


def map_batches(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    spark = frame.sparkSession
    ship_package(spark)
    # Whole texts are long rows: fewer of them at a time bound what a worker holds.
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return frame.mapInArrow(function, schema)


def id_and_text(frame: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the two columns an operator reads, so that no other column can clash with its own."""
    return frame.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
