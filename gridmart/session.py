"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# The content id embeds the rendered period, so every job must render in UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Feeds are packed to a few bytes a row, so that a split of Spark's 128 MB would bring one task some 20 million rows to sort.
SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 16 << 20


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings the engine relies on onto a session the caller owns; smaller splits of files are left as they are."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if _bytes(spark, spark.conf.get(SPLIT_SETTING)) > SPLIT_BYTES:
        spark.conf.set(SPLIT_SETTING, SPLIT_BYTES)
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def build_session(
    app_name: str = "gridmart", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gridmart-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; a cluster session is
    refused, since a machine-local folder would be lost or unseen by other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def new_table_path(spark: SparkSession, name: str) -> str:
    """Unused path for a working table in the shared folder, under the application's id.

    Nothing is deleted here: another reader may still hold the table. What a finished
    application leaves is one folder, to be expired like other checkpoint data.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/gridmart/{application}/{name}-{uuid.uuid4().hex}"
