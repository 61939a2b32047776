"""Stored Parquet tables, by folder or by catalog name."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

_OVERWRITE = "partitionOverwriteMode"
_OVERWRITE_SETTING = "spark.sql.sources.partitionOverwriteMode"
_MODE_LOCK = threading.Lock()


@dataclass(frozen=True)
class Table:
    """A Parquet table with a known schema and at most one partition column.

    ``target`` is a folder if it holds a slash, else a name in the session's catalog.
    With years of days in a metastore, the catalog form spares the driver from listing
    every file of every day before pruning.
    """

    target: str
    schema: T.StructType
    partition: str | None = None

    @property
    def in_catalog(self) -> bool:
        return "/" not in self.target

    def read(self, spark: SparkSession) -> DataFrame:
        if self.in_catalog:
            return spark.table(self.target)
        return spark.read.schema(self.schema).parquet(self.target)

    def read_if_any(self, spark: SparkSession) -> DataFrame | None:
        """The table, or None where it does not exist yet; other errors are raised."""
        if self.in_catalog:
            return self.read(spark) if spark.catalog.tableExists(self.target) else None
        try:
            return self.read(spark)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.fieldNames())

    def _save(self, writer: DataFrameWriter) -> None:
        if self.partition is not None:
            writer = writer.partitionBy(self.partition)
        if self.in_catalog:
            writer.format("parquet").saveAsTable(self.target)
        else:
            writer.parquet(self.target)

    def append(self, rows: DataFrame) -> None:
        self._save(self._ordered(rows).write.mode("append"))

    def replace(self, rows: DataFrame) -> None:
        """Write the rows beside the table and put them in its place once they are complete.

        A run that fails leaves the table as it was. Folders change places; in a catalog, where
        a renamed table can lose sight of its partitions, the stored rows are copied.
        """
        spark = rows.sparkSession
        mark = uuid.uuid4().hex
        fresh = replace(self, target=f"{self.target}__new_{mark}")
        fresh._save(self._ordered(rows).write.mode("errorifexists"))
        if self.in_catalog:
            self._save(fresh.read(spark).write.mode("overwrite"))
            spark.sql(f"DROP TABLE {fresh.target}")
            return
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())
        target, new, old = (path(p) for p in (self.target, fresh.target, f"{self.target}__old_{mark}"))
        had_one = files.exists(target)
        if had_one and not files.rename(target, old):
            raise OSError(f"cannot move {self.target}")
        if not files.rename(new, target):
            if had_one:
                files.rename(old, target)
            raise OSError(f"cannot move {fresh.target}")
        if had_one:
            files.delete(old, True)
        spark.catalog.refreshByPath(self.target)

    def replace_partitions(self, rows: DataFrame) -> None:
        """Overwrite the partitions the rows belong to and leave all others alone."""
        writer = self._ordered(rows).write.mode("overwrite")
        if not self.in_catalog:
            self._save(writer.option(_OVERWRITE, "dynamic"))
            return
        # Inserts into catalog tables take the mode from the session, not from the writer. Only one
        # of a session's threads at a time may set it, else one could restore another's mode early.
        conf = rows.sparkSession.conf
        with _MODE_LOCK:
            before = conf.get(_OVERWRITE_SETTING)
            conf.set(_OVERWRITE_SETTING, "dynamic")
            try:
                writer.insertInto(self.target)
            finally:
                conf.set(_OVERWRITE_SETTING, before)
