"""Records beside a stored table: who may write to it now, and which of its days were touched.

Writers of a table take turns by numbered lease files, each created by one run only. The next number may be
taken once the last one was given back or has outlived its time, so that a run that died blocks the others
no longer than that. Files are made and listed by the driver; the store has to refuse to create a file that
exists (local folders and HDFS do, object stores where their connector creates conditionally).
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from gridmart.sources.tables import Table

LEASE_SECONDS = 6 * 3600.0
WAIT_SECONDS = 12 * 3600.0
_POLL_SECONDS = 0.5


class LeaseLost(RuntimeError):
    """Another run has taken the table over."""


def control_folder(spark: SparkSession, table: Table) -> str:
    if table.in_catalog:
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.target}__control"
    return f"{table.target.rstrip('/')}__control"


class _Folder:
    """Small files in a folder that all drivers share."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._root = self._path(path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())
        whole = self._files.makeQualified(self._root).toUri()
        self._local = whole.getPath() if whole.getScheme() == "file" else None

    def create(self, name: str) -> bool:
        """Whether this call made the file; False where it existed."""
        if self._local is not None:
            os.makedirs(self._local, exist_ok=True)
            try:
                os.close(os.open(f"{self._local}/{name}", os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        target = self._path(self._root, name)
        try:
            self._files.create(target, False).close()
        except Py4JJavaError:
            if self._files.exists(target):
                return False
            raise
        return True

    def names(self) -> dict[str, float]:
        """The files and when they were made, in seconds."""
        if not self._files.exists(self._root):
            return {}
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._files.listStatus(self._root)}

    def delete(self, name: str) -> None:
        self._files.delete(self._path(self._root, name), True)


def _lease(number: int) -> str:
    return f"lease-{number:012d}"


def _free(number: int) -> str:
    return f"free-{number:012d}"


def _last(names: Iterable[str]) -> int:
    return max((int(name.rpartition("-")[2]) for name in names if name.startswith("lease-")), default=0)


def _take(folder: _Folder, expires: float, wait: float) -> int:
    until = time.monotonic() + wait
    while True:
        names = folder.names()
        last = _last(names)
        if not last or _free(last) in names or time.time() - names[_lease(last)] > expires:
            if folder.create(_lease(last + 1)):
                # A run with an old listing may have made a number that was used and cleared before.
                if _last(folder.names()) == last + 1:
                    for name in names:
                        if name not in (_lease(last), _free(last)):
                            folder.delete(name)
                    return last + 1
                folder.delete(_lease(last + 1))
        if time.monotonic() >= until:
            raise TimeoutError("another run holds the table")
        time.sleep(_POLL_SECONDS)


class Lease:
    def __init__(self, folder: _Folder, number: int):
        self._folder = folder
        self._number = number

    def check(self) -> None:
        """Raises where the lease has expired and someone else has taken the next one."""
        if _last(self._folder.names()) != self._number:
            raise LeaseLost("the lease has expired and the table is another run's")


@contextmanager
def exclusive(
    spark: SparkSession, table: Table, expires: float = LEASE_SECONDS, wait: float = WAIT_SECONDS
) -> Iterator[Lease]:
    """Hold the table's lease: other runs on it wait until this block ends, ``wait`` seconds at most.

    ``expires`` has to be longer than the longest run takes; after that time others may go on.
    """
    folder = _Folder(spark, f"{control_folder(spark, table)}/lease")
    number = _take(folder, expires, wait)
    try:
        yield Lease(folder, number)
    finally:
        folder.create(_free(number))


class ChangeLog:
    """Days of a table that were touched since its readers last caught up.

    A run writes down the days it may touch before it writes rows, and those it did touch afterwards. A run that dies
    in between leaves the first list, which is the larger one, so that no change is missed. Null stands
    for all days. Entries go once what depends on them has been rebuilt.
    """

    _SCHEMA = "day date, entry string, kind string"

    def __init__(self, spark: SparkSession, table: Table):
        self._spark = spark
        self._root = f"{control_folder(spark, table)}/changes"

    def _write(self, entry: str, kind: str, days: Iterable[date | None]) -> None:
        rows = self._spark.createDataFrame([(day,) for day in days], "day date").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self._root}/entry={entry}/kind={kind}")

    def begin(self, days: Iterable[date | None]) -> str:
        entry = uuid.uuid4().hex
        self._write(entry, "intended", days)
        return entry

    def finish(self, entry: str, days: Iterable[date]) -> None:
        days = list(days)
        if days:
            self._write(entry, "changed", days)
        else:
            self.clear([entry])

    def pending(self) -> dict[str, set[date | None]]:
        """Days by entry; hold the table's lease, so that no run is under way."""
        try:
            rows = self._spark.read.schema(self._SCHEMA).parquet(self._root).collect()  # days of the open entries
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        days: dict[str, dict[str, set]] = {}
        for row in rows:
            days.setdefault(row["entry"], {}).setdefault(row["kind"], set()).add(row["day"])
        return {entry: kinds.get("changed", kinds.get("intended", set())) for entry, kinds in days.items()}

    def clear(self, entries: Iterable[str]) -> None:
        folder = _Folder(self._spark, self._root)
        for entry in entries:
            folder.delete(f"entry={entry}")
