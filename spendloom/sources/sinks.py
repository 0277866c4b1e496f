"""Sinks: the ledger CSV and the preview."""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession

from spendloom.operators.normalise import sort_ledger, to_ledger
from spendloom.schema import LEDGER_HEADERS

#: Names, beside the ledger, of a new one that is being written and of the old one while they change places.
STAGING, OLD = ".staging-", ".old-"
_REFUSED = ("org.apache.hadoop.security.AccessControlException", "java.nio.file.AccessDeniedException", "java.nio.file.FileSystemException")


def ledger_csv_frame(ledger: DataFrame) -> DataFrame:
    """The ledger sorted (O1), projected to the CSV header captions."""
    return to_ledger(sort_ledger(ledger)).toDF(*LEDGER_HEADERS)


def write_ledger(ledger: DataFrame, path: str, now: _dt.datetime | None = None) -> str:
    """S3: write the sorted ledger as CSV with a header row; return the path.

    The target is replaced, as the original overwrites its output file. The
    job writes to a sibling of the target; only when it is whole do the two
    change places, by renaming. Until then readers see the old ledger, and a
    job that dies leaves it as it was. If the target may not be replaced,
    whether that shows beforehand or only when the files are renamed, the new
    ledger becomes the sibling ``<stem>_processed_<yyyyMMdd_HHmmss>`` and the
    old one stays; any other error is the caller's. Spark writes one part
    file per task (in sort order), each with the header; an empty ledger
    still yields a header-only file.
    """
    spark = ledger.sparkSession
    path = path.rstrip("/")
    recover_ledger(spark, path)
    staging = f"{path}{STAGING}{uuid.uuid4().hex}"
    ledger_csv_frame(ledger).write.option("header", True).csv(staging)
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    stem, ext = os.path.splitext(path)
    for target in (path, f"{stem}_processed_{stamp}{ext}"):
        if publish(spark, staging, target):
            return target
    raise PermissionError(f"neither {path} nor a file beside it may be written; the ledger is in {staging}")


def publish(spark: SparkSession, staging: str, target: str) -> bool:
    """Put the folder ``staging`` in the place of ``target``; False if that is refused, with both as they were."""
    if not writable(spark, target):
        return False
    files = _Files(spark, target)
    old = None
    if files.exists(target):
        old = f"{target}{OLD}{uuid.uuid4().hex}"
        if not files.renamed(target, old):
            return False
    done = False
    try:
        done = files.renamed(staging, target)
    finally:
        if old and not done:
            files.renamed(old, target)
    if old:
        files.delete(old)
    return done


def recover_ledger(spark: SparkSession, path: str) -> bool:
    """Bring back the old ledger of a publication that died between its two renames; True if there was one."""
    files = _Files(spark, path)
    if files.exists(path):
        return False
    left = files.beginning_with(f"{path}{OLD}")
    return bool(left) and files.renamed(max(left)[1], path)


class _Files:
    """The few file operations of a publication, on whatever file system holds the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def renamed(self, source: str, target: str) -> bool:
        """Rename to a name that is free; False if that is refused."""
        if self.exists(target):  # a rename would move the source into that folder
            return False
        try:
            return self.fs.rename(self._path(source), self._path(target))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getName() in _REFUSED:
                return False
            raise

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def beginning_with(self, prefix: str) -> list[tuple[int, str]]:
        """(time of change, path) of the files and folders whose path begins so."""
        at = self._path(prefix)
        if not self.fs.exists(at.getParent()):
            return []
        found = self.fs.listStatus(at.getParent())
        return [(f.getModificationTime(), f.getPath().toString()) for f in found if f.getPath().getName().startswith(at.getName())]


def writable(spark: SparkSession, path: str) -> bool:
    """Whether the file system lets this user replace ``path`` (or, if there is none yet, does not say no)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if fs.exists(target):
            fs.access(target, hadoop.fs.permission.FsAction.WRITE)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() in _REFUSED:
            return False
        raise
    return True


def preview(df: DataFrame, n: int = 10, show: bool = True) -> tuple[list[Row], int]:
    """The first ``n`` rows (in the frame's order) and the total count.

    Only ``n`` rows reach the driver.
    """
    head = df.limit(n).collect()
    total = df.count()
    if show:
        df.sparkSession.createDataFrame(head, df.schema).show(n, truncate=False)
        print(f"Total rows: {total}")
    return head, total
