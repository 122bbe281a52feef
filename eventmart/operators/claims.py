"""One writer at a time: a claim file beside the merge log, created only where there is none.

File systems that create a file exclusively (HDFS, local disks) refuse the second of two writers; on object stores
without that, writers must be kept apart by other means.  A writer that died leaves its claim
behind: it lapses after ``LAPSE_HOURS``, and ``release_claim`` removes it at once.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from eventmart.layout import Table

LAPSE_HOURS = 6.0  # longer than any merge is meant to take


class TableClaimed(RuntimeError):
    """Another writer is at work on the table."""


@contextmanager
def claimed(spark: SparkSession, table: Table) -> Iterator[None]:
    """Hold the table's claim; raises ``TableClaimed`` where another writer holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.log_path}_claim")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not _create(files, path, spark.sparkContext.applicationId):
        age = time.time() - files.getFileStatus(path).getModificationTime() / 1000 if files.exists(path) else 0.0
        if age > LAPSE_HOURS * 3600:
            files.delete(path, False)
        if not _create(files, path, spark.sparkContext.applicationId):
            raise TableClaimed(f"{table.name}: claimed by another writer for {age / 60:.0f} minutes ({path.toString()})")
    try:
        yield
    finally:
        files.delete(path, False)


def release_claim(spark: SparkSession, table: Table) -> None:
    """Remove the claim of a writer that is known to be dead."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.log_path}_claim")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def _create(files, path, owner: str) -> bool:
    try:
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if files.exists(path):
            return False
        raise error
    stream.writeBytes(owner)
    stream.close()
    return True
