"""High-water marks and the incremental filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant, ntz
from eventmart.layout import Table
from eventmart.operators.merge_log import certain_stamp, last_merged_stamp, touched_since
from eventmart.operators.upsert import in_buckets
from eventmart.sources.tables import read_if_exists, read_stored

# Mark of a table that is absent or empty.
START = dt.datetime(1970, 1, 1)


def high_water_mark(
    spark: SparkSession, table: Table, column: str = "ingested_at"
) -> dt.datetime:
    """The latest stamp in ``table``; ``START`` if it is absent or empty.

    Where the merge log alone proves the latest stamp, the table is not read.  Otherwise (rows were replaced
    since that stamp came in, or there is no log) rows from the latest logged stamp on are tried
    first, which skips all older row groups.  Only a missing path means a full load; any other read
    error propagates.
    """
    if column == "ingested_at":
        stamp = certain_stamp(spark, table)
        if stamp is not None:
            return stamp
    df = read_if_exists(spark, table)
    if df is None:
        return START
    latest = None
    logged = last_merged_stamp(spark, table) if column == "ingested_at" else None
    if logged is not None:
        latest = df.filter(F.col(column) >= ntz(logged)).agg(F.max(column)).first()[0]
    if latest is None:
        latest = df.agg(F.max(column)).first()[0]
    return latest or START


def newer_than(df: DataFrame, mark: Instant | None, column: str = "ingested_at") -> DataFrame:
    """Rows stamped strictly after ``mark``; all rows where it is None.

    Rows stamped exactly at the mark are taken as loaded already, so batches
    must carry increasing stamps.
    """
    return df if mark is None else df.filter(F.col(column) > ntz(mark))


def newer_rows(spark: SparkSession, table: Table, mark: Instant) -> DataFrame:
    """``newer_than`` of a stored table, with its bucket column, reading only the buckets that merges since ``mark`` touched.

    The merge log knows them; where it does not (entries of older versions, rows written in another way
    before the first merge), all buckets are read.
    """
    rows = read_stored(spark, table)
    touched = touched_since(spark, table, mark)
    return newer_than(rows if touched is None else rows.filter(in_buckets(touched)), mark)
