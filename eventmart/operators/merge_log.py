"""The log of merges: their states and counts, and an index of the buckets that each of them touched.

Every merge logs the buckets its rows went to and their ingest stamps.  A row stamped after a mark came in
with a merge whose latest stamp is after the mark, and its bucket never changes, so the log
tells which partitions an incremental read needs, and what the latest stamp is, without opening the table.
Rows that reach a table in another way than by a merge are not in the index.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant, ntz
from eventmart.layout import Table

LOG_DDL = (
    "run string, state string, buckets int, null_safe boolean, rows_inserted bigint, "
    "rows_updated bigint, last_stamp timestamp_ntz, logged_at timestamp, touched array<int>, "
    "replaced array<string>"
)
PREPARED, MERGED = "prepared", "merged"


class MergeCounts(NamedTuple):
    """Source rows that were inserted and source rows that replaced a row."""

    rows_inserted: int
    rows_updated: int


class Merge(NamedTuple):
    """What the log keeps of a merge.

    ``last_stamp`` is the batch's latest ``ingested_at``, ``touched`` the buckets its rows went to, and ``replaced`` the
    files, below the table's path, that its files stand for.
    """

    run: str
    null_safe: bool
    counts: MergeCounts
    last_stamp: dt.datetime | None
    touched: list[int]
    replaced: list[str]


def read_log(spark: SparkSession, table: Table) -> DataFrame | None:
    """All entries, or None before the first merge; entries of older versions lack the newer columns.

    There are two small ones for each merge: one task reads them, which saves the shuffles.
    """
    try:
        return spark.read.schema(LOG_DDL).parquet(table.log_path).coalesce(1)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_log(spark: SparkSession, table: Table, merge: Merge, state: str) -> None:
    """Append one entry; the lists are kept with the first entry of a merge only."""
    first = state == PREPARED
    stamp = F.lit(None) if merge.last_stamp is None else ntz(merge.last_stamp)

    def listed(values: list, kind: str) -> Column:  # one literal, however many values
        known = F.split(F.lit(",".join(map(str, values))), ",") if values else F.array()
        return (known if first else F.lit(None)).cast(f"array<{kind}>")

    (
        spark.range(0, 1, 1, 1)
        .select(
            F.lit(merge.run).alias("run"),
            F.lit(state).alias("state"),
            F.lit(table.buckets).cast("int").alias("buckets"),
            F.lit(merge.null_safe).alias("null_safe"),
            F.lit(merge.counts.rows_inserted).cast("bigint").alias("rows_inserted"),
            F.lit(merge.counts.rows_updated).cast("bigint").alias("rows_updated"),
            stamp.cast("timestamp_ntz").alias("last_stamp"),
            F.current_timestamp().alias("logged_at"),
            listed(merge.touched, "int").alias("touched"),
            listed(merge.replaced, "string").alias("replaced"),
        )
        .write.mode("append")
        .parquet(table.log_path)
    )


def merge_log(spark: SparkSession, table: Table) -> DataFrame:
    """The completed merges of ``table`` with their row counts."""
    return (
        spark.read.schema(LOG_DDL)
        .parquet(table.log_path)
        .filter(F.col("state") == MERGED)
        .select("run", "rows_inserted", "rows_updated", "logged_at")
    )


def last_merged_stamp(spark: SparkSession, table: Table) -> dt.datetime | None:
    """The latest ``ingested_at`` that any merge brought, from the log alone."""
    log = read_log(spark, table)
    return None if log is None else log.agg(F.max("last_stamp")).first()[0]


def certain_stamp(spark: SparkSession, table: Table) -> dt.datetime | None:
    """The latest ``ingested_at`` in the table, if the log alone proves it; else None.

    The latest stamp that any merge brought is still there unless a later merge replaced rows.
    """
    log = read_log(spark, table)
    if log is None:
        return None
    merges = log.groupBy("run").agg(
        F.max("last_stamp").alias("last_stamp"), F.max("rows_updated").alias("rows_updated"), F.min("logged_at").alias("at")
    )
    latest = F.max(F.struct(F.col("last_stamp"), F.col("at")))
    updates = F.max(F.when(F.col("rows_updated") > 0, F.col("at")))
    found = merges.agg(
        F.max_by("last_stamp", F.when(F.col("last_stamp").isNotNull(), F.struct("last_stamp", "at"))).alias("stamp"),
        (updates > latest["at"]).alias("shaken"),
    ).first()
    return None if found is None or found["shaken"] else found["stamp"]


def touched_since(spark: SparkSession, table: Table, mark: Instant) -> list[int] | None:
    """The buckets that may hold rows stamped after ``mark``; None where the log does not tell."""
    log = read_log(spark, table)
    if log is None:
        return None
    known = F.col("touched").isNotNull()
    merges = log.groupBy("run").agg(F.max("last_stamp").alias("last_stamp"), F.max("touched").alias("touched"))
    newer = merges.filter((F.col("last_stamp") > ntz(mark)) | (~known & F.col("last_stamp").isNull()))
    rows = newer.select(F.explode_outer("touched").alias("bucket")).distinct().collect()
    buckets = [row["bucket"] for row in rows]
    return None if None in buckets else sorted(buckets)
