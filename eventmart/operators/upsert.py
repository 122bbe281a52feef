"""Keyed upsert into bucketed Parquet tables.

Plain Parquet has no MERGE, so a batch is merged file by file:

1. The batch is written below the run's own work path, in the table's layout, so that it is computed once.
2. The key columns of the touched buckets are matched with the batch's keys; a match tells its file.
3. The rows of each file with a match that no batch key replaces are written to the work path as well.
4. The log says "prepared" and lists the files with a match.  From here on the merge can only be completed.
5. The new files are moved into the table and the listed files are deleted.

So an insert-only batch reads key columns and writes nothing but itself, and an
update rewrites the files that it hits, once.  Replacing the whole row is an update of every
non-key column.

The driver only sees one row of counts and key bounds per touched bucket, and one per file with a match.  Keys
are matched by a broadcast join when the batch's keys are below Spark's broadcast
threshold and by a sort-merge join (with AQE's skew handling) otherwise.  Writes
are rebalanced by bucket, which AQE splits by size: a bucket that holds much of
the table is still written by many tasks.

A claim (see ``claims``) keeps a second writer of a table out.  A concurrent reader may see some files
before and some after a merge.  Lost executors only cost retried tasks, since nothing in the table
changes before all new files are complete.  If the driver dies while files are moved, ``settle`` (called by every
upsert and every job) moves and deletes the rest: both steps can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import as_variant, ntz
from eventmart.layout import BUCKET, Table
from eventmart.operators.claims import claimed
from eventmart.operators.merge_log import (
    MERGED,
    PREPARED,
    Merge,
    MergeCounts,
    last_merged_stamp,
    merge_log,
    read_log,
    write_log,
)
from eventmart.sources.tables import add_partitions, read_if_exists

__all__ = ["DuplicateSourceKey", "Merge", "MergeCounts", "last_merged_stamp", "merge_batch", "merge_log", "settle", "upsert"]

ROWS, KEPT = "rows", "kept"  # parts of a run's work path
MOVERS = 16  # threads that move and delete files


class DuplicateSourceKey(ValueError):
    """Two source rows want to update the same target row."""


def upsert(batch: DataFrame, table: Table, null_safe: bool = False) -> MergeCounts:
    """Merge ``batch`` into ``table``: replace rows with an equal key, insert the rest.

    Keys compare with plain equality, so a row with a NULL key is always
    inserted; ``null_safe=True`` lets NULL keys match.  A batch without an
    ``ingested_at`` column is stamped with the current local time.  Raises
    ``DuplicateSourceKey``, before anything is changed, when a repeated source
    key matches a target row; repeated keys that match none are all inserted.
    """
    with claimed(batch.sparkSession, table):
        settle(batch.sparkSession, table)
        return merge_batch(batch, table, null_safe)


def merge_batch(batch: DataFrame, table: Table, null_safe: bool = False) -> MergeCounts:
    """``upsert`` for a caller that has claimed and settled the table already."""
    spark = batch.sparkSession
    run = uuid.uuid4().hex
    if "ingested_at" not in batch.columns:
        batch = batch.withColumn("ingested_at", F.localtimestamp())
    columns = {n: as_variant(batch, n) if k == "variant" else F.col(n).cast(k) for n, k in table.spec.columns.items()}
    rows = batch.select(*[column.alias(name) for name, column in columns.items()])
    _write(rows.withColumn(BUCKET, table.bucket()), table, _part(table, run, ROWS))

    touched = _profile(spark, table, run)
    if not touched:
        _forget(spark, table, run)
        return MergeCounts(0, 0)
    hits = _hits(spark, table, run, touched, null_safe)
    if any(hit["copies"] > 1 for hit in hits):
        _forget(spark, table, run)
        raise DuplicateSourceKey(
            f"{table.name}: source rows with the same {table.keys} match one target row"
        )
    total = sum(row["rows"] for row in touched)
    updated = sum(hit["rows"] for hit in hits)
    stamps = [row["last_stamp"] for row in touched if row["last_stamp"] is not None]
    replaced = sorted(f"{BUCKET}={hit[BUCKET]}/{hit['file']}" for hit in hits)
    merge = Merge(
        run,
        null_safe,
        MergeCounts(total - updated, updated),
        max(stamps, default=None),
        sorted(row[BUCKET] for row in touched),
        replaced,
    )
    if replaced:
        _write_kept(spark, table, run, replaced, null_safe)
    write_log(spark, table, merge, PREPARED)
    _publish(spark, table, run, replaced)
    write_log(spark, table, merge, MERGED)
    _forget(spark, table, run)
    return merge.counts


def settle(spark: SparkSession, table: Table) -> None:
    """Complete a merge that was prepared but, its driver lost, never finished.

    All its new files are complete: those that still wait are moved into the table, and the files they stand for
    are deleted.  So ``settle`` itself may be lost at any point and repeated.  What runs that died
    before they were prepared left below the work path is removed.
    """
    log = read_log(spark, table)
    if log is None:
        return
    # Any unfinished run first; there is at most one, since writers hold a claim.
    last = (
        log.groupBy("run", "buckets", "null_safe")
        .agg(
            F.count_if(F.col("state") == MERGED).alias("done"),
            F.max("rows_inserted").alias("rows_inserted"),
            F.max("rows_updated").alias("rows_updated"),
            F.max("last_stamp").alias("last_stamp"),
            F.max("touched").alias("touched"),
            F.max("replaced").alias("replaced"),
        )
        .orderBy("done")
        .first()
    )
    if last is None:
        return
    if last["buckets"] != table.buckets:
        raise ValueError(
            f"{table.name} holds rows in {last['buckets']} buckets, not {table.buckets}"
        )
    if not last["done"]:
        run = last["run"]
        if last["replaced"] is None or not _exists(spark, _part(table, run, ROWS)):
            raise ValueError(f"{table.name}: the files of unfinished merge {run} are gone")
        counts = MergeCounts(last["rows_inserted"], last["rows_updated"])
        _publish(spark, table, run, last["replaced"])
        merge = Merge(run, last["null_safe"], counts, last["last_stamp"], last["touched"], last["replaced"])
        write_log(spark, table, merge, MERGED)
    _forget(spark, table)


def _part(table: Table, run: str, part: str) -> str:
    return f"{table.stage_path}/{run}/{part}"


def _read_part(spark: SparkSession, table: Table, run: str, part: str) -> DataFrame:
    return spark.read.schema(table.stored_ddl).parquet(_part(table, run, part))


def _profile(spark: SparkSession, table: Table, run: str) -> list[Row]:
    """Row count, latest stamp and key bounds of the batch: one row per touched bucket."""
    bounds = [
        F.struct(F.min(key).alias("lo"), F.max(key).alias("hi")).alias(f"_bounds_{key}")
        for key in table.keys
    ]
    counts = [F.count("*").alias("rows"), F.max("ingested_at").alias("last_stamp")]
    try:
        return _read_part(spark, table, run, ROWS).groupBy(BUCKET).agg(*counts, *bounds).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _within_bounds(table: Table, touched: Sequence[Row], nulls: bool) -> Column:
    """Keys between the smallest and largest batch key: pushed to row-group statistics."""
    condition = F.lit(True)
    for key in table.keys:
        bounds = [row[f"_bounds_{key}"] for row in touched if row[f"_bounds_{key}"]["lo"] is not None]
        if not bounds:
            continue
        kind = table.spec.columns[key]
        lo, hi = min(b["lo"] for b in bounds), max(b["hi"] for b in bounds)
        lo, hi = (ntz(v) if kind == "timestamp_ntz" else F.lit(v).cast(kind) for v in (lo, hi))
        inside = F.col(key).between(lo, hi)
        condition = condition & ((inside | F.col(key).isNull()) if nulls else inside)
    return condition


def in_buckets(buckets: Iterable[int]) -> Column:
    """Whether a row's bucket is listed: a filter of partitions."""
    listed = sorted(buckets)
    return F.expr(f"{BUCKET} IN ({', '.join(map(str, listed))})") if listed else F.lit(False)


def _same_key(table: Table, null_safe: bool) -> Column:
    """Join condition of a target row ``t`` and a batch row ``s``."""
    condition = F.lit(True)
    for key in table.keys:
        t, s = F.col(f"t.{key}"), F.col(f"s.{key}")
        condition = condition & (t.eqNullSafe(s) if null_safe else t == s)
    return condition


def _hits(
    spark: SparkSession,
    table: Table,
    run: str,
    touched: Sequence[Row],
    null_safe: bool,
) -> list[Row]:
    """The table's files in which a batch key meets a row.

    Per file: the batch rows that match (a key that meets rows of several files counts in one of them), and
    the most rows of one such key.
    """
    target = read_if_exists(spark, table)
    if target is None:
        return []
    source = _read_part(spark, table, run, ROWS).groupBy(*table.keys).agg(F.count("*").alias("copies"))
    candidates = (
        target.filter(in_buckets(row[BUCKET] for row in touched))
        .filter(_within_bounds(table, touched, nulls=null_safe))
        .select(*table.keys, F.col("_metadata.file_name").alias("file"))
    )
    return (
        candidates.alias("t")
        .join(source.alias("s"), _same_key(table, null_safe), "inner")
        .select("s.*", "file")
        .groupBy(*table.keys)
        .agg(F.max("copies").alias("copies"), F.collect_set("file").alias("files"))
        .withColumn(BUCKET, table.bucket())
        .select(BUCKET, "copies", F.posexplode(F.sort_array("files")).alias("place", "file"))
        .groupBy(BUCKET, "file")
        .agg(F.sum(F.when(F.col("place") == 0, F.col("copies")).otherwise(0)).alias("rows"), F.max("copies").alias("copies"))
        .collect()
    )


def _write_kept(spark: SparkSession, table: Table, run: str, replaced: Sequence[str], null_safe: bool) -> None:
    """Write the rows of the files with a match that no batch key replaces."""
    stored = spark.read.schema(table.stored_ddl).option("basePath", table.path)
    kept = (
        stored.parquet(*[f"{table.path}/{file}" for file in replaced])
        .alias("t")
        .join(
            _read_part(spark, table, run, ROWS).select(*table.keys).alias("s"),
            _same_key(table, null_safe),
            "left_anti",
        )
    )
    _write(kept, table, _part(table, run, KEPT))


def _write(rows: DataFrame, table: Table, path: str) -> None:
    """Write in the table's layout; sorting by key within a file keeps row-group statistics narrow."""
    (
        rows.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, *table.keys)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def _publish(spark: SparkSession, table: Table, run: str, replaced: Sequence[str]) -> None:
    """Move the run's files into the table and delete the files they stand for; what is done already is skipped."""
    waiting = [file for part in (ROWS, KEPT) for file in _files(spark, table, run, part)]
    buckets = {file.rsplit("/", 2)[1] for file in waiting}
    for bucket in sorted(buckets):
        path = _path(spark, f"{table.path}/{bucket}")
        _file_system(spark, path).mkdirs(path)
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda file: _move(spark, file, f"{table.path}/{'/'.join(file.rsplit('/', 2)[1:])}"), waiting))
        list(pool.map(lambda file: _delete(spark, f"{table.path}/{file}"), replaced))
    add_partitions(spark, table, sorted(int(bucket.split("=")[1]) for bucket in buckets))


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    found = _path(spark, path)
    return _file_system(spark, found).exists(found)


def _files(spark: SparkSession, table: Table, run: str, part: str) -> list[str]:
    """The Parquet files of a part that still wait; none where it is missing."""
    return _read_part(spark, table, run, part).inputFiles() if _exists(spark, _part(table, run, part)) else []


def _move(spark: SparkSession, file: str, to: str) -> None:
    source, target = _path(spark, file), _path(spark, to)
    if not _file_system(spark, target).rename(source, target):
        raise OSError(f"cannot move {file} to {to}")


def _delete(spark: SparkSession, path: str) -> None:
    found = _path(spark, path)
    _file_system(spark, found).delete(found, True)


def _forget(spark: SparkSession, table: Table, run: str | None = None) -> None:
    """Remove the work path of a run, or of all runs."""
    _delete(spark, table.stage_path if run is None else f"{table.stage_path}/{run}")
