"""Lifetime metrics from stored sums, so that a batch never reads the history of its source.

A partial table holds, for each key of a metric table and each bucket of its source, the sums over that bucket's rows.
A source row never changes its bucket, so when merges touch some buckets, only their
sums can have changed.  A load

1. sums the touched buckets afresh, compares with the stored sums and merges those that changed (zeros where a
   key has no row left in a bucket, for example because an update moved its event to another user);
2. adds up the stored sums of the touched keys alone: keys with a new row or a changed sum.

Where batches were loaded without the sums (scope "batch"), the first load with them makes up for all missed
buckets, and only keys with a new row count as touched.

The partial table lies in the same buckets as its metric table, so the second step reads the buckets of touched keys.
A load that is lost between the two merges is simply repeated: the stored sums that it changed carry stamps after the
metric table's mark, which makes their keys touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant
from eventmart.layout import BUCKET, Layout, Table
from eventmart.operators.incremental import high_water_mark, newer_rows
from eventmart.operators.merge_log import touched_since
from eventmart.operators.upsert import in_buckets, merge_batch, settle
from eventmart.plans.gold import METRICS, Metrics
from eventmart.schemas import PARTIALS
from eventmart.sources.tables import read_if_exists, read_stored

MARKER = -1  # source bucket of the row that carries the latest stamp


def lifetime_metrics(spark: SparkSession, layout: Layout, source: str, target: str, mark: Instant, stamp: Column) -> DataFrame:
    """Lifetime metrics of the keys touched since ``mark``, after the stored sums have been brought up to date.

    A key that lost its last row has zeros.  Rows are stamped with ``stamp``.  The caller's claim on the metric table
    covers its sums, which nobody else writes.
    """
    metrics = METRICS[target]()
    partials = layout[PARTIALS[target]]
    settle(spark, partials)
    known = high_water_mark(spark, partials)
    changed = changed_sums(spark, layout[source], partials, metrics, min(mark, known))
    merge_batch(changed.unionByName(_marker(spark, metrics)).withColumn("ingested_at", stamp), partials, null_safe=True)
    touched = newer_rows(spark, layout[source], mark).select(*metrics.keys)
    if known >= mark:
        moved = newer_rows(spark, partials, mark).filter(F.col("source_bucket") != MARKER)
        touched = touched.union(moved.select(*metrics.keys))
    return metrics.finish(added_up(spark, partials, metrics, touched.distinct()), stamp)


def _marker(spark: SparkSession, metrics: Metrics) -> DataFrame:
    """A row whose stamp tells up to which batch the sums are, also where a batch changes none."""
    columns = [F.lit(MARKER).alias("source_bucket"), *[F.lit(None).cast("string").alias(k) for k in metrics.keys]]
    return spark.range(1).select(*columns, *[F.lit(0).cast("bigint").alias(n) for n in metrics.sums])


def changed_sums(spark: SparkSession, source: Table, partials: Table, metrics: Metrics, mark: Instant) -> DataFrame:
    """Rows ``(source_bucket, *keys, *sums)`` of the buckets touched since ``mark`` whose stored sums differ."""
    buckets = touched_since(spark, source, mark)
    rows = read_stored(spark, source)
    held = read_if_exists(spark, partials)
    if buckets is not None:
        rows = rows.filter(in_buckets(buckets))
        held = None if held is None else held.filter(F.col("source_bucket").isin(buckets))
    keys, names = ["source_bucket", *metrics.keys], list(metrics.sums)
    fresh = rows.groupBy(F.col(BUCKET).alias("source_bucket"), *metrics.keys).agg(
        *[column.alias(name) for name, column in metrics.sums.items()]
    )
    if held is None:
        return fresh
    # stored sums count negatively, so that one aggregation compares; it treats NULL keys as equal
    both = fresh.select(*keys, *names, *[F.col(n).alias(f"_{n}") for n in names]).unionByName(
        held.select(*keys, *[F.lit(0).cast("bigint").alias(n) for n in names], *[(-F.col(n)).alias(f"_{n}") for n in names])
    )
    compared = both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in (*names, *[f"_{n}" for n in names])])
    differs = F.lit(False)
    for name in names:
        differs = differs | (F.col(f"_{name}") != 0)
    return compared.filter(differs).select(*keys, *names)


def added_up(spark: SparkSession, partials: Table, metrics: Metrics, touched: DataFrame) -> DataFrame:
    """Rows ``(*keys, *sums)`` of the touched keys, from the buckets of the partial table that hold them."""
    held = [row[BUCKET] for row in touched.select(partials.bucket().alias(BUCKET)).distinct().collect()]
    asked = touched.select(*[F.col(k).alias(f"_{k}") for k in metrics.keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in metrics.keys]
    rows = read_stored(spark, partials).filter(in_buckets(held)).join(asked, same, "left_semi")
    return rows.groupBy(*metrics.keys).agg(*[F.sum(name).alias(name) for name in metrics.sums])
