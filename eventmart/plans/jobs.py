"""The load jobs: raw files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant, ntz
from eventmart.layout import Layout, Table
from eventmart.operators.claims import claimed
from eventmart.operators.incremental import high_water_mark, newer_rows
from eventmart.operators.upsert import MergeCounts, merge_batch, settle, upsert
from eventmart.plans import gold, silver
from eventmart.plans.lifetime import lifetime_metrics
from eventmart.sources.files import (
    Paths,
    read_events_csv,
    read_events_csv_lenient,
    read_sessions_json,
    read_sessions_json_lenient,
    write_rejects,
)
from eventmart.sources.tables import ensure_tables

NOTHING = MergeCounts(0, 0)

STEPS: dict[str, tuple[str, ...]] = {
    "bronze": ("events", "sessions"),
    "silver": ("events", "sessions"),
    "gold": ("users", "sessions", "products"),
}


def ingest_events(
    spark: SparkSession,
    layout: Layout,
    csv: Paths,
    stamp: Instant | None = None,
    rejects: bool = False,
) -> MergeCounts:
    """Upsert event files into bronze.events, stamped now or with ``stamp``.

    A malformed line fails the load, or with ``rejects`` goes to the table's rejects instead.
    """
    if not rejects:
        return upsert(_stamped(read_events_csv(spark, csv), stamp), layout["bronze.events"])
    return _ingest_lenient(spark, layout, "bronze.events", read_events_csv_lenient(spark, csv), stamp)


def ingest_sessions(
    spark: SparkSession,
    layout: Layout,
    json: Paths,
    stamp: Instant | None = None,
    lines: bool = False,
    rejects: bool = False,
) -> MergeCounts:
    """Upsert session files into bronze.sessions, stamped now or with ``stamp``; see ``ingest_events``."""
    if not rejects:
        rows = read_sessions_json(spark, json, lines)
        return upsert(_stamped(rows, stamp), layout["bronze.sessions"])
    return _ingest_lenient(spark, layout, "bronze.sessions", read_sessions_json_lenient(spark, json, lines), stamp)


def _ingest_lenient(
    spark: SparkSession, layout: Layout, name: str, parts: tuple[DataFrame, DataFrame], stamp: Instant | None
) -> MergeCounts:
    rows, rejects = parts
    if stamp is None:  # one stamp for both
        stamp = spark.range(1).select(F.localtimestamp()).first()[0]
    write_rejects(rejects, layout.rejects_path(name), str(stamp))
    return upsert(_stamped(rows, stamp), layout[name])


def load_events_cleaned(
    spark: SparkSession, layout: Layout, null_safe: bool = False
) -> MergeCounts:
    """Clean the new bronze events into silver.events_cleaned."""
    return _load_silver(
        spark, layout, "bronze.events", "silver.events_cleaned", silver.clean_events, null_safe
    )


def load_session_events(
    spark: SparkSession, layout: Layout, null_safe: bool = False
) -> MergeCounts:
    """Flatten the new bronze sessions into silver.session_events."""
    return _load_silver(
        spark, layout, "bronze.sessions", "silver.session_events", silver.flatten_sessions, null_safe
    )


def load_user_metrics(
    spark: SparkSession, layout: Layout, scope: gold.Scope = "batch", null_safe: bool = False
) -> MergeCounts:
    """Merge the metrics of new silver events into gold.user_metrics."""
    return _load_gold(
        spark, layout, "silver.events_cleaned", "gold.user_metrics", gold.user_metrics, scope, null_safe
    )


def load_session_metrics(
    spark: SparkSession, layout: Layout, scope: gold.Scope = "batch", null_safe: bool = False
) -> MergeCounts:
    """Merge the metrics of new silver session events into gold.session_metrics."""
    return _load_gold(
        spark, layout, "silver.session_events", "gold.session_metrics", gold.session_metrics, scope, null_safe
    )


def load_product_metrics(
    spark: SparkSession, layout: Layout, scope: gold.Scope = "batch", null_safe: bool = False
) -> MergeCounts:
    """Merge the metrics of new silver events into gold.product_metrics.

    Without ``null_safe`` every batch adds one more row for product NULL.
    """
    return _load_gold(
        spark, layout, "silver.events_cleaned", "gold.product_metrics", gold.product_metrics, scope, null_safe
    )


def run(
    spark: SparkSession,
    layout: Layout,
    layer: str = "all",
    step: str = "all",
    events_csv: Paths | None = None,
    sessions_json: Paths | None = None,
    json_lines: bool = False,
    stamp: Instant | None = None,
    scope: gold.Scope = "batch",
    null_safe: bool = False,
    rejects: bool = False,
) -> dict[str, MergeCounts]:
    """Run the chosen layers in order (bronze, silver, gold) and return the merge counts.

    ``step`` narrows one layer: events or sessions for bronze and silver; users,
    sessions or products for gold.  Bronze loads the files that are given; with ``rejects``
    it sets malformed lines aside instead of failing.
    """
    if layer != "all" and layer not in STEPS:
        raise ValueError(f"unknown layer: {layer}")
    if step != "all" and (layer == "all" or step not in STEPS[layer]):
        raise ValueError(f"unknown step of layer {layer}: {step}")

    def chosen(in_layer: str, name: str) -> bool:
        return layer in ("all", in_layer) and step in ("all", name)

    ensure_tables(spark, layout, None if layer == "all" else layer)
    counts: dict[str, MergeCounts] = {}
    if events_csv is not None and chosen("bronze", "events"):
        counts["bronze.events"] = ingest_events(spark, layout, events_csv, stamp, rejects)
    if sessions_json is not None and chosen("bronze", "sessions"):
        counts["bronze.sessions"] = ingest_sessions(
            spark, layout, sessions_json, stamp, json_lines, rejects
        )
    if chosen("silver", "events"):
        counts["silver.events_cleaned"] = load_events_cleaned(spark, layout, null_safe)
    if chosen("silver", "sessions"):
        counts["silver.session_events"] = load_session_events(spark, layout, null_safe)
    if chosen("gold", "users"):
        counts["gold.user_metrics"] = load_user_metrics(spark, layout, scope, null_safe)
    if chosen("gold", "sessions"):
        counts["gold.session_metrics"] = load_session_metrics(spark, layout, scope, null_safe)
    if chosen("gold", "products"):
        counts["gold.product_metrics"] = load_product_metrics(spark, layout, scope, null_safe)
    return counts


def _stamped(batch: DataFrame, stamp: Instant | None) -> DataFrame:
    return batch.withColumn("ingested_at", F.localtimestamp() if stamp is None else ntz(stamp))


def _load_silver(
    spark: SparkSession,
    layout: Layout,
    source: str,
    target: str,
    transform: Callable[..., DataFrame],
    null_safe: bool,
) -> MergeCounts:
    table: Table = layout[target]
    with claimed(spark, table):
        settle(spark, table)
        new = newer_rows(spark, layout[source], high_water_mark(spark, table))
        if new.isEmpty():
            return NOTHING
        return merge_batch(transform(new), table, null_safe)


def _load_gold(
    spark: SparkSession,
    layout: Layout,
    source: str,
    target: str,
    transform: Callable[..., DataFrame],
    scope: gold.Scope,
    null_safe: bool,
) -> MergeCounts:
    table: Table = layout[target]
    with claimed(spark, table):
        settle(spark, table)
        mark = high_water_mark(spark, table)
        new = newer_rows(spark, layout[source], mark)
        # One pass finds both the batch stamp and whether there is a batch at all.
        stamp = new.agg(F.max("ingested_at")).first()[0]
        if stamp is None:
            return NOTHING
        if scope == "touched":
            batch = lifetime_metrics(spark, layout, source, target, mark, ntz(stamp))
        else:
            batch = transform(new, scope=scope, stamp=stamp)
        return merge_batch(batch, table, null_safe)
