"""Bronze-shaped inputs derived from the test data's ``events`` table.

``events`` has columns event_id, ts, user_id, event_type, value and props
(``{"k": n}``).  A ``signup`` is an event type that no metric names, and has no
product; ``ingested_at`` is the midnight after the event, so that 30 days give 30
daily batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The operating systems, browsers, cities and country of session data.
OPERATING_SYSTEMS = ("Windows", "macOS", "Linux", "iOS", "Android")
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")
CITIES = ("Oslo", "Bergen", "Stavanger", "Trondheim")
COUNTRY = "Norway"


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the shape of bronze.events."""
    kind = F.col("event_type")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        F.when(kind == "view", "view_product")
        .when(kind == "click", "add_to_cart")
        .when(kind == "error", "remove_from_cart")
        .otherwise(kind)
        .alias("event_type"),
        F.when(
            kind != "signup",
            F.concat(F.lit("PROD_"), F.lpad(F.get_json_object("props", "$.k"), 3, "0")),
        ).alias("product_id"),
        F.col("ts").alias("timestamp"),
        F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz").alias("ingested_at"),
    )


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input for cleaning: damaged rows, and later, corrected copies of every view."""
    events = bronze_events(spark, sf_dir)
    event_id = F.col("event_id")
    damaged = events.withColumns(
        {
            "event_type": F.when(event_id % 3 == 0, F.upper("event_type")).otherwise(
                F.col("event_type")
            ),
            "user_id": F.when(event_id % 97 != 0, F.col("user_id")),
            "timestamp": F.when(event_id % 101 != 0, F.col("timestamp")),
        }
    )
    copies = events.filter(F.col("event_type") == "view_product").withColumns(
        {
            "event_type": F.lit("PURCHASE"),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return damaged.unionByName(copies)


def bronze_sessions(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """The events of each user and day as one nested session.

    The day is the window for all users alike, so a session holds what one user does
    in a day.  With ``copies``, each purchase is followed by one of product PROD_999 at the same
    time, which flattening must drop.
    """
    number = F.substring_index("user_id", "_", -1)
    entry = F.struct("timestamp", "event_id", "event_type", "product_id")
    grouped = (
        bronze_events(spark, sf_dir)
        .groupBy(
            "user_id",
            F.to_date("timestamp").alias("day"),
        )
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.array_sort(F.collect_list(entry)).alias("entries"),
        )
    )
    events = F.transform("entries", lambda e: _raw_event(e))
    if copies:
        events = F.flatten(
            F.transform(
                "entries",
                lambda e: F.when(
                    e["event_type"] == "purchase",
                    F.array(_raw_event(e), _raw_event(e, F.lit("PROD_999"))),
                ).otherwise(F.array(_raw_event(e))),
            )
        )
    return grouped.select(
        F.concat_ws("_", F.lit("sess"), number, F.replace(F.col("day").cast("string"), F.lit("-"))).alias(
            "session_id"
        ),
        "user_id",
        "start_time",
        "end_time",
        F.struct(
            _pick(OPERATING_SYSTEMS, number).alias("os"), _pick(BROWSERS, number).alias("browser")
        ).alias("device"),
        F.struct(F.lit(COUNTRY).alias("country"), _pick(CITIES, number).alias("city")).alias(
            "location"
        ),
        events.alias("events"),
        F.date_add("day", 1).cast("timestamp_ntz").alias("ingested_at"),
    )


def _raw_event(entry: Column, product: Column | None = None) -> Column:
    return F.struct(
        entry["event_type"].alias("type"),
        (entry["product_id"] if product is None else product).alias("product_id"),
        entry["timestamp"].cast("string").alias("timestamp"),
    )


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(value) for value in values]), number.cast("int") % len(values))
