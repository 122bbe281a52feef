"""Cleaned events and flattened session events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant, as_variant, text_at
from eventmart.operators.dedup import first_per_key
from eventmart.operators.incremental import newer_than


def clean_events(events: DataFrame, since: Instant | None = None) -> DataFrame:
    """Normalised, complete and unique events of the rows stamped after ``since``.

    Event types are lower-cased; rows without event_id, user_id, event_type or
    timestamp are dropped (product_id may be NULL); of several rows with one
    event_id the latest stamped wins, then the latest in event time.
    """
    order = [
        F.desc("ingested_at"),
        F.desc("timestamp"),
        F.asc_nulls_last("user_id"),
        F.asc_nulls_last("event_type"),
        F.asc_nulls_last("product_id"),
    ]
    complete = (
        newer_than(events, since)
        .withColumn("event_type", F.lower("event_type"))
        .na.drop(subset=["event_id", "user_id", "event_type", "timestamp"])
    )
    return first_per_key(complete, ["event_id"], order)


def flatten_sessions(sessions: DataFrame, since: Instant | None = None) -> DataFrame:
    """One row per session event, for sessions stamped after ``since``.

    ``device``, ``location`` and ``events`` are variants (nested columns are taken as such); fields
    that no column names stay behind in the raw table.  Sessions whose ``events`` is empty, NULL or no array give no
    rows; an element without a field, or that is no object, has NULL there.  Of several
    events of one session with equal type and time, the latest stamped wins, then the
    first in the array.
    """
    new = newer_than(sessions, since)
    nested = {name: as_variant(new, name) for name in ("device", "location", "events")}
    # what a session has once is taken from its variants before its events are exploded
    flat = (
        new.withColumns(nested)
        .select(
            "session_id",
            "user_id",
            "start_time",
            "end_time",
            text_at("device", "$.browser").alias("browser"),
            text_at("device", "$.os").alias("operating_system"),
            text_at("location", "$.country").alias("country"),
            text_at("location", "$.city").alias("city"),
            "ingested_at",
            F.try_variant_get("events", "$", "array<variant>").alias("_events"),
        )
        .select("*", F.posexplode("_events").alias("_position", "_event"))
        .select(
            "session_id",
            "user_id",
            "start_time",
            "end_time",
            F.lower(text_at("_event", "$.type")).alias("event_type"),
            text_at("_event", "$.product_id").alias("product_id"),
            "browser",
            "operating_system",
            "country",
            "city",
            text_at("_event", "$.timestamp").cast("timestamp_ntz").alias("event_timestamp"),
            "ingested_at",
            "_position",
        )
    )
    ties: list[Column] = [
        F.asc_nulls_last(name)
        for name in (
            "product_id",
            "user_id",
            "start_time",
            "end_time",
            "browser",
            "operating_system",
            "country",
            "city",
        )
    ]
    return first_per_key(
        flat,
        ["session_id", "event_type", "event_timestamp"],
        [F.desc("ingested_at"), F.asc("_position"), *ties],
    ).drop("_position")
