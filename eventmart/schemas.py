"""Columns, merge keys and default bucketing of every table.

Raw timestamps are ISO-8601 without a zone, so every timestamp column is
``timestamp_ntz``.  Ids and counts are ``bigint``.  Nested values of raw sessions are
``variant``: they keep every field that a producer sends, declared anywhere or not, and get
their types when they are flattened.
"""

from __future__ import annotations

from dataclasses import dataclass

EVENTS_RAW = (
    "event_id bigint, user_id string, event_type string, product_id string, "
    "`timestamp` timestamp_ntz"
)

SESSIONS_RAW = (
    "session_id string, user_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "device variant, location variant, events variant"
)


@dataclass(frozen=True)
class TableSpec:
    """A table's columns, its merge key and how keys spread over buckets.

    ``stripe`` holds SQL expressions over key columns only (``{buckets}`` stands
    for the bucket count): a row's bucket can then never change in an update.  Where the key has a natural order (a
    sequential id, an event time) the stripe follows it, so that a batch of new
    keys lands in few buckets instead of one row in each.
    """

    columns: dict[str, str]
    keys: tuple[str, ...]
    stripe: tuple[str, ...]
    buckets: int

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


_EVENT_COLUMNS = {
    "event_id": "bigint",
    "user_id": "string",
    "event_type": "string",
    "product_id": "string",
    "timestamp": "timestamp_ntz",
    "ingested_at": "timestamp_ntz",
}

# A million consecutive event ids share a bucket.
_EVENT_STRIPE = ("event_id div 1000000",)

TABLES: dict[str, TableSpec] = {
    "bronze.events": TableSpec(_EVENT_COLUMNS, ("event_id",), _EVENT_STRIPE, 1024),
    "bronze.sessions": TableSpec(
        {
            "session_id": "string",
            "user_id": "string",
            "start_time": "timestamp_ntz",
            "end_time": "timestamp_ntz",
            "device": "variant",
            "location": "variant",
            "events": "variant",
            "ingested_at": "timestamp_ntz",
        },
        ("session_id",),
        ("session_id",),
        16,
    ),
    "silver.events_cleaned": TableSpec(_EVENT_COLUMNS, ("event_id",), _EVENT_STRIPE, 1024),
    "silver.session_events": TableSpec(
        {
            "session_id": "string",
            "user_id": "string",
            "start_time": "timestamp_ntz",
            "end_time": "timestamp_ntz",
            "event_type": "string",
            "product_id": "string",
            "browser": "string",
            "operating_system": "string",
            "country": "string",
            "city": "string",
            "event_timestamp": "timestamp_ntz",
            "ingested_at": "timestamp_ntz",
        },
        ("session_id", "event_type", "event_timestamp"),
        # The sessions of a day share a bucket, or several when there are many buckets.
        ("to_date(event_timestamp)", "pmod(xxhash64(session_id), {buckets} div 256 + 1)"),
        256,
    ),
    "gold.user_metrics": TableSpec(
        {
            "user_id": "string",
            "total_events": "bigint",
            "num_purchases": "bigint",
            "num_clicks": "bigint",
            "conversion_rate": "double",
            "ingested_at": "timestamp_ntz",
        },
        ("user_id",),
        ("user_id",),
        16,
    ),
    "gold.session_metrics": TableSpec(
        {
            "session_id": "string",
            "user_id": "string",
            "session_duration_minutes": "double",
            "num_events": "bigint",
            "is_bounce": "boolean",
            "ingested_at": "timestamp_ntz",
        },
        ("session_id",),
        ("session_id",),
        16,
    ),
    "gold.product_metrics": TableSpec(
        {
            "product_id": "string",
            "num_views": "bigint",
            "num_add_to_cart": "bigint",
            "num_purchases": "bigint",
            "click_to_purchase_rate": "double",
            "ingested_at": "timestamp_ntz",
        },
        ("product_id",),
        ("product_id",),
        4,
    ),
}


def _partials(target: str, sums: tuple[str, ...]) -> TableSpec:
    """Sums per key of a metric table and bucket of its source; see ``plans/lifetime.py``."""
    spec = TABLES[target]
    keys = _PARTIAL_KEYS[target]
    columns = {"source_bucket": "int", **{k: spec.columns[k] for k in keys}, **dict.fromkeys(sums, "bigint"), "ingested_at": "timestamp_ntz"}
    return TableSpec(columns, ("source_bucket", *keys), spec.stripe, spec.buckets)


_PARTIAL_KEYS = {
    "gold.user_metrics": ("user_id",),
    "gold.session_metrics": ("session_id", "user_id"),
    "gold.product_metrics": ("product_id",),
}

PARTIALS = {
    "gold.user_metrics": "gold.user_partials",
    "gold.session_metrics": "gold.session_partials",
    "gold.product_metrics": "gold.product_partials",
}

TABLES |= {
    "gold.user_partials": _partials("gold.user_metrics", ("total_events", "num_purchases", "num_clicks")),
    "gold.session_partials": _partials("gold.session_metrics", ("num_events", "total_minutes", "timed_events")),
    "gold.product_partials": _partials("gold.product_metrics", ("num_views", "num_add_to_cart", "num_purchases")),
}
