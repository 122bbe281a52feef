"""Event analytics on layered Parquet tables: bronze, silver, gold, reports."""

from eventmart.layout import Layout, Table
from eventmart.operators.claims import TableClaimed, release_claim
from eventmart.operators.incremental import high_water_mark, newer_rows, newer_than
from eventmart.operators.upsert import DuplicateSourceKey, MergeCounts, merge_log, settle, upsert
from eventmart.plans.gold import product_metrics, session_metrics, user_metrics
from eventmart.plans.jobs import run
from eventmart.plans.reports import (
    conversion_rate_histogram,
    funnel,
    kpis,
    top_products,
    total_events_histogram,
    user_behavior,
)
from eventmart.plans.silver import clean_events, flatten_sessions
from eventmart.sources.files import (
    read_events_csv,
    read_rejects,
    read_sessions_json,
    write_report_csv,
)
from eventmart.sources.tables import ensure_tables, read_table, register_tables

__all__ = [
    "DuplicateSourceKey",
    "Layout",
    "MergeCounts",
    "Table",
    "TableClaimed",
    "clean_events",
    "conversion_rate_histogram",
    "ensure_tables",
    "flatten_sessions",
    "funnel",
    "high_water_mark",
    "kpis",
    "merge_log",
    "newer_rows",
    "newer_than",
    "product_metrics",
    "read_events_csv",
    "read_rejects",
    "read_sessions_json",
    "read_table",
    "register_tables",
    "release_claim",
    "run",
    "session_metrics",
    "settle",
    "top_products",
    "total_events_histogram",
    "upsert",
    "user_behavior",
    "user_metrics",
    "write_report_csv",
]
