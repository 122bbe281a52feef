"""Lifetime metrics from stored sums, against sums over all rows."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import eventmart as em
from eventmart.functions.columns import ntz
from eventmart.operators.upsert import settle
from eventmart.plans import jobs, lifetime
from eventmart.plans.gold import METRICS
from eventmart.sources.tables import read_stored

SILVER, USERS = "silver.events_cleaned", "gold.user_metrics"
MILLION = 1_000_000  # ids a bucket


@pytest.fixture
def layout(tmp_path):
    return em.Layout(str(tmp_path / "mart"), 8)


def put(spark, layout, day, rows):
    """Rows (event_id, user_id, event_type) into silver, stamped with the day."""
    df = spark.createDataFrame(rows, "event_id bigint, user_id string, event_type string")
    stamp = ntz(f"2024-01-{day:02d}")
    em.upsert(df.withColumns({"product_id": F.lit("P"), "timestamp": stamp, "ingested_at": stamp}), layout[SILVER], null_safe=True)


def load(spark, layout, scope="touched"):
    return jobs.load_user_metrics(spark, layout, scope, null_safe=True)


def users(spark, layout):
    rows = em.read_table(spark, layout[USERS]).collect()
    return {r.user_id: (r.total_events, r.num_purchases, r.num_clicks, r.ingested_at.day) for r in rows}


def plain(spark, layout):
    """(events, purchases) of each user over all silver rows."""
    events, purchases = Counter(), Counter()
    for r in em.read_table(spark, layout[SILVER]).collect():
        events[r.user_id] += 1
        purchases[r.user_id] += r.event_type == "purchase"
    return {u: (events[u], purchases[u]) for u in events}


FIRST = [(1, "ann", "purchase"), (2, "ann", "view_product"), (MILLION + 1, "ann", "purchase"), (3, "bob", "purchase"), (4, None, "x"), (5, "cid", "x")]


def test_updates_that_move_events(spark, layout):
    """A user who loses an event, one who loses all, one who gains, the NULL user; others keep their row."""
    put(spark, layout, 1, FIRST)
    assert load(spark, layout) == (4, 0)
    assert users(spark, layout) == {"ann": (3, 2, 1, 1), "bob": (1, 1, 0, 1), None: (1, 0, 0, 1), "cid": (1, 0, 0, 1)}
    put(spark, layout, 2, [(1, "dee", "purchase"), (3, None, "purchase"), (2 * MILLION, "dee", "view_product")])
    assert load(spark, layout) == (1, 3)
    found = users(spark, layout)
    assert found == {"ann": (2, 1, 1, 2), "bob": (0, 0, 0, 2), None: (2, 1, 0, 2), "cid": (1, 0, 0, 1), "dee": (2, 1, 1, 2)}
    assert {u: row[:2] for u, row in found.items() if row[0]} == plain(spark, layout)
    assert load(spark, layout) == (0, 0)


def test_lost_between_the_two_merges(spark, layout, monkeypatch):
    """The sums are stored, the metrics are not: the next load finds the moved keys again."""
    put(spark, layout, 1, FIRST)
    load(spark, layout)
    put(spark, layout, 2, [(1, "dee", "purchase")])

    def lost(batch, table, null_safe=False):
        if table.name == USERS:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "merge_batch", lost)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, layout)
    assert users(spark, layout)["ann"] == (3, 2, 1, 1)
    assert load(spark, layout) == (1, 1)
    assert users(spark, layout) == {"ann": (2, 1, 1, 2), "bob": (1, 1, 0, 1), None: (1, 0, 0, 1), "cid": (1, 0, 0, 1), "dee": (1, 1, 0, 2)}


def test_sums_make_up_for_batches_loaded_without_them(spark, layout):
    put(spark, layout, 1, FIRST)
    load(spark, layout, "batch")
    put(spark, layout, 2, [(6, "ann", "purchase")])
    load(spark, layout, "batch")
    assert users(spark, layout)["ann"] == (1, 1, 0, 2)
    put(spark, layout, 3, [(7, "ann", "x")])
    assert load(spark, layout) == (0, 1)
    assert users(spark, layout) == {"ann": (5, 3, 1, 3), "bob": (1, 1, 0, 1), None: (1, 0, 0, 1), "cid": (1, 0, 0, 1)}
    # a batch that changes no sum still counts as seen
    put(spark, layout, 4, [(7, "ann", "y")])
    load(spark, layout)
    put(spark, layout, 5, [(7, "bob", "y")])
    load(spark, layout)
    assert {u: row[:2] for u, row in users(spark, layout).items()} == plain(spark, layout)


def test_a_batch_reads_its_own_buckets(spark, layout):
    """Neither the source nor the stored sums are read whole."""
    put(spark, layout, 1, [(i * MILLION, f"u{i}", "purchase") for i in range(24)])
    load(spark, layout)
    put(spark, layout, 2, [(5 * MILLION, "u6", "purchase")])
    partials, metrics = layout["gold.user_partials"], METRICS[USERS]()
    settle(spark, partials)
    changed = lifetime.changed_sums(spark, layout[SILVER], partials, metrics, "2024-01-01")
    text = changed._jdf.queryExecution().executedPlan().toString()
    bucket = read_stored(spark, layout[SILVER]).filter(F.col("event_id") == 5 * MILLION).first()["_bucket"]
    assert re.search(rf"PartitionFilters: \[.*_bucket#\d+ = {bucket}\)", text)
    assert f"EqualTo(source_bucket,{bucket})" in text or f"In(source_bucket, [{bucket}])" in text
    assert "Join" not in text
    assert sorted((r.user_id, r.total_events) for r in changed.collect())[-1][0] == "u6"
    touched = spark.createDataFrame([("u6",)], "user_id string")
    text = lifetime.added_up(spark, partials, metrics, touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ = \d\)", text)
