"""Edge cases of cleaning, flattening, metrics and reports on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import eventmart as em
from eventmart.functions.columns import guarded_ratio, lenient_double, minute_diff, ntz, or_zero
from eventmart.operators.histogram import histogram
from eventmart.plans.reports import date_range
from eventmart.schemas import TABLES

NOON = "2024-01-01 12:00:00"
LATER = "2024-01-02 12:00:00"


def events(spark, rows):
    """Rows (event_id, user_id, event_type, product_id, timestamp, ingested_at)."""
    df = spark.createDataFrame(
        rows,
        "event_id bigint, user_id string, event_type string, product_id string, "
        "`timestamp` string, ingested_at string",
    )
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("timestamp", "ingested_at")})


def sessions(spark, rows):
    """Rows (session_id, user_id, events), an event being (type, product_id, timestamp)."""
    ddl = (
        "session_id string, user_id string, start_time string, end_time string, "
        "device struct<os:string,browser:string>, location struct<country:string,city:string>, "
        "events array<struct<type:string,product_id:string,`timestamp`:string>>"
    )
    data = [
        (sid, user, NOON, LATER, ("Linux", "Edge"), ("Norway", "Oslo"), found)
        for sid, user, found in rows
    ]
    return spark.createDataFrame(data, ddl).withColumns(
        {
            "start_time": F.col("start_time").cast("timestamp_ntz"),
            "end_time": F.col("end_time").cast("timestamp_ntz"),
            "ingested_at": ntz(NOON),
        }
    )


def gold(spark, name, rows):
    """Rows of a gold table, in column order."""
    columns = TABLES[name].columns
    df = spark.createDataFrame(
        rows, ", ".join(f"{c} {'string' if t == 'timestamp_ntz' else t}" for c, t in columns.items())
    )
    return df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Cleaning


def test_cleaning_lowercases_and_drops_incomplete_rows(spark):
    df = events(
        spark,
        [
            (1, "u", "Purchase", "P", NOON, NOON),
            (2, "u", "PURCHASE", None, NOON, NOON),
            (None, "u", "purchase", "P", NOON, NOON),
            (4, None, "purchase", "P", NOON, NOON),
            (5, "u", None, "P", NOON, NOON),
            (6, "u", "purchase", "P", None, NOON),
        ],
    )
    got = em.clean_events(df).select("event_id", "event_type", "product_id")
    assert rows(got) == [(1, "purchase", "P"), (2, "purchase", None)]


def test_cleaning_keeps_the_latest_stamp_then_the_latest_event(spark):
    df = events(
        spark,
        [
            (1, "u", "a", "P", LATER, NOON),
            (1, "u", "b", "P", NOON, LATER),
            (2, "u", "a", "P", NOON, NOON),
            (2, "u", "b", "P", LATER, NOON),
            (3, "u", "a", None, NOON, NOON),
            (3, "u", "a", "Q", NOON, NOON),
        ],
    )
    got = em.clean_events(df).select("event_id", "event_type", "product_id")
    assert rows(got) == [(1, "b", "P"), (2, "b", "P"), (3, "a", "Q")]


def test_filter_by_mark_is_strict(spark):
    df = events(
        spark,
        [
            (1, "u", "a", "P", NOON, "2024-01-01 00:00:00"),
            (2, "u", "a", "P", NOON, "2024-01-01 00:01:00"),
        ],
    )
    assert [r.event_id for r in em.newer_than(df, "2024-01-01 00:00:00").collect()] == [2]
    assert [r.event_id for r in em.clean_events(df, dt.datetime(2024, 1, 1)).collect()] == [2]
    assert em.newer_than(df, None).count() == 2


# Flattening


def test_flattening_drops_sessions_without_events(spark):
    df = sessions(spark, [("s1", "u", []), ("s2", "u", None), ("s3", "u", [("View", "P", NOON)])])
    (row,) = em.flatten_sessions(df).collect()
    assert (row.session_id, row.event_type, row.event_timestamp) == (
        "s3",
        "view",
        dt.datetime(2024, 1, 1, 12),
    )
    assert (row.browser, row.operating_system, row.country, row.city) == (
        "Edge",
        "Linux",
        "Norway",
        "Oslo",
    )


def test_flattening_keeps_the_first_of_equal_events(spark):
    df = sessions(
        spark,
        [
            ("s", "u", [("view", "B", NOON), ("view", "A", NOON), ("buy", "A", NOON)]),
            ("t", "u", [(None, "B", None), (None, "A", None)]),
        ],
    )
    got = em.flatten_sessions(df).select("session_id", "event_type", "product_id")
    assert rows(got) == [("s", "buy", "A"), ("s", "view", "B"), ("t", None, "B")]


def test_flattening_refuses_a_bad_timestamp(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        em.flatten_sessions(sessions(spark, [("s", "u", [("view", "A", "soon")])])).collect()


# Metrics


def test_user_rates(spark):
    df = events(
        spark,
        [
            (1, "buyer", "purchase", "P", NOON, NOON),
            (2, "other", "signup", None, NOON, NOON),
            (3, "both", "view_product", "P", NOON, NOON),
            (4, "both", "remove_from_cart", "P", NOON, NOON),
            (5, "both", "purchase", "P", NOON, LATER),
        ],
    )
    got = em.user_metrics(df)
    stamp = dt.datetime(2024, 1, 2, 12)
    assert rows(got) == [
        ("both", 3, 1, 2, 0.5, stamp),
        ("buyer", 1, 1, 0, 0.0, stamp),
        ("other", 1, 0, 0, 0.0, stamp),
    ]


def test_product_rates_and_null_product(spark):
    df = events(
        spark,
        [
            (1, "u", "purchase", "P", NOON, NOON),
            (2, "u", "view_product", "Q", NOON, NOON),
            (3, "u", "add_to_cart", "Q", NOON, NOON),
            (4, "u", "purchase", "Q", NOON, NOON),
            (5, "u", "remove_from_cart", None, NOON, NOON),
        ],
    )
    stamp = dt.datetime(2024, 1, 1, 12)
    assert rows(em.product_metrics(df)) == [
        ("P", 0, 0, 1, 0.0, stamp),
        ("Q", 1, 1, 1, 0.5, stamp),
        (None, 0, 0, 0, 0.0, stamp),
    ]


def test_session_with_one_kept_event_bounces(spark):
    flat = em.flatten_sessions(
        sessions(
            spark,
            [
                ("s", "u", [("view", "A", NOON), ("VIEW", "B", NOON)]),
                ("t", "u", [("view", "A", NOON), ("view", "A", LATER)]),
            ],
        )
    )
    stamp = dt.datetime(2024, 1, 1, 12)
    assert rows(em.session_metrics(flat)) == [
        ("s", "u", 1440.0, 1, True, stamp),
        ("t", "u", 1440.0, 2, False, stamp),
    ]


def test_minutes_count_boundaries(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01 00:00:59", "2024-01-01 00:01:00"),
            ("2024-01-01 23:59:59", "2024-01-03 00:01:00"),
            ("2024-01-01 00:00:00", "2024-01-01 00:00:59"),
            ("2024-01-01 00:01:00", "2024-01-01 00:00:59"),
            ("2024-03-31 00:00:00", "2024-04-01 00:00:00"),
            (None, "2024-01-01 00:00:00"),
        ],
        "a string, b string",
    )
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # A zone whose clocks change on 2024-03-31.
        spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
        got = [r[0] for r in df.select(minute_diff(a, b)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [1, 1442, 0, -1, 1440, None]


def test_scopes_agree_on_a_first_load_and_differ_later(spark):
    df = events(
        spark,
        [
            (1, "u", "view_product", "P", NOON, NOON),
            (2, "u", "view_product", "P", NOON, NOON),
            (3, "u", "purchase", "P", NOON, NOON),
            (4, "u", "view_product", "P", NOON, LATER),
            (5, "v", "view_product", None, NOON, NOON),
        ],
    )
    for metrics in (em.user_metrics, em.product_metrics):
        assert rows(metrics(df, scope="batch")) == rows(metrics(df, scope="touched"))
    stamp = dt.datetime(2024, 1, 2, 12)
    assert rows(em.user_metrics(df, NOON)) == [("u", 1, 0, 1, 0.0, stamp)]
    assert rows(em.user_metrics(df, NOON, "touched")) == [("u", 4, 1, 3, 1 / 3, stamp)]
    with pytest.raises(ValueError, match="unknown scope"):
        em.user_metrics(df, scope="all")


# Column helpers


def test_column_helpers(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,)], "x string")
    assert [r[0] for r in df.select(lenient_double(F.col("x"))).collect()] == [12.0, None, None]
    assert [r[0] for r in df.select(or_zero(lenient_double(F.col("x")))).collect()] == [12, 0, 0]
    ratio = guarded_ratio(F.lit(1), F.col("id"))
    assert [r[0] for r in spark.range(3).select(ratio).collect()] == [0.0, 1.0, 0.5]


# Reports


def session_rows(spark):
    return gold(
        spark,
        "gold.session_metrics",
        [
            ("s1", "u", 10.0, 2, False, "2024-01-01 05:00:00"),
            ("s2", "u", 20.0, 1, True, "2024-01-02 00:00:00"),
            ("s3", "v", 60.0, 3, False, "2024-01-02 05:00:00"),
        ],
    )


def test_range_ends_at_midnight_unless_asked(spark):
    df = session_rows(spark)
    assert rows(em.kpis(df, "2024-01-01", "2024-01-02")) == [(1, 2, 15.0)]
    assert rows(em.kpis(df, "2024-01-01", dt.date(2024, 1, 2), whole_end_day=True)) == [(2, 3, 30.0)]
    # One date is both ends.
    assert rows(em.kpis(df, "2024-01-02")) == [(1, 1, 20.0)]


def test_kpis_of_an_empty_range(spark):
    df = session_rows(spark)
    assert rows(em.kpis(df, "2020-01-01")) == [(0, 0, None)]
    assert rows(em.kpis(df, "2020-01-01", zero_when_empty=True)) == [(0, 0, 0.0)]


def test_user_behavior_takes_the_whole_end_day(spark):
    df = gold(
        spark,
        "gold.user_metrics",
        [
            ("a", 1, 0, 1, 0.0, "2024-01-02 00:00:00"),
            ("b", 1, 0, 1, 0.0, "2024-01-02 23:59:59.999999"),
            ("c", 1, 0, 1, 0.0, "2024-01-03 00:00:00"),
        ],
    )
    got = em.user_behavior(df, "2024-01-01", "2024-01-02")
    assert got.columns == [
        "user_id",
        "total_events",
        "num_purchases",
        "num_clicks",
        "conversion_rate",
    ]
    assert [r[0] for r in rows(got)] == ["a", "b"]


def product_rows(spark, count=12):
    return gold(
        spark,
        "gold.product_metrics",
        [(f"P{i:02}", i, 1, 7, 0.0, "2024-01-02 00:00:00") for i in range(count)]
        + [("late", 100, 100, 100, 0.0, "2024-01-02 05:00:00")],
    )


def test_funnel(spark):
    df = product_rows(spark)
    assert rows(em.funnel(df, "2024-01-01", "2024-01-02")) == [(66, 12, 84)]
    assert rows(em.funnel(df, "2024-01-02", whole_end_day=True)) == [(166, 112, 184)]
    assert rows(em.funnel(df, "2020-01-01", "2020-01-02")) == [(0, 0, 0)]


def test_top_products_break_ties_by_id(spark):
    df = product_rows(spark)
    got = em.top_products(df, "2024-01-01", "2024-01-02").collect()
    assert [r.product_id for r in got] == [f"P{i:02}" for i in range(10)]
    got = em.top_products(df, "2024-01-02", whole_end_day=True, limit=2).collect()
    assert [r.product_id for r in got] == ["late", "P00"]


def test_default_range():
    today = dt.date.today()
    assert date_range() == (today - dt.timedelta(days=30), today)
    assert date_range("2024-01-05") == (dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    assert date_range("2024-01-05", dt.date(2024, 2, 1)) == (
        dt.date(2024, 1, 5),
        dt.date(2024, 2, 1),
    )


def test_histogram_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in (0, 1, 5, 99, 100)], "x double")
    got = {r.bin: (r.bin_lo, r.bin_hi, r.num_users) for r in histogram(df, "x").collect()}
    assert got == {1: (0.0, 5.0, 2), 2: (5.0, 10.0, 1), 20: (95.0, 100.0, 2)}


def test_histogram_of_one_value_text_and_nothing(spark):
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r.bin, r.num_users) for r in histogram(same, "x").collect()] == [(1, 2)]
    text = spark.createDataFrame([("1",), ("abc",), (None,), ("NaN",), ("2",)], "x string")
    assert sorted((r.bin, r.num_users) for r in histogram(text, "x").collect()) == [(1, 1), (20, 1)]
    assert histogram(same.filter("x > 5"), "x").collect() == []


def test_histogram_counts_every_user(spark):
    df = gold(
        spark,
        "gold.user_metrics",
        [(f"u{i}", i * i, 0, 0, i / 7, "2024-01-02 05:00:00") for i in range(100)],
    )
    for report in (em.total_events_histogram, em.conversion_rate_histogram):
        got = report(df, "2024-01-02").agg(F.sum("num_users"), F.max("bin")).first()
        assert tuple(got) == (100, 20)
