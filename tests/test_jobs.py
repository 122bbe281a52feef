"""The load jobs from files to gold, over several batches."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException

import eventmart as em
from eventmart.__main__ import main
from eventmart.functions.columns import ntz
from eventmart.operators.incremental import START, high_water_mark
from eventmart.operators.upsert import last_merged_stamp

HEADER = "event_id,user_id,event_type,product_id,timestamp\n"
DAY1, DAY2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"


def csv(path, *lines):
    path.write_text(HEADER + "".join(f"{line},2024-01-01T00:00:00\n" for line in lines))
    return str(path)


def session(sid, user, *events):
    return {
        "session_id": sid,
        "user_id": user,
        "start_time": "2024-01-01T00:00:30",
        "end_time": "2024-01-01T00:10:00",
        "events": [
            {"type": kind, "product_id": "P", "timestamp": f"2024-01-01T00:0{minute}:00"}
            for kind, minute in events
        ],
        "device": {"os": "Linux", "browser": "Edge"},
        "location": {"country": "Norway", "city": "Oslo"},
    }


def array_file(path, *sessions):
    path.write_text(json.dumps(sessions))
    return str(path)


def table(spark, layout, name, *columns):
    df = em.read_table(spark, layout[name]).select(*columns)
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def layout(tmp_path):
    return em.Layout(str(tmp_path / "mart"), 4)


def load_users(spark, layout, path, stamp):
    """The event files up to gold.user_metrics only."""
    counts = em.run(spark, layout, "bronze", "events", events_csv=path, stamp=stamp)
    counts |= em.run(spark, layout, "silver", "events")
    return counts | em.run(spark, layout, "gold", "users")


@pytest.mark.parametrize("scope, null_safe", [("batch", False), ("touched", True)])
def test_two_batches(spark, layout, tmp_path, scope, null_safe):
    first = csv(
        tmp_path / "1.csv",
        "1,u,view_product,P",
        "2,u,View_Product,P",
        "3,u,purchase,P",
        "4,v,add_to_cart,",
        "5,,purchase,P",
    )
    counts = em.run(
        spark,
        layout,
        events_csv=first,
        sessions_json=array_file(
            tmp_path / "1.json", session("s1", "u", ("view_product", 1)), session("s2", "v")
        ),
        stamp=DAY1,
    )
    assert counts["bronze.events"] == (5, 0)
    assert counts["silver.events_cleaned"] == (4, 0)
    assert counts["silver.session_events"] == (1, 0)
    assert counts["gold.session_metrics"] == (1, 0)

    # Event 3 changes, event 6 is new; session s1 grows.
    second = csv(tmp_path / "2.csv", "3,u,add_to_cart,P", "6,w,purchase,")
    counts = em.run(
        spark,
        layout,
        events_csv=second,
        sessions_json=array_file(
            tmp_path / "2.json", session("s1", "u", ("view_product", 1), ("purchase", 2))
        ),
        stamp=DAY2,
        scope=scope,
        null_safe=null_safe,
    )
    assert counts["silver.events_cleaned"] == (1, 1)
    assert counts["silver.session_events"] == (1, 1)
    assert counts["gold.user_metrics"] == (1, 1)

    day1, day2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    assert table(spark, layout, "silver.events_cleaned", "event_id", "event_type", "ingested_at") == [
        (1, "view_product", day1),
        (2, "view_product", day1),
        (3, "add_to_cart", day2),
        (4, "add_to_cart", day1),
        (6, "purchase", day2),
    ]
    u = ("u", 1, 0, 1, day2) if scope == "batch" else ("u", 3, 0, 3, day2)
    assert table(
        spark, layout, "gold.user_metrics", "user_id", "total_events", "num_purchases", "num_clicks",
        "ingested_at",
    ) == [u, ("v", 1, 0, 1, day1), ("w", 1, 1, 0, day2)]
    assert table(
        spark, layout, "gold.session_metrics", "session_id", "session_duration_minutes",
        "num_events", "is_bounce",
    ) == [("s1", 10.0, 2, False)]
    # The NULL product matches only when asked to.
    null_new = (None, 0, 0, 1) if scope == "batch" else (None, 0, 1, 1)
    null_old = [] if null_safe else [(None, 0, 1, 0)]
    p = ("P", 0, 1, 0) if scope == "batch" else ("P", 2, 1, 0)
    assert table(
        spark, layout, "gold.product_metrics", "product_id", "num_views", "num_add_to_cart",
        "num_purchases",
    ) == sorted([p, null_new, *null_old], key=repr)

    # Nothing new: nothing happens.
    assert set(em.run(spark, layout, "silver").values()) == {(0, 0)}
    assert set(em.run(spark, layout, "gold").values()) == {(0, 0)}


def test_batch_with_no_valid_row(spark, layout, tmp_path):
    counts = load_users(spark, layout, csv(tmp_path / "1.csv", ",u,purchase,P"), DAY1)
    assert counts["bronze.events"] == (1, 0)
    assert counts["silver.events_cleaned"] == (0, 0)
    assert high_water_mark(spark, layout["silver.events_cleaned"]) == START


def test_steps(spark, layout, tmp_path):
    path = csv(tmp_path / "1.csv", "1,u,purchase,P")
    assert set(em.run(spark, layout, "bronze", "events", events_csv=path)) == {"bronze.events"}
    assert set(em.run(spark, layout, "silver", "events")) == {"silver.events_cleaned"}
    assert set(em.run(spark, layout, "gold", "products")) == {"gold.product_metrics"}
    assert set(em.run(spark, layout, "gold")) == {
        "gold.user_metrics",
        "gold.session_metrics",
        "gold.product_metrics",
    }
    for layer, step in (("gold", "events"), ("all", "events"), ("copper", "all")):
        with pytest.raises(ValueError, match="unknown"):
            em.run(spark, layout, layer, step)


def test_high_water_mark(spark, layout, tmp_path):
    mark = high_water_mark
    users = layout["gold.user_metrics"]
    assert mark(spark, users) == START  # absent
    em.ensure_tables(spark, layout, "gold")
    assert mark(spark, users) == START  # empty
    with pytest.raises(AnalysisException):
        mark(spark, users, "no_such_column")
    load_users(spark, layout, csv(tmp_path / "1.csv", "1,u,purchase,P"), DAY1)
    assert mark(spark, users) == dt.datetime(2024, 1, 1, 6)
    # The stored rows count, whatever the log says.
    rows = em.read_table(spark, users)
    em.upsert(rows.withColumn("ingested_at", ntz("2023-01-01")), users)
    assert last_merged_stamp(spark, users) == dt.datetime(2024, 1, 1, 6)
    assert mark(spark, users) == dt.datetime(2023, 1, 1)


def test_two_users_of_one_new_session_then_an_update(spark, layout):
    """Unmatched repeats of a session key are inserted; an ambiguous update is refused."""
    flat = em.flatten_sessions(
        spark.createDataFrame(
            [("s", u, "2024-01-01", "2024-01-01", [("view", "P", t)], DAY1) for u, t in
             (("u", "2024-01-01 00:01:00"), ("v", "2024-01-01 00:02:00"))],
            "session_id string, user_id string, start_time string, end_time string, "
            "events array<struct<type:string,product_id:string,timestamp:string>>, "
            "ingested_at string",
        ).selectExpr(
            "session_id", "user_id", "cast(start_time as timestamp_ntz) as start_time",
            "cast(end_time as timestamp_ntz) as end_time", "events",
            "named_struct('os', 'a', 'browser', 'b') as device",
            "named_struct('country', 'a', 'city', 'b') as location",
            "cast(ingested_at as timestamp_ntz) as ingested_at",
        )
    )
    target = layout["gold.session_metrics"]
    metrics = em.session_metrics(flat)
    assert em.upsert(metrics, target) == (2, 0)
    with pytest.raises(em.DuplicateSourceKey):
        em.upsert(metrics, target)


def test_catalog(spark, layout, tmp_path):
    load_users(spark, layout, csv(tmp_path / "1.csv", "1,u,purchase,P"), DAY1)
    em.register_tables(spark, layout)
    query = "SELECT user_id, num_purchases FROM gold.user_metrics ORDER BY 1"
    assert [tuple(r) for r in spark.sql(query).collect()] == [("u", 1)]
    load_users(spark, layout, csv(tmp_path / "2.csv", "2,v,purchase,P", "3,u,x,P"), DAY2)
    em.register_tables(spark, layout)
    assert [tuple(r) for r in spark.sql(query).collect()] == [("u", 0), ("v", 1)]
    # The ingest stamp has a default.
    spark.sql(
        "INSERT INTO gold.user_metrics (user_id, total_events, _bucket) VALUES ('x', 1, 0)"
    )
    stamped = spark.sql("SELECT ingested_at FROM gold.user_metrics WHERE user_id = 'x'").first()[0]
    assert stamped > dt.datetime(2024, 6, 1)
    for name in layout.tables:
        spark.sql(f"DROP TABLE {name}")


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    arguments = ["--root", str(tmp_path / "mart"), "--buckets", "2"]
    path = csv(tmp_path / "1.csv", "1,u,purchase,P")
    monkeypatch.setattr(
        "sys.argv",
        ["eventmart", *arguments, "--layer", "bronze", "--step", "events", "--events", path],
    )
    main()
    monkeypatch.setattr("sys.argv", ["eventmart", *arguments, "--layer", "silver"])
    main()
    assert capsys.readouterr().out.splitlines() == [
        "bronze.events: 1 inserted, 0 updated",
        "silver.events_cleaned: 1 inserted, 0 updated",
        "silver.session_events: 0 inserted, 0 updated",
    ]
