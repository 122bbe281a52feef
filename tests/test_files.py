"""Raw files and report export."""

from __future__ import annotations

import datetime as dt
import json

import pytest

import eventmart as em

HEADER = "event_id,user_id,event_type,product_id,timestamp\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_skips_each_header_and_unquotes(spark, tmp_path):
    a = write(
        tmp_path / "a.csv",
        HEADER
        + '1,ann,add_to_cart,"mug, blue","2024-03-05T08:09:10.000250"\n'
        + '2,"user ""x"", y",purchase,,2024-03-05T11:12:13\n',
    )
    b = write(tmp_path / "b.csv", "any,names,are,fine,here\n3,u,purchase,P,2025-10-07 00:00:00\n")
    got = [tuple(r) for r in em.read_events_csv(spark, [a, b]).orderBy("event_id").collect()]
    assert got == [
        (1, "ann", "add_to_cart", "mug, blue", dt.datetime(2024, 3, 5, 8, 9, 10, 250)),
        (2, 'user "x", y', "purchase", None, dt.datetime(2024, 3, 5, 11, 12, 13)),
        (3, "u", "purchase", "P", dt.datetime(2025, 10, 7)),
    ]


def test_csv_line_breaks_and_null_marker(spark, tmp_path):
    rows = ['7,"two\nlines",purchase,\\N,2024-03-05T00:00:00', "8,\\N,purchase,P,2024-03-05T00:00:00"]
    path = write(tmp_path / "a.csv", HEADER + "\n".join(rows) + "\n")
    got = em.read_events_csv(spark, path, line_breaks=True).orderBy("event_id").collect()
    assert [(r.user_id, r.product_id) for r in got] == [("two\nlines", None), (None, "P")]


@pytest.mark.parametrize("row", ["x,u,purchase,P,2025-10-07T00:00:00", "1,u,purchase,P,soon"])
def test_malformed_csv_raises_or_is_cleaned_away(spark, tmp_path, row):
    path = write(tmp_path / "a.csv", HEADER + row + "\n2,u,purchase,P,2025-10-07T00:00:00\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        em.read_events_csv(spark, path).collect()
    lenient = em.read_events_csv(spark, path, mode="PERMISSIVE")
    stamped = lenient.selectExpr("*", "timestamp_ntz'2025-10-08' AS ingested_at")
    assert [r.event_id for r in em.clean_events(stamped).collect()] == [2]


SESSIONS = [
    {
        "session_id": "s1",
        "user_id": "u1",
        "start_time": "2024-02-29T07:00:00.000125",
        "end_time": "2024-02-29T07:45:30.500000",
        "events": [
            {"type": "view_product", "product_id": "P", "timestamp": "2024-02-29T07:03:20.250000"},
            {"type": "purchase", "timestamp": "2024-02-29T07:45:30.500000"},
        ],
        "device": {"os": "Plan 9", "browser": "Lynx"},
        "location": {"country": "Malta", "city": "Mosta"},
    },
    {"session_id": "s2", "user_id": "u2", "start_time": "2024-02-29T07:00:00", "extra": 1},
]


@pytest.mark.parametrize("lines", [False, True])
def test_json_array_and_lines(spark, tmp_path, lines):
    text = "\n".join(map(json.dumps, SESSIONS)) if lines else json.dumps(SESSIONS, indent=2)
    path = write(tmp_path / "s.json", text)
    one, two = em.read_sessions_json(spark, path, lines=lines).orderBy("session_id").collect()
    assert one.start_time == dt.datetime(2024, 2, 29, 7, 0, 0, 125)
    assert (one.device.toPython()["os"], one.location.toPython()["city"]) == ("Plan 9", "Mosta")
    events = one.events.toPython()
    assert [(e["type"], e.get("product_id")) for e in events] == [("view_product", "P"), ("purchase", None)]
    assert (two.device, two.events, two.end_time) == (None, None, None)


def test_undeclared_fields_stay(spark, tmp_path):
    """What no schema names survives the file, the upsert and an update; silver takes only its columns."""
    one, two = (dict(s) for s in SESSIONS)
    one["device"] = {"os": "Plan 9", "browser": "Lynx", "model": {"name": "m", "year": 1999}}
    one["events"] = [{**e, "price": 2.5} for e in SESSIONS[0]["events"]] + ["no object", None]
    two["events"] = {"type": "no array"}
    layout = em.Layout(str(tmp_path / "mart"), 2)
    path = write(tmp_path / "s.json", json.dumps([one, two]))
    em.run(spark, layout, "bronze", "sessions", sessions_json=path, stamp="2024-03-01")
    one["device"]["model"]["year"] = 2000
    path = write(tmp_path / "t.json", json.dumps([one]))
    counts = em.run(spark, layout, "bronze", "sessions", sessions_json=path, stamp="2024-03-02")
    assert counts["bronze.sessions"] == (0, 1)
    stored = em.read_table(spark, layout["bronze.sessions"])
    first, second = stored.orderBy("session_id").collect()
    assert first.device.toPython()["model"] == {"name": "m", "year": 2000}
    assert [e["price"] for e in first.events.toPython()[:2]] == [2.5, 2.5]
    assert second.events.toPython() == {"type": "no array"}
    flat = em.flatten_sessions(stored).orderBy("event_timestamp").collect()
    assert [(r.event_type, r.operating_system) for r in flat] == [(None, "Plan 9"), ("view_product", "Plan 9"), ("purchase", "Plan 9")]


def test_malformed_json_raises(spark, tmp_path):
    path = write(tmp_path / "s.json", '[{"session_id": ')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        em.read_sessions_json(spark, path).collect()


def test_report_export(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1, None)], "user_id string, n int, rate double")
    df = df.coalesce(1)
    em.write_report_csv(df, str(tmp_path / "out"))
    em.write_report_csv(df, str(tmp_path / "out"))  # overwrites
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == 'user_id,n,rate\n"a ""b"", c",1,\n'


def test_rejects_are_kept_with_their_file(spark, tmp_path):
    """Every line is an event or a reject; a load that is tried again does not repeat its rejects."""
    layout = em.Layout(str(tmp_path / "mart"), 2)
    bad = ["x,u,purchase,P,2025-10-07T00:00:00", "3,u,purchase", "4,u,purchase,P,soon", "5,u,purchase,P,2025-10-07T00:00:00,more"]
    a = write(tmp_path / "a.csv", HEADER + "1,u,purchase,P,2025-10-07T00:00:00\n" + "\n".join(bad[:2]) + "\n")
    b = write(tmp_path / "b.csv", HEADER + "\n".join(bad[2:]) + "\n2,u,purchase,,2025-10-07T00:00:00\n")
    for _ in range(2):
        em.run(spark, layout, "bronze", "events", events_csv=[a, b], stamp="2025-10-08", rejects=True)
        found = em.read_rejects(spark, layout.rejects_path("bronze.events")).collect()
        assert sorted(r.line for r in found) == sorted(bad)
        assert {r.line: r.file.rsplit("/", 1)[1] for r in found} == dict(zip(bad, ["a.csv", "a.csv", "b.csv", "b.csv"]))
    assert sorted(r.event_id for r in em.read_table(spark, layout["bronze.events"]).collect()) == [1, 2]
    good = write(tmp_path / "c.csv", HEADER + "9,u,purchase,P,2025-10-07T00:00:00\n")
    em.run(spark, layout, "bronze", "events", events_csv=good, stamp="2025-10-09", rejects=True)
    assert em.read_rejects(spark, layout.rejects_path("bronze.events")).count() == 4


def test_rejected_sessions(spark, tmp_path):
    layout = em.Layout(str(tmp_path / "mart"), 2)
    assert em.read_rejects(spark, layout.rejects_path("bronze.sessions")).count() == 0
    lines = [json.dumps(SESSIONS[0]), '{"session_id": "s3", "start_time": "soon"}', "{not json"]
    path = write(tmp_path / "s.json", "\n".join(lines) + "\n")
    em.run(spark, layout, "bronze", "sessions", sessions_json=path, json_lines=True, rejects=True)
    rejects = em.read_rejects(spark, layout.rejects_path("bronze.sessions"))
    assert sorted(r.line for r in rejects.collect()) == sorted(lines[1:])
    assert [r.session_id for r in em.read_table(spark, layout["bronze.sessions"]).collect()] == ["s1"]
