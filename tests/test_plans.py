"""The physical plans that the design relies on."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import eventmart as em
from eventmart import adapter
from eventmart.functions.columns import ntz
from eventmart.operators import incremental
from eventmart.operators import upsert as upsert_module
from eventmart.operators.incremental import newer_rows
from eventmart.operators.merge_log import LOG_DDL, certain_stamp, touched_since
from eventmart.sources.tables import read_if_exists

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = em.Layout(str(tmp_path_factory.mktemp("mart")), 8)
    events = adapter.bronze_events(spark, SF_DIR)
    em.upsert(events, layout["bronze.events"])
    em.upsert(em.clean_events(events), layout["silver.events_cleaned"])
    return layout


def test_metrics_read_only_their_columns_and_shuffle_partial_counts(spark, layout):
    silver = em.read_table(spark, layout["silver.events_cleaned"])
    text = plan(em.user_metrics(silver, "2024-01-20", stamp="2024-01-31"))
    assert "ReadSchema: struct<user_id:string,event_type:string,ingested_at:timestamp_ntz>" in text
    assert text.count("Exchange") == 1
    assert "partial_count" in text.split("Exchange")[1]
    assert "Join" not in text


def test_touched_metrics_drop_other_keys_below_the_aggregate(spark, layout):
    silver = em.read_table(spark, layout["silver.events_cleaned"])
    text = plan(em.user_metrics(silver, "2024-01-20", "touched", stamp="2024-01-31"))
    assert "ReadSchema: struct<user_id:string,event_type:string>" in text
    assert "ReadSchema: struct<user_id:string,ingested_at:timestamp_ntz>" in text
    assert text.index("partial_count") < text.index("LeftSemi")


def test_mark_reaches_the_scan(spark, layout):
    bronze = em.read_table(spark, layout["bronze.events"])
    text = plan(em.newer_than(bronze, "2024-01-20").select("event_id"))
    assert "GreaterThan(ingested_at,2024-01-20T00:00" in text


def test_date_range_reaches_the_scan(spark, layout):
    users = em.user_metrics(em.read_table(spark, layout["silver.events_cleaned"]))
    em.upsert(users, layout["gold.user_metrics"])
    text = plan(em.user_behavior(em.read_table(spark, layout["gold.user_metrics"]), "2024-01-31"))
    assert "GreaterThanOrEqual(ingested_at,2024-01-31T00:00" in text
    assert "LessThan(ingested_at,2024-02-01T00:00" in text


def test_deduplication_is_limited_before_the_shuffle(spark, layout):
    text = plan(em.clean_events(em.read_table(spark, layout["bronze.events"])))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below


def test_kpis_count_without_doubling_rows(spark, layout):
    silver = em.read_table(spark, layout["silver.events_cleaned"])
    sessions = silver.select(F.col("user_id").alias("session_id"), "user_id", F.lit(1.0).alias("session_duration_minutes"), "ingested_at")
    report = em.kpis(sessions, "2024-01-01", "2024-02-01")
    text = plan(report)
    assert "Expand" not in text
    assert "ReadSchema: struct<user_id:string,ingested_at:timestamp_ntz>" in text
    users = silver.select("user_id").distinct().count()
    assert tuple(report.first()) == (users, users, 1.0)


def test_top_products_keeps_ten_per_task(spark, layout):
    products = em.product_metrics(em.read_table(spark, layout["silver.events_cleaned"]))
    assert "TakeOrderedAndProject(limit=10" in plan(em.top_products(products, "2024-01-01", "2024-03-01"))


def test_upsert_reads_only_files_with_a_match_and_rebalances(spark, layout, monkeypatch):
    seen = {}
    real = upsert_module._write

    def spy(rows, table, path):
        seen[path.rsplit("/", 1)[-1]] = plan(rows.hint("rebalance", "_bucket").sortWithinPartitions("_bucket")), rows.inputFiles()
        real(rows, table, path)

    monkeypatch.setattr(upsert_module, "_write", spy)
    gold = layout["gold.product_metrics"]
    products = em.product_metrics(em.read_table(spark, layout["silver.events_cleaned"]))
    em.upsert(products, gold)
    before = set(em.read_table(spark, gold).inputFiles())
    em.upsert(products.filter(F.col("product_id") == "PROD_001"), gold)
    text, read = seen[upsert_module.KEPT]
    assert len(before) > 1
    assert len(before & set(read)) == 1
    assert "LeftAnti" in text
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_matching_prunes_buckets(spark, layout):
    """Only key columns of touched buckets are read, within the key bounds of the batch."""
    gold = layout["gold.user_metrics"]
    users = em.user_metrics(em.read_table(spark, layout["silver.events_cleaned"]))
    em.upsert(users, gold)
    touched = [{"_bucket": 3, "_bounds_user_id": {"lo": "user_1", "hi": "user_2"}}]
    target = read_if_exists(spark, gold).filter(upsert_module.in_buckets(r["_bucket"] for r in touched))
    text = plan(target.filter(upsert_module._within_bounds(gold, touched, nulls=False)).select("user_id"))
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ = 3", text)
    assert "GreaterThanOrEqual(user_id,user_1), LessThanOrEqual(user_id,user_2)" in text
    assert "ReadSchema: struct<user_id:string>" in text


@pytest.fixture
def striped(spark, tmp_path):
    """bronze.events in 8 buckets of ten ids each in turn, filled by three batches."""
    table = em.Layout(str(tmp_path), 8)["bronze.events"]
    spec = dataclasses.replace(table.spec, stripe=("event_id div 10",), buckets=8)
    table = dataclasses.replace(table, spec=spec)
    for day, ids in ((1, range(80)), (2, range(80, 90)), (3, range(0, 10))):
        em.upsert(batch_of(spark, ids, day), table)
    return table


def batch_of(spark, ids, day):
    rows = spark.createDataFrame([(i, "u", "purchase", "P") for i in ids], "event_id bigint, user_id string, event_type string, product_id string")
    return rows.withColumns({c: ntz(f"2024-01-0{day}") for c in ("timestamp", "ingested_at")})


def test_incremental_read_scans_the_buckets_of_the_batch(spark, striped):
    """After batches of k buckets, newer rows are read from k partitions."""
    new = newer_rows(spark, striped, "2024-01-01")
    assert sorted(r.event_id for r in new.collect()) == [*range(10), *range(80, 90)]
    touched = touched_since(spark, striped, "2024-01-01")
    assert len(touched) == len({r["_bucket"] for r in new.collect()}) <= 2
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ (IN|=)", plan(new))
    scanned = new.select(F.input_file_name().alias("f")).distinct().count()
    assert scanned <= len(new.inputFiles())
    assert touched_since(spark, striped, "2024-01-03") == []
    assert newer_rows(spark, striped, "2024-01-03").isEmpty()


def test_mark_without_a_scan(spark, striped, monkeypatch):
    """The log proves the mark unless rows were replaced after the latest stamp came in."""
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "read_if_exists", lambda *_: pytest.fail("scanned"))
        assert em.high_water_mark(spark, striped) == dt.datetime(2024, 1, 3)
    em.upsert(batch_of(spark, [5], 1), striped)
    assert certain_stamp(spark, striped) is None
    assert em.high_water_mark(spark, striped) == dt.datetime(2024, 1, 3)
    em.upsert(batch_of(spark, range(0, 10), 2), striped)
    assert em.high_water_mark(spark, striped) == dt.datetime(2024, 1, 2)


def test_log_of_an_older_version_prunes_nothing(spark, striped):
    """Entries without an index: all buckets are read, and the mark is looked up."""
    old = spark.read.schema(LOG_DDL).parquet(striped.log_path).drop("touched", "replaced")
    rows = spark.createDataFrame(old.collect(), old.schema)
    rows.write.mode("overwrite").parquet(striped.log_path)
    assert touched_since(spark, striped, "2024-01-01") is None
    assert newer_rows(spark, striped, "2024-01-01").count() == 20
    assert em.high_water_mark(spark, striped) == dt.datetime(2024, 1, 3)
    em.upsert(batch_of(spark, [200], 5), striped)
    assert len(touched_since(spark, striped, "2024-01-04")) == 1


def test_registered_tables_list_only_what_is_read(spark, striped, tmp_path):
    """A merge into a new bucket is seen by SQL users at once, and files of other partitions are not listed."""
    layout = em.Layout(str(tmp_path / "sql"), 8)
    users = layout["gold.user_metrics"]
    row = "SELECT 'u{0}' AS user_id, 1L AS total_events, 1L AS num_purchases, 0L AS num_clicks, 0D AS conversion_rate, timestamp_ntz'2024-01-01' AS ingested_at"
    em.upsert(spark.sql(row.format(1)), users)
    em.register_tables(spark, layout)
    try:
        for i in range(2, 30):
            bucket = spark.sql(f"SELECT 'u{i}' AS user_id").select(users.bucket()).first()[0]
            if bucket not in {r["_bucket"] for r in spark.sql("SELECT _bucket FROM gold.user_metrics").collect()}:
                break
        em.upsert(spark.sql(row.format(i)), users)
        assert sorted(r[0] for r in spark.sql("SELECT user_id FROM gold.user_metrics").collect()) == ["u1", f"u{i}"]
        one = em.read_table(spark, users)
        assert sorted(r.user_id for r in one.collect()) == ["u1", f"u{i}"]
        pruned = spark.table("gold.user_metrics").filter(F.col("_bucket") == bucket)
        text = pruned._jdf.queryExecution().optimizedPlan().toString() + plan(pruned)
        assert re.search(r"Location: InMemoryFileIndex\(1 paths\)", text)
        em.upsert(spark.sql(row.format(i).replace("1L AS total_events", "7L AS total_events")), users)
        assert pruned.sparkSession.sql(f"SELECT total_events FROM gold.user_metrics WHERE user_id = 'u{i}'").first()[0] == 7
    finally:
        for name in layout.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_values_of_a_session_are_taken_once_not_per_event(spark):
    text = plan(em.flatten_sessions(adapter.bronze_sessions(spark, SF_DIR)))
    below = text.index("Generate posexplode")
    assert text.index("try_variant_get(device") > below
    assert text.index("try_variant_get(location") > below
