"""Registered queries and their SQL twins.

Every query reads the whole ``events`` table, through the bronze-shaped inputs of
``eventmart.adapter``.  Queries that store tables do so in a new folder below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import eventmart as em
from eventmart import adapter
from eventmart.functions.columns import ntz, text_at
from eventmart.layout import Layout
from eventmart.plans import jobs

try:  # the operators for training data are a part of their own that may be absent
    from eventmart.llm import queries as training
except ImportError:
    training = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"

HALF = "2024-01-16"  # last ingest stamp of the target of the upsert queries
LAST = "2024-01-30"  # last ingest stamp of the first of two batches
FILE_STAMP = "2024-02-01 06:00:00"  # ingest stamp of the batch loaded from files


def entry(spark: SparkSession) -> DataFrame:
    """Metrics per user over the cleaned events."""
    return user_metrics(spark, FLAGSHIP_DIR)


# Stored inputs


def scratch(spark: SparkSession) -> str:
    """A new folder on the shared storage that the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventmart-")
    return f"{base.rstrip('/')}/eventmart-{uuid.uuid4().hex}"


def load_two_batches(spark: SparkSession, sf_dir: str) -> Layout:
    """All layers, loaded in two batches: the days before the last one, then the last."""
    layout = Layout(scratch(spark))
    events = adapter.bronze_events(spark, sf_dir)
    sessions = adapter.bronze_sessions(spark, sf_dir)
    for batch in (F.col("ingested_at") <= LAST, F.col("ingested_at") > LAST):
        em.upsert(events.filter(batch), layout["bronze.events"])
        em.upsert(sessions.filter(batch), layout["bronze.sessions"])
        em.run(spark, layout, "silver")
        em.run(spark, layout, "gold")
    return layout


def load_lifetime(spark: SparkSession, sf_dir: str) -> Layout:
    """All layers in two batches with lifetime metrics; the second moves old events to other users and products."""
    layout = Layout(scratch(spark))
    events = adapter.bronze_events(spark, sf_dir)
    sessions = adapter.bronze_sessions(spark, sf_dir)
    moved = (F.col("ingested_at") <= LAST) & (F.col("event_id") % 40 == 0)
    second = events.filter((F.col("ingested_at") > LAST) | moved).withColumns(
        {
            "user_id": F.when(moved, "user_moved").otherwise(F.col("user_id")),
            "product_id": F.when(moved, None).otherwise(F.col("product_id")),
            "ingested_at": ntz(FILE_STAMP),
        }
    )
    for old_events, old_sessions in (
        (events.filter(F.col("ingested_at") <= LAST), sessions.filter(F.col("ingested_at") <= LAST)),
        (second, sessions.filter(F.col("ingested_at") > LAST)),
    ):
        em.upsert(old_events, layout["bronze.events"])
        em.upsert(old_sessions, layout["bronze.sessions"])
        em.run(spark, layout, "silver", null_safe=True)
        em.run(spark, layout, "gold", scope="touched", null_safe=True)
    return layout


def write_raw_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The inputs as raw files: events as CSV, sessions as JSON lines."""
    base = scratch(spark)
    events = adapter.bronze_events(spark, sf_dir).drop("ingested_at")
    events = events.withColumn("timestamp", _iso("timestamp"))
    events.write.option("header", True).csv(f"{base}/events")
    sessions = adapter.bronze_sessions(spark, sf_dir).drop("ingested_at")
    sessions = sessions.withColumns({c: _iso(c) for c in ("start_time", "end_time")})
    sessions.write.json(f"{base}/sessions")
    return f"{base}/events", f"{base}/sessions"


def write_array_files(spark: SparkSession, sf_dir: str) -> str:
    """Sessions as files of one JSON array each, of about a hundred sessions."""
    path = f"{scratch(spark)}/sessions"
    sessions = adapter.bronze_sessions(spark, sf_dir).drop("ingested_at")
    sessions = sessions.withColumns({c: _iso(c) for c in ("start_time", "end_time")})
    parts = max(1, sessions.count() // 100)
    part = F.pmod(F.xxhash64("session_id"), F.lit(parts)).alias("part")
    arrays = sessions.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*sessions.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return f"{path}/part=*"


def _iso(column: str) -> Column:
    return F.replace(F.col(column).cast("string"), F.lit(" "), F.lit("T"))


def load_files(spark: SparkSession, sf_dir: str) -> Layout:
    """All layers, loaded from raw files in one batch."""
    layout = Layout(scratch(spark))
    csv, json = write_raw_files(spark, sf_dir)
    em.run(
        spark, layout, events_csv=csv, sessions_json=json, json_lines=True, stamp=FILE_STAMP
    )
    return layout


# Paths of what was stored already, per application and input folder.
_stored: dict[tuple[str, str, Callable], object] = {}


def _once(build: Callable, spark: SparkSession, sf_dir: str):
    key = (spark.sparkContext.applicationId, sf_dir, build)
    if key not in _stored:
        _stored[key] = build(spark, sf_dir)
    return _stored[key]


def _table(build: Callable, name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.read_table(spark, _once(build, spark, sf_dir)[name])


# Queries


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.clean_events(adapter.dirty_events(spark, sf_dir))


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows after the mark of a silver table that lacks the last batch."""
    events = adapter.bronze_events(spark, sf_dir)
    table = Layout(scratch(spark))["silver.events_cleaned"]
    em.upsert(em.clean_events(events.filter(F.col("ingested_at") <= LAST)), table)
    return em.newer_than(events, em.high_water_mark(spark, table))


def flatten_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.flatten_sessions(adapter.bronze_sessions(spark, sf_dir, copies=True))


def user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.user_metrics(em.clean_events(adapter.bronze_events(spark, sf_dir)))


def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.session_metrics(em.flatten_sessions(adapter.bronze_sessions(spark, sf_dir)))


def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.product_metrics(em.clean_events(adapter.bronze_events(spark, sf_dir)))


def user_metrics_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.user_metrics(adapter.bronze_events(spark, sf_dir), LAST, "touched")


def session_metrics_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = em.flatten_sessions(adapter.bronze_sessions(spark, sf_dir))
    return em.session_metrics(flat, LAST, "touched")


def product_metrics_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.product_metrics(adapter.bronze_events(spark, sf_dir), LAST, "touched")


def _old() -> Column:
    return F.col("ingested_at") <= HALF


def _upserted_events(spark: SparkSession, sf_dir: str) -> em.Table:
    """Later events, old cart removals turned into purchases, and one row without id."""
    events = adapter.bronze_events(spark, sf_dir)
    changed = _old() & (F.col("event_type") == "remove_from_cart")
    batch = events.filter(~_old() | changed).withColumn(
        "event_type", F.when(changed, "purchase").otherwise(F.col("event_type"))
    )
    no_id = events.agg(
        F.lit(None).cast("bigint").alias("event_id"),
        F.max("user_id").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.max("product_id").alias("product_id"),
        F.max("timestamp").alias("timestamp"),
        F.max("ingested_at").alias("ingested_at"),
    )
    table = Layout(scratch(spark))["bronze.events"]
    em.upsert(events.filter(_old()), table)
    em.upsert(batch.unionByName(no_id), table)
    return table


def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.read_table(spark, _upserted_events(spark, sf_dir))


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = em.merge_log(spark, _upserted_events(spark, sf_dir))
    return log.select("rows_inserted", "rows_updated")


def upsert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later sessions, and old sessions of Oslo with a new owner and no events."""
    sessions = adapter.bronze_sessions(spark, sf_dir)
    changed = _old() & (F.col("location.city") == "Oslo")
    batch = sessions.filter(~_old() | changed).withColumns(
        {
            "user_id": F.when(changed, "user_x").otherwise(F.col("user_id")),
            "events": F.when(changed, F.slice("events", 1, 0)).otherwise(F.col("events")),
        }
    )  # nested columns become variants in the table
    table = Layout(scratch(spark))["bronze.sessions"]
    em.upsert(sessions.filter(_old()), table)
    em.upsert(batch, table)
    return em.read_table(spark, table).select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        text_at("device", "$.os").alias("operating_system"),
        text_at("location", "$.city").alias("city"),
        _num_events(),
        "ingested_at",
    )


def _num_events() -> Column:
    return F.size(F.variant_get("events", "$", "array<variant>")).cast("bigint").alias("num_events")


def upsert_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later session events, and old purchases with another product."""
    flat = em.flatten_sessions(adapter.bronze_sessions(spark, sf_dir))
    changed = _old() & (F.col("event_type") == "purchase")
    batch = flat.filter(~_old() | changed).withColumn(
        "product_id", F.when(changed, "PROD_999").otherwise(F.col("product_id"))
    )
    table = Layout(scratch(spark))["silver.session_events"]
    em.upsert(flat.filter(_old()), table)
    em.upsert(batch, table)
    return em.read_table(spark, table)


def csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.read_events_csv(spark, _once(write_raw_files, spark, sf_dir)[0])


def json_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(write_raw_files, spark, sf_dir)[1]
    return _plain_sessions(em.read_sessions_json(spark, path, lines=True))


def json_array_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions from many files, each a top-level array."""
    return _plain_sessions(em.read_sessions_json(spark, _once(write_array_files, spark, sf_dir)))


def _plain_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        text_at("device", "$.browser").alias("browser"),
        text_at("location", "$.country").alias("country"),
        _num_events(),
    )


def write_rich_files(spark: SparkSession, sf_dir: str, batch: Column) -> str:
    """Sessions of a batch as JSON lines with fields that no table declares: a device model, event ids and prices."""
    path = f"{scratch(spark)}/sessions"
    values = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    keys = ["user_id", F.to_date("timestamp").alias("day")]
    priced = (
        adapter.bronze_events(spark, sf_dir)
        .join(values, "event_id")
        .groupBy(*keys, "ingested_at")
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.collect_list(
                F.struct(
                    F.col("event_type").alias("type"),
                    "product_id",
                    _iso("timestamp").alias("timestamp"),
                    F.struct(F.col("event_id").alias("id"), F.col("value").alias("price")).alias("detail"),
                )
            ).alias("events"),
        )
        .filter(batch)
    )
    rows = priced.select(
        F.concat_ws("_", F.lit("sess"), "user_id", "day").alias("session_id"),
        "user_id",
        *[_iso(c).alias(c) for c in ("start_time", "end_time")],
        F.struct(F.lit("Linux").alias("os"), F.concat(F.lit("model of "), "user_id").alias("model")).alias("device"),
        F.struct(F.lit("Oslo").alias("city"), F.array(F.lit(59.91), F.lit(10.75)).alias("place")).alias("location"),
        "events",
    )
    rows.write.json(path)
    return path


def load_damaged_files(spark: SparkSession, sf_dir: str) -> Layout:
    """Event files in which some lines lack a field and others have a malformed id; those are set aside."""
    path = f"{scratch(spark)}/events"
    events = adapter.bronze_events(spark, sf_dir).select(
        F.when(F.col("event_id") % 89 == 0, F.concat(F.lit("no. "), "event_id"))
        .otherwise(F.col("event_id").cast("string"))
        .alias("event_id"),
        "user_id",
        "event_type",
        F.coalesce("product_id", F.lit("")).alias("product_id"),
        F.when(F.col("event_id") % 97 != 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
    )
    # a line without a time has four fields
    events.select(F.concat_ws(",", *events.columns)).write.option("lineSep", "\n").text(path)
    layout = Layout(scratch(spark))
    em.run(spark, layout, "bronze", "events", events_csv=_with_header(spark, path), stamp=FILE_STAMP, rejects=True)
    return layout


def _with_header(spark: SparkSession, path: str) -> str:
    """The files with a header line in front, one line of each task's first."""
    lines = spark.read.text(path)
    headed = f"{path}-headed"
    lines.withColumnRenamed("value", "event_id,user_id,event_type,product_id,timestamp").write.option("header", True).option(
        "quote", ""
    ).option("sep", "\u0001").csv(headed)
    return headed


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each line that could not be read."""
    layout = _once(load_damaged_files, spark, sf_dir)
    rejects = em.read_rejects(spark, layout.rejects_path("bronze.events"))
    return rejects.select("line", F.col("load").cast("timestamp_ntz").alias("load"), F.col("file").endswith(".csv").alias("from_csv"))


def accepted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the other lines."""
    return _table(load_damaged_files, "bronze.events", spark, sf_dir)


def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merges of a table whose load ran again without anything new, and the mark it was left with."""
    layout = Layout(scratch(spark))
    em.upsert(adapter.bronze_events(spark, sf_dir), layout["bronze.events"])
    for _ in range(2):
        counts = em.run(spark, layout, "silver", "events")["silver.events_cleaned"]
    table = layout["silver.events_cleaned"]
    log = em.merge_log(spark, table).agg(F.count("*").alias("merges"), F.sum("rows_inserted").alias("rows_inserted"))
    return log.select(
        "merges",
        "rows_inserted",
        F.lit(counts.rows_inserted + counts.rows_updated).cast("bigint").alias("rows_of_second_run"),
        ntz(em.high_water_mark(spark, table)).alias("mark"),
    )


def stamped_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that came without a stamp: whether each was stamped during the load."""
    table = Layout(scratch(spark))["bronze.events"]
    start = spark.range(1).select(F.localtimestamp()).first()[0]
    em.upsert(adapter.bronze_events(spark, sf_dir).drop("ingested_at"), table)
    end = spark.range(1).select(F.localtimestamp()).first()[0]
    stored = em.read_table(spark, table)
    return stored.select("event_id", F.col("ingested_at").between(ntz(start), ntz(end)).alias("during_load"))


def undeclared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that no schema names, read back from the raw table after two loads, the second over part of the first."""
    layout = Layout(scratch(spark))
    for batch, stamp in ((F.col("ingested_at") <= LAST, "2024-02-01"), (F.col("ingested_at") > HALF, "2024-02-02")):
        path = write_rich_files(spark, sf_dir, batch)
        em.run(spark, layout, "bronze", "sessions", sessions_json=path, json_lines=True, stamp=stamp)
    sessions = em.read_table(spark, layout["bronze.sessions"])
    events = F.explode(F.variant_get("events", "$", "array<variant>"))
    return sessions.select("session_id", "device", "location", "ingested_at", events.alias("event")).select(
        "session_id",
        text_at("device", "$.model").alias("model"),
        F.variant_get("location", "$.place[0]", "double").alias("latitude"),
        F.variant_get("event", "$.detail.id", "bigint").alias("event_id"),
        F.variant_get("event", "$.detail.price", "double").alias("price"),
        text_at("event", "$.type").alias("event_type"),
        "ingested_at",
    )


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user report, exported and read again."""
    path = scratch(spark)
    report = user_behavior(spark, sf_dir)
    em.write_report_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_two_batches, "gold.session_metrics", spark, sf_dir)
    return em.kpis(gold, "2024-01-01", LAST)


def kpis_end_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped during the end day are out of the range."""
    gold = _table(load_files, "gold.session_metrics", spark, sf_dir)
    return em.kpis(gold, "2024-01-01", "2024-02-01", zero_when_empty=True)


def kpis_whole_end_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_files, "gold.session_metrics", spark, sf_dir)
    return em.kpis(gold, "2024-01-01", "2024-02-01", whole_end_day=True)


def user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.user_behavior(_table(load_two_batches, "gold.user_metrics", spark, sf_dir), "2024-01-31")


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_two_batches, "gold.product_metrics", spark, sf_dir)
    return em.funnel(gold, "2024-01-01", "2024-01-31")


def funnel_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_two_batches, "gold.product_metrics", spark, sf_dir)
    return em.funnel(gold, "2023-01-01", "2023-01-31")


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_files, "gold.product_metrics", spark, sf_dir)
    return em.top_products(gold, "2024-01-01", "2024-02-02")


def hist_total_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_files, "gold.user_metrics", spark, sf_dir)
    return em.total_events_histogram(gold, "2024-02-01")


def hist_conversion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _table(load_files, "gold.user_metrics", spark, sf_dir)
    return em.conversion_rate_histogram(gold, "2024-02-01")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    table = functools.partial
    own = {
        "bronze_events": adapter.bronze_events,
        "clean_events": clean_events,
        "incremental_events": incremental_events,
        "flatten_sessions": flatten_sessions,
        "user_metrics": user_metrics,
        "user_metrics_touched": user_metrics_touched,
        "session_metrics": session_metrics,
        "session_metrics_touched": session_metrics_touched,
        "product_metrics": product_metrics,
        "product_metrics_touched": product_metrics_touched,
        "upsert_events": upsert_events,
        "upsert_counts": upsert_counts,
        "upsert_sessions": upsert_sessions,
        "upsert_session_events": upsert_session_events,
        "two_batch_events_cleaned": table(_table, load_two_batches, "silver.events_cleaned"),
        "two_batch_session_events": table(_table, load_two_batches, "silver.session_events"),
        "two_batch_user_metrics": table(_table, load_two_batches, "gold.user_metrics"),
        "two_batch_session_metrics": table(_table, load_two_batches, "gold.session_metrics"),
        "two_batch_product_metrics": table(_table, load_two_batches, "gold.product_metrics"),
        "lifetime_user_metrics": table(_table, load_lifetime, "gold.user_metrics"),
        "lifetime_session_metrics": table(_table, load_lifetime, "gold.session_metrics"),
        "lifetime_product_metrics": table(_table, load_lifetime, "gold.product_metrics"),
        "csv_events": csv_events,
        "json_sessions": json_sessions,
        "json_array_sessions": json_array_sessions,
        "undeclared_fields": undeclared_fields,
        "rejected_lines": rejected_lines,
        "accepted_lines": accepted_lines,
        "empty_batch": empty_batch,
        "stamped_now": stamped_now,
        "files_user_metrics": table(_table, load_files, "gold.user_metrics"),
        "files_session_metrics": table(_table, load_files, "gold.session_metrics"),
        "files_product_metrics": table(_table, load_files, "gold.product_metrics"),
        "kpis": kpis,
        "kpis_end_midnight": kpis_end_midnight,
        "kpis_whole_end_day": kpis_whole_end_day,
        "user_behavior": user_behavior,
        "report_csv": report_csv,
        "funnel": funnel,
        "funnel_empty": funnel_empty,
        "top_products": top_products,
        "hist_total_events": hist_total_events,
        "hist_conversion_rate": hist_conversion_rate,
    }
    if training:
        own |= training.QUERIES
    if corpus_pipeline:
        own["pipeline"] = corpus_pipeline.run
    return own


# SQL twins

_BRONZE = """
bronze AS (
  SELECT event_id,
    'user_' || user_id AS user_id,
    CASE event_type WHEN 'view' THEN 'view_product' WHEN 'click' THEN 'add_to_cart'
      WHEN 'error' THEN 'remove_from_cart' ELSE event_type END AS event_type,
    CASE WHEN event_type <> 'signup'
      THEN 'PROD_' || lpad(json_extract_string(props, '$.k'), 3, '0') END AS product_id,
    ts AS "timestamp",
    CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS ingested_at
  FROM events)"""

_FLAT = f"""{_BRONZE},
keyed AS (
  SELECT *, CAST(substr(user_id, 6) AS INTEGER) AS number,
    'sess_' || substr(user_id, 6) || '_' || strftime("timestamp", '%Y%m%d') AS session_id
  FROM bronze),
flat AS (
  SELECT session_id, user_id,
    min("timestamp") OVER (PARTITION BY session_id) AS start_time,
    max("timestamp") OVER (PARTITION BY session_id) AS end_time,
    event_type, product_id,
    ['Chrome', 'Firefox', 'Safari', 'Edge'][number % 4 + 1] AS browser,
    ['Windows', 'macOS', 'Linux', 'iOS', 'Android'][number % 5 + 1] AS operating_system,
    'Norway' AS country,
    ['Oslo', 'Bergen', 'Stavanger', 'Trondheim'][number % 4 + 1] AS city,
    "timestamp" AS event_timestamp, ingested_at
  FROM keyed),
sessions AS (
  SELECT session_id, user_id, start_time, end_time, operating_system, browser, country, city,
    ingested_at, count(*) AS num_events
  FROM flat GROUP BY ALL)"""


def _user_sql(source: str, stamp: str) -> str:
    return f"""
  SELECT user_id, count(*) AS total_events,
    count(*) FILTER (event_type = 'purchase') AS num_purchases,
    count(*) FILTER (event_type IN ('view_product', 'add_to_cart', 'remove_from_cart'))
      AS num_clicks,
    CASE WHEN num_clicks = 0 THEN 0.0::DOUBLE
      ELSE num_purchases::DOUBLE / num_clicks END AS conversion_rate,
    {stamp} AS ingested_at
  FROM {source} GROUP BY user_id"""


def _session_sql(source: str, stamp: str) -> str:
    return f"""
  SELECT session_id, user_id,
    avg(date_diff('minute', start_time, end_time)) AS session_duration_minutes,
    count(*) AS num_events, count(*) = 1 AS is_bounce,
    {stamp} AS ingested_at
  FROM {source} GROUP BY session_id, user_id"""


def _product_sql(source: str, stamp: str) -> str:
    return f"""
  SELECT product_id,
    count(*) FILTER (event_type = 'view_product') AS num_views,
    count(*) FILTER (event_type = 'add_to_cart') AS num_add_to_cart,
    count(*) FILTER (event_type = 'purchase') AS num_purchases,
    CASE WHEN num_views + num_add_to_cart = 0 THEN 0.0::DOUBLE
      ELSE num_purchases::DOUBLE / (num_views + num_add_to_cart) END AS click_to_purchase_rate,
    {stamp} AS ingested_at
  FROM {source} GROUP BY product_id"""


def _max_stamp(source: str) -> str:
    return f"(SELECT max(ingested_at) FROM {source})"


def _two_batch_sql(metrics: Callable[[str, str], str], source: str, key: str) -> str:
    """CTE ``gold``: the second batch's rows replace those of the first."""
    return f"""{_FLAT},
first_rows AS (SELECT * FROM {source} WHERE ingested_at <= '{LAST}'),
last_rows AS (SELECT * FROM {source} WHERE ingested_at > '{LAST}'),
m1 AS ({metrics('first_rows', _max_stamp('first_rows'))}),
m2 AS ({metrics('last_rows', _max_stamp('last_rows'))}),
gold AS (
  SELECT * FROM m2 UNION ALL
  SELECT * FROM m1 WHERE NOT EXISTS (SELECT 1 FROM m2 WHERE m2.{key} = m1.{key}))"""


def _touched_sql(metrics: Callable[[str, str], str], source: str, key: str) -> str:
    stamp = _max_stamp(source)
    return f"""WITH {_FLAT},
touched AS (
  SELECT * FROM {source} WHERE EXISTS (
    SELECT 1 FROM {source} AS n
    WHERE n.ingested_at > '{LAST}' AND n.{key} IS NOT DISTINCT FROM {source}.{key}))
{metrics('touched', stamp)}"""


def _lifetime_sql(metrics: Callable[[str, str], str], source: str, key: str) -> str:
    """Metrics over all rows as they are after the second batch; keys it did not touch keep the first one's stamp."""
    moved = f"ingested_at <= '{LAST}' AND event_id % 40 = 0"
    return f"""WITH {_FLAT},
before AS (SELECT * FROM {source}),
after AS (
  SELECT * FROM flat UNION ALL BY NAME SELECT * FROM (
  SELECT * REPLACE (CASE WHEN {moved} THEN 'user_moved' ELSE user_id END AS user_id,
    CASE WHEN {moved} THEN NULL ELSE product_id END AS product_id,
    CASE WHEN {moved} OR ingested_at > '{LAST}' THEN TIMESTAMP '{FILE_STAMP}' ELSE ingested_at END AS ingested_at)
  FROM bronze)),
rows_after AS (SELECT * FROM after WHERE {'session_id IS NOT NULL' if source == 'flat' else 'session_id IS NULL'}),
touched AS (
  SELECT {key} FROM rows_after WHERE ingested_at > '{LAST}'
  {'' if source == 'flat' else f"UNION SELECT {key} FROM before WHERE {moved}"}),
metrics AS ({metrics('rows_after', _max_stamp('rows_after'))})
SELECT m.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM touched AS t WHERE t.{key} IS NOT DISTINCT FROM m.{key})
  THEN m.ingested_at ELSE TIMESTAMP '{LAST}' END AS ingested_at) FROM metrics AS m"""


def _histogram_sql(column: str) -> str:
    return f"""WITH {_BRONZE},
gold AS ({_user_sql('bronze', f"TIMESTAMP '{FILE_STAMP}'")}),
bounds AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM gold),
binned AS (
  SELECT lo, hi, CASE WHEN lo = hi THEN 1
    ELSE least(CAST(floor(({column} - lo) / (hi - lo) * 20) AS INTEGER) + 1, 20) END AS bin
  FROM gold, bounds)
SELECT bin::INTEGER AS bin, lo + (bin - 1) * ((hi - lo) / 20) AS bin_lo,
  lo + bin * ((hi - lo) / 20) AS bin_hi, count(*) AS num_users
FROM binned GROUP BY bin, lo, hi"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the given tables."""
    two_users = _two_batch_sql(_user_sql, "bronze", "user_id")
    two_sessions = _two_batch_sql(_session_sql, "flat", "session_id")
    two_products = _two_batch_sql(_product_sql, "bronze", "product_id")
    file_stamp = f"TIMESTAMP '{FILE_STAMP}'"
    upsert_source = f"""WITH {_FLAT},
old_events AS (SELECT * FROM bronze WHERE ingested_at <= '{HALF}'),
source AS (
  SELECT * FROM bronze WHERE ingested_at > '{HALF}' UNION ALL
  SELECT * REPLACE ('purchase' AS event_type) FROM old_events
    WHERE event_type = 'remove_from_cart' UNION ALL
  SELECT NULL, max(user_id), 'purchase', max(product_id), max("timestamp"), max(ingested_at)
    FROM bronze)"""
    own = {
        "bronze_events": f"WITH {_BRONZE} SELECT * FROM bronze",
        "clean_events": f"""WITH {_BRONZE},
dirty AS (
  SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS event_type,
    product_id, CASE WHEN event_id % 101 <> 0 THEN "timestamp" END AS "timestamp", ingested_at
  FROM bronze UNION ALL
  SELECT event_id, user_id, 'PURCHASE', product_id, "timestamp", ingested_at + INTERVAL 1 DAY
  FROM bronze WHERE event_type = 'view_product')
SELECT event_id, user_id, lower(event_type) AS event_type, product_id, "timestamp", ingested_at
FROM dirty
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
  AND "timestamp" IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC, "timestamp" DESC,
  user_id NULLS LAST, event_type NULLS LAST, product_id NULLS LAST) = 1""",
        "incremental_events": f"""WITH {_BRONZE}
SELECT * FROM bronze
WHERE ingested_at > (SELECT max(ingested_at) FROM bronze WHERE ingested_at <= '{LAST}')""",
        "flatten_sessions": f"WITH {_FLAT} SELECT * FROM flat",
        "user_metrics": f"WITH {_BRONZE} {_user_sql('bronze', _max_stamp('bronze'))}",
        "user_metrics_touched": _touched_sql(_user_sql, "bronze", "user_id"),
        "session_metrics": f"WITH {_FLAT} {_session_sql('flat', _max_stamp('flat'))}",
        "session_metrics_touched": _touched_sql(_session_sql, "flat", "session_id"),
        "product_metrics": f"WITH {_BRONZE} {_product_sql('bronze', _max_stamp('bronze'))}",
        "product_metrics_touched": _touched_sql(_product_sql, "bronze", "product_id"),
        "upsert_events": f"""{upsert_source}
SELECT * FROM source UNION ALL
SELECT * FROM old_events AS o
WHERE NOT EXISTS (SELECT 1 FROM source AS s WHERE s.event_id = o.event_id)""",
        "upsert_counts": f"""{upsert_source}
SELECT count(*) AS rows_inserted, 0::BIGINT AS rows_updated FROM old_events UNION ALL
SELECT count(*) FILTER (o.event_id IS NULL), count(*) FILTER (o.event_id IS NOT NULL)
FROM source AS s LEFT JOIN old_events AS o ON s.event_id = o.event_id""",
        "upsert_sessions": f"""WITH {_FLAT}
SELECT session_id,
  CASE WHEN moved THEN 'user_x' ELSE user_id END AS user_id,
  start_time, end_time, operating_system, city,
  CASE WHEN moved THEN 0 ELSE num_events END AS num_events, ingested_at
FROM (SELECT *, city = 'Oslo' AND ingested_at <= '{HALF}' AS moved FROM sessions)""",
        "upsert_session_events": f"""WITH {_FLAT}
SELECT * REPLACE (CASE WHEN event_type = 'purchase' AND ingested_at <= '{HALF}'
  THEN 'PROD_999' ELSE product_id END AS product_id) FROM flat""",
        "two_batch_events_cleaned": f"WITH {_BRONZE} SELECT * FROM bronze",
        "two_batch_session_events": f"WITH {_FLAT} SELECT * FROM flat",
        "two_batch_user_metrics": f"WITH {two_users} SELECT * FROM gold",
        "two_batch_session_metrics": f"WITH {two_sessions} SELECT * FROM gold",
        "two_batch_product_metrics": f"WITH {two_products} SELECT * FROM gold",
        "lifetime_user_metrics": _lifetime_sql(_user_sql, "bronze", "user_id"),
        "lifetime_session_metrics": _lifetime_sql(_session_sql, "flat", "session_id"),
        "lifetime_product_metrics": _lifetime_sql(_product_sql, "bronze", "product_id"),
        "csv_events": f"WITH {_BRONZE} SELECT * EXCLUDE (ingested_at) FROM bronze",
        "json_sessions": f"""WITH {_FLAT}
SELECT session_id, user_id, start_time, end_time, browser, country, num_events
FROM sessions""",
        "json_array_sessions": f"""WITH {_FLAT}
SELECT session_id, user_id, start_time, end_time, browser, country, num_events
FROM sessions""",
        "rejected_lines": f"""WITH {_BRONZE}
SELECT concat_ws(',', CASE WHEN event_id % 89 = 0 THEN 'no. ' || event_id ELSE event_id::VARCHAR END, user_id, event_type,
    coalesce(product_id, ''), CASE WHEN event_id % 97 <> 0 THEN replace(strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f'), ' ', 'T') END) AS line,
  TIMESTAMP '{FILE_STAMP}' AS load, true AS from_csv
FROM bronze WHERE event_id % 89 = 0 OR event_id % 97 = 0""",
        "accepted_lines": f"""WITH {_BRONZE}
SELECT * REPLACE (TIMESTAMP '{FILE_STAMP}' AS ingested_at) FROM bronze WHERE event_id % 89 <> 0 AND event_id % 97 <> 0""",
        "empty_batch": f"""WITH {_BRONZE}
SELECT 1::BIGINT AS merges, count(*) AS rows_inserted, 0::BIGINT AS rows_of_second_run, max(ingested_at) AS mark FROM bronze""",
        "stamped_now": "SELECT event_id, true AS during_load FROM events",
        "undeclared_fields": f"""WITH {_BRONZE}
SELECT 'sess_' || b.user_id || '_' || strftime(b."timestamp", '%Y-%m-%d') AS session_id,
  'model of ' || b.user_id AS model, 59.91::DOUBLE AS latitude, b.event_id, e.value AS price, b.event_type,
  CASE WHEN b.ingested_at > '{HALF}' THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS ingested_at
FROM bronze AS b JOIN events AS e ON e.event_id = b.event_id""",
        "files_user_metrics": f"WITH {_BRONZE} {_user_sql('bronze', file_stamp)}",
        "files_session_metrics": f"WITH {_FLAT} {_session_sql('flat', file_stamp)}",
        "files_product_metrics": f"WITH {_BRONZE} {_product_sql('bronze', file_stamp)}",
        "kpis": f"""WITH {two_sessions}
SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
  avg(session_duration_minutes) AS avg_session_duration
FROM gold WHERE ingested_at BETWEEN '2024-01-01' AND '{LAST}'""",
        "kpis_end_midnight": f"""WITH {_FLAT}, gold AS ({_session_sql('flat', file_stamp)})
SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
  coalesce(avg(session_duration_minutes), 0.0::DOUBLE) AS avg_session_duration
FROM gold WHERE ingested_at BETWEEN '2024-01-01' AND '2024-02-01'""",
        "kpis_whole_end_day": f"""WITH {_FLAT}, gold AS ({_session_sql('flat', file_stamp)})
SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
  avg(session_duration_minutes) AS avg_session_duration
FROM gold WHERE CAST(ingested_at AS DATE) BETWEEN '2024-01-01' AND '2024-02-01'""",
        "user_behavior": f"""WITH {two_users}
SELECT user_id, total_events, num_purchases, num_clicks, conversion_rate
FROM gold WHERE CAST(ingested_at AS DATE) BETWEEN '2024-01-31' AND '2024-01-31'""",
        "report_csv": f"""WITH {two_users}
SELECT user_id, total_events, num_purchases, num_clicks, conversion_rate
FROM gold WHERE CAST(ingested_at AS DATE) BETWEEN '2024-01-31' AND '2024-01-31'""",
        "funnel": f"""WITH {two_products}
SELECT coalesce(sum(num_views), 0)::BIGINT AS views,
  coalesce(sum(num_add_to_cart), 0)::BIGINT AS add_to_cart,
  coalesce(sum(num_purchases), 0)::BIGINT AS purchases
FROM gold WHERE ingested_at BETWEEN '2024-01-01' AND '2024-01-31'""",
        "funnel_empty": f"""WITH {two_products}
SELECT coalesce(sum(num_views), 0)::BIGINT AS views,
  coalesce(sum(num_add_to_cart), 0)::BIGINT AS add_to_cart,
  coalesce(sum(num_purchases), 0)::BIGINT AS purchases
FROM gold WHERE ingested_at BETWEEN '2023-01-01' AND '2023-01-31'""",
        "top_products": f"""WITH {_BRONZE}, gold AS ({_product_sql('bronze', file_stamp)})
SELECT product_id, num_purchases, num_add_to_cart, num_views
FROM gold WHERE ingested_at BETWEEN '2024-01-01' AND '2024-02-02'
ORDER BY num_purchases DESC, product_id ASC NULLS LAST LIMIT 10""",
        "hist_total_events": _histogram_sql("total_events"),
        "hist_conversion_rate": _histogram_sql("conversion_rate"),
    }
    if training:
        own |= training.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
