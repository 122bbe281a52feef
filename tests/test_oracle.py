"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import datetime as dt
import os
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_module

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")

QUERIES = {n: q for n, q in entry_module.queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)}

KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def _sort_key(row):
    return tuple((value is None, "" if value is None else repr(value)) for value in row)


def _plain(value):
    assert not isinstance(value, dt.datetime) or value.tzinfo is None
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    columns = sorted(df.columns)
    relation = duck.sql(entry_module.oracle_sql()[name])
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: t for c, t in df.dtypes} == {c: KINDS[t] for c, t in kinds.items()}
    got = [tuple(map(_plain, row)) for row in df.select(*columns).collect()]
    want = relation.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert len(got) == len(want)
    assert sorted(got, key=_sort_key) == sorted(want, key=_sort_key)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 15
