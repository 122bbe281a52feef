"""The registered queries and the pipeline on the small tables."""

from __future__ import annotations

from collections import defaultdict

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from eventmart.llm import common, language, mixing, order_minhash, quality
from eventmart.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    1: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    2: "doc_id bigint, held_out boolean, score double, predicted int",
    3: "doc_id bigint, held_out boolean, score double, predicted int",
    4: "query_id bigint, rank int, vec_id bigint, score double",
    5: "doc_id bigint, n_tokens bigint",
    6: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    7: "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    8: "doc_id bigint, held_out boolean, lang_pred string, score double",
    9: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    10: "doc_id bigint, class_id bigint",
    11: "conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    12: "doc_id bigint, fingerprint string, component_id bigint",
    13: "word string, root string, n bigint, n_near bigint",
}


def test_all_are_registered():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_results_have_the_agreed_columns(spark, sf, name):
    found = QUERIES[name](spark, sf)
    kinds = dict(found.dtypes)
    number = int(name[2:].split("_")[0])
    for column in COLUMNS[number].split(", "):
        title, kind = column.split(" ")
        assert kinds[title] == kind
    rows, documents = found.collect(), spark.read.parquet(f"{sf}/documents.parquet").count()
    if number not in (1, 4, 11, 13):
        assert len(rows) == documents
    assert rows and all(r[c] is not None for r in rows for c in (x.split(" ")[0] for x in COLUMNS[number].split(", ")))


def test_sql_twins(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("conversations",):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, sql in ORACLE_SQL.items():
        found = QUERIES[name](spark, sf)
        want = connection.sql(sql)
        columns = sorted(found.columns)
        assert columns == sorted(want.columns)
        rows = want.select(", ".join(columns)).fetchall()
        assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(rows, key=str)


def test_pipeline_stages(spark, sf):
    """Each stage against what its operator says of its own input."""
    docs = common.stored(spark.read.parquet(f"{sf}/documents.parquet"))
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        names.append(name)
        after = common.stored(stage(spark, docs, sf))
        assert after.columns == corpus_pipeline.COLUMNS
        before, kept = {r.doc_id: r for r in docs.collect()}, after.collect()
        if name == "quality":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            scores = {r.doc_id: r.score for r in quality.score(docs, labels, common.F.lit(True)).collect()}
            assert {r.doc_id for r in kept} == {i for i, s in scores.items() if s >= 0.5}
        elif name == "language":
            sure = {r.doc_id for r in language.identify(docs, language.learn(docs)).collect() if r.certain}
            assert {r.doc_id for r in kept} == sure
        elif name == "near_copies":
            runs = {i: order_minhash.runs_of(order_minhash.words_of(r.text)) for i, r in before.items()}
            root = {i: i for i in runs}
            for a in sorted(runs):
                for b in sorted(runs):
                    if a < b and order_minhash.alignment(runs[a], runs[b]) > 0:
                        old, new = max(root[a], root[b]), min(root[a], root[b])
                        root = {i: new if r == old else r for i, r in root.items()}
            assert sorted(r.doc_id for r in kept) == sorted(set(root.values()))
        else:
            taken, words = defaultdict(int), defaultdict(int)
            for r in mixing.mix(docs).collect():
                taken[r.doc_id] += r.taken
            sizes = mixing.size_of(common.F.col("text")).alias("n")
            for r in after.select("doc_id", sizes).collect():
                words[r.doc_id] += r.n
            assert words == {i: n for i, n in taken.items() if n}
        if name != "mixing":
            assert all(r == before[r.doc_id] for r in kept)
        docs = after
    assert names == ["quality", "language", "near_copies", "mixing"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.piece == 0 for r in packed) == docs.count()


def test_pipeline_runs(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_stages_of_odd_and_empty_tables(spark, odd, none, sf):
    for start in (odd.select(*corpus_pipeline.COLUMNS), none.select(*corpus_pipeline.COLUMNS)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, start, sf).count()
