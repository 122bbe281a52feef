from __future__ import annotations

import re
from collections import defaultdict

import pytest

from eventmart.llm import mixing


def _targets(sizes, weights, total, cap):
    """Water-filling by bisection of the level."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(cap * s, w * level) for s, w in zip(sizes, weights)) < total:
            low = level
        else:
            high = level
    return [min(cap * s, w * high) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 1000, 500, 3, 90], [5, 5, 5], [0, 100, 1], [7]])
def test_water_fill(spark, sizes):
    rows = [(f"s{i}", n, float(i % 3 + 1)) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(table, float(sum(sizes)), 3.0).collect()}
    want = _targets(sizes, [r[2] for r in rows], sum(sizes), 3.0)
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want, abs=1e-6)


def test_mix_reaches_targets(documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    taken, sizes, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
    names = sorted(sizes)
    want = _targets([sizes[s] for s in names], [i % 3 + 1 for i in range(len(names))], sum(sizes.values()), 3.0)
    for s, t in zip(names, want):
        assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 1
    assert sorted(rows) == sorted(mixing.mix(documents.repartition(7)).collect())
    assert sorted(rows) != sorted(mixing.mix(documents, seed=1).collect())


def test_many_buckets_of_one_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rows = [(i, "w " * (i % 9), "hot" if i % 3 else "other") for i in range(600)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("hot", "other"):
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


def test_null_source_is_last(spark):
    rows = [(1, "a b", None), (2, "a b", "x"), (3, "a b", "B")]
    found = {r.source: r.weight for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found == {"B": 1.0, "x": 2.0, None: 3.0}


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, "a b c d e", "xyz"[i % 3]) for i in range(30)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("x", 1.0), ("y", 1.0)], "source string, weight double")
    found = mixing.mix(docs, weights).collect()
    assert {r.source: r.target for r in found} == {"x": 75.0, "y": 75.0, "z": 0.0}


def test_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.size == r.taken == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert sum(r.taken for r in rows if r.source == "a") == pytest.approx(next(r.target for r in rows if r.source == "a"), abs=1)
    assert mixing.mix(none).count() == 0


def test_repeated_rows_are_the_mix(documents, odd):
    for docs in (documents, odd):
        plan = defaultdict(int)
        for r in mixing.mix(docs).collect():
            plan[r.source] += r.taken
        rows = mixing.repeated(docs)
        assert rows.columns == docs.columns
        words = defaultdict(int)
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in rows.collect():
            words[r.source] += len(re.findall(mixing.WORD, r.text))
            assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        if docs is documents:
            assert all(words[s] == n for s, n in plan.items() if n)
