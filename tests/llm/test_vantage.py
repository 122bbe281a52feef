"""Vantage-point trees and SimHash components against all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from eventmart.llm import vantage

LOWER = str.maketrans(vantage.UPPER, vantage.LOWER)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(shingles))


def plain_roots(points, radius=3):
    """The smallest index of each component, by comparing all pairs."""
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i] ^ points) <= radius):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(points))]


def clustered(rng, size):
    """Random fingerprints, near copies, chains of near copies, and a dense ball that shares one half."""
    points = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (size, 3)).astype(np.uint64)
    near = points ^ np.bitwise_or.reduce(flips, axis=1)
    chain = [points[0]]
    for bit in range(0, 60, 2):
        chain.append(chain[-1] ^ np.uint64(3 << bit))
    ball = points[1] ^ rng.integers(0, 1 << 9, size // 2).astype(np.uint64)
    return np.unique(np.concatenate([points, near, chain, ball]))


@pytest.mark.parametrize("half", vantage.HALVES)
def test_near_points_meet_in_a_home_leaf(half):
    rng = np.random.default_rng(5)
    points = clustered(rng, 1500)
    tree = vantage.grow(points[::3], half, 8)
    assert tree.leaves > 20
    at, leaf, home = vantage.route(tree, points, np.ones(len(points), dtype=bool))
    assert sorted(at[home]) == list(range(len(points)))
    assert len(at) < 0.3 * tree.leaves * len(points)  # most leaves are pruned
    own = dict(zip(at[home], leaf[home]))
    seen = set(zip(at, leaf))
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i] ^ points) <= 3):
            if np.bitwise_count((points[i] ^ points[j]) & np.uint64(half)) <= 1:
                assert (i, own[int(j)]) in seen or (int(j), own[i]) in seen


def test_search_of_a_large_shard(monkeypatch):
    monkeypatch.setattr(vantage, "WORK", 1000)
    points = clustered(np.random.default_rng(6), 700)
    forest = vantage.Forest(len(points))
    for half in vantage.HALVES:
        vantage.search(points, np.ones(len(points), dtype=bool), np.arange(len(points)), forest, half)
    assert forest.label.tolist() == plain_roots(points)


def test_links_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(vantage, "LEAF", 64)
    points = clustered(np.random.default_rng(7), 1500)
    prints = spark.createDataFrame([(int(p),) for p in points.view(np.int64)] * 2, "fp long")
    found = vantage.links(prints).collect()
    assert len(found) < 6 * len(points)
    place = {int(p): i for i, p in enumerate(points.view(np.int64))}
    forest = vantage.Forest(len(points))
    forest.join(np.array([place[r.a] for r in found]), np.array([place[r.b] for r in found]))
    assert forest.label.tolist() == plain_roots(points)


def test_components_of_documents(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    points = np.array([plain_fingerprint(r.text) for r in rows], dtype=np.uint64)
    roots = plain_roots(points)
    smallest = {}
    for row, root in zip(rows, roots):
        smallest[root] = min(row.doc_id, smallest.get(root, row.doc_id))
    want = [(r.doc_id, f"{p:016x}", smallest[root]) for r, p, root in zip(rows, points, roots)]
    assert len(set(roots)) < len(rows)
    assert sorted(map(tuple, vantage.near_components(documents).collect())) == sorted(want)


def test_odd_and_empty(spark, odd, none):
    """Null, empty and wordless texts have fingerprint 0 and are one component; repeated rows stay."""
    found = vantage.near_components(odd).collect()
    prints = sorted((r.doc_id or -1, r.fingerprint) for r in found)
    assert prints == sorted((r.doc_id or -1, f"{plain_fingerprint(r.text):016x}") for r in odd.collect())
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {2}
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert vantage.near_components(none).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d"), (5, "A  b c D"), (None, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in vantage.near_components(nulls).collect()) == [(0, 0), (0, 5), (5, 5)]
