"""The prefix trie of conversations against one built by hand from all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from eventmart.llm import turn_trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    """All nodes, from the prefixes of all rebuilt conversations."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(listed)] for c, listed in own.items()}
    rebuilt = {}
    for c, listed in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + listed[h:]
    nodes, below = defaultdict(list), defaultdict(list)
    for c, listed in rebuilt.items():
        for depth in range(len(listed) + 1):
            nodes[tuple(listed[:depth])].append(c)
    for path in nodes:
        if path:
            below[path[:-1]].append(path)
    totals, found = {}, []
    for path in sorted(nodes, key=len, reverse=True):
        words = len(WORD.findall(path[-1][1])) if path else 0
        leaves = sum(totals[k][0] for k in below[path]) or 1
        totals[path] = leaves, (len(nodes[path]) - 1) * words + sum(totals[k][1] for k in below[path])
        ends = ",".join(str(c) for c in sorted(nodes[path]) if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        size = len(nodes[path]), len(below[path])
        found.append((min(nodes[path]), len(path), parent, *size, *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def nodes_of(spark, rows, limit):
    found = turn_trie.prefix_nodes(spark.createDataFrame(rows, SCHEMA), limit)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("limit", [20_000, 12])
def test_nodes(spark, limit):
    """Shared prefixes, copies, conversations that end within others, null turns; few and many containers."""
    rng = random.Random(3)
    rows = []
    for c in [*range(60), *range(100, 140), 9_007_199_254_740_993]:
        listed = [("u", f"a {i % 3} b") for i in range(rng.choice([0, 1, 2, 5, 30]))]
        listed += [("v", rng.choice(["x", "y z", ""])) for _ in range(rng.choice([0, 1, 2]))]
        if rng.random() < 0.3:
            listed = [("u", "a 0 b")]
        rows += [(c, None if i == 0 and rng.random() < 0.5 else i, r, t) for i, (r, t) in enumerate(listed)]
    rows += [(7, i, "u", "a 1 b") for i in range(100, 300)]
    rows += [(None, 1, "u", "no conversation"), (9, 40, None, None), (9, 40, None, None)]
    assert nodes_of(spark, rows, limit) == plain(rows)


def test_common_turn_and_copies_are_split(spark):
    """Most conversations start alike and many are equal; one is long."""
    rows = [(c, i, "system", "be kind") for c in range(300) for i in range(4)]
    rows += [(c, 9, "user", f"question {c % 7}") for c in range(0, 300, 2)]
    rows += [(c, 10, "bot", f"answer {c}") for c in range(0, 300, 6)]
    rows += [(401, i, "bot", "so on") for i in range(900)]
    assert nodes_of(spark, rows, 50) == plain(rows)


def test_order_of_equal_turn_numbers_is_fixed(spark):
    rows = [(0, 1, "u", t) for t in ("b", "a", "c")] + [(40, 1, "u", t) for t in ("c", "a", "b")]
    found = nodes_of(spark, rows, 20_000)
    assert [r[3] for r in found] == [2, 2, 2, 2]


def test_turnless_and_empty(spark):
    """A conversation whose turns are all replaced by those of an absent one is the root alone."""
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(c, 0, "u", "gone")]
    assert nodes_of(spark, rows, 20_000) == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert nodes_of(spark, [], 20_000) == []
    assert nodes_of(spark, [(None, 0, "u", "x")], 20_000) == []


def test_other_columns_are_ignored(spark):
    rows = [(0, 0, "u", "hello there", 1, 2, 3, "x"), (1, 0, "u", "hello there", 1, 2, 3, "y")]
    more = spark.createDataFrame(rows, SCHEMA + ", pos long, rep long, depth long, words string")
    assert sorted(map(tuple, turn_trie.prefix_nodes(more).collect()), key=str) == plain([r[:4] for r in rows])
