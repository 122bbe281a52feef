"""Near-duplicates, fingerprints and neighbours against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventmart.llm import ann, common, order_minhash, simhash


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(200, 300 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == _roots(nodes, [x for x in links if x[0] != x[1]])


def test_components_of_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Order MinHash


def _longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randint(1, 30) for _ in range(rng.randint(1, 50))]
        b = [x for x in a if rng.random() > 0.07] + [rng.randint(1, 30) for _ in range(rng.randint(0, 4))]
        if not b:
            continue
        m = _longest_common(a, b)
        similarity = m / (len(a) + len(b) - m)
        got = order_minhash.alignment(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == (pytest.approx(similarity) if similarity >= 0.8 - 1e-12 else 0.0)


def test_bitmaps_refuse_no_similar_texts():
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(1500):
        a = rng.integers(0, rng.choice([5, 100, 10**6]), rng.integers(1, 400)).astype(np.uint64)
        b = a.copy()
        b[rng.random(len(b)) < rng.choice([0.02, 0.1, 0.3])] = rng.integers(0, 10**6)
        b = np.delete(b, np.flatnonzero(rng.random(len(b)) < 0.03))
        if order_minhash.alignment(a, b) == 0:
            continue
        met += 1
        differ = sum(int(x).bit_count() for x in (order_minhash.bitmap(a) ^ order_minhash.bitmap(b)).view(np.uint64))
        least = int(np.ceil(0.8 / 1.8 * (len(a) + len(b)) - 1e-9))
        assert differ <= len(a) + len(b) - 2 * least
    assert met > 300


def test_sketches_keep_the_order():
    words = [f"w{i}" for i in range(400)]
    runs = order_minhash.runs_of(words)
    turned = order_minhash.runs_of(words[200:] + words[:200])
    same = order_minhash.sketches(runs) == order_minhash.sketches(order_minhash.runs_of(list(words)))
    assert same.all()
    assert (order_minhash.sketches(runs) == order_minhash.sketches(turned)).mean() < 0.5
    assert len(set(order_minhash.labelled(order_minhash.runs_of(["a"] * 50)).tolist())) == 46


def _edited(words, rate, rng):
    return [f"e{rng.random()}" if rng.random() < rate else w for w in words]


def _near_texts():
    rng = random.Random(8)
    texts, passage = {}, " ".join(f"p{i}" for i in range(12))
    for group in range(12):
        base = [f"g{group}x{rng.randint(0, 300)}" for _ in range(rng.randint(20, 200))]
        for _ in range(6):
            texts[len(texts)] = " ".join(_edited(base, rng.choice([0, 0.01, 0.02, 0.05, 0.2]), rng))
    for i in range(60):  # a chain: neighbours are near, the ends are not
        texts[1000 + i] = " ".join(f"c{j}" for j in range(3 * i, 3 * i + 150))
    for i in range(150):  # short texts that share a passage
        texts[2000 + i] = f"{passage} {' '.join(f'u{i}x{j}' for j in range(6))}"
    for i in range(80):
        texts[3000 + i] = "One and the SAME text, again!" if i % 2 else "one and the same text again"
    return texts


def test_classes_equal_brute_force(spark):
    texts = _near_texts()
    runs = {k: order_minhash.runs_of(order_minhash.words_of(t)) for k, t in texts.items()}
    ids = sorted(texts)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if order_minhash.alignment(runs[a], runs[b]) > 0]
    want = _roots(ids, links)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert got == want
    assert len({want[1000 + i] for i in range(60)}) == 1 and len({want[2000 + i] for i in range(150)}) == 150


def _brute_force(texts):
    runs = {k: order_minhash.runs_of(order_minhash.words_of(t)) for k, t in texts.items()}
    ids = sorted(texts)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if order_minhash.alignment(runs[a], runs[b]) > 0]
    return _roots(ids, links), links


def test_copies_that_only_their_base_connects(spark):
    rng = random.Random(5)
    texts = {}
    for group, (copies, size) in enumerate([(150, 200), (40, 100)]):
        base = [f"b{group}x{i}" for i in range(size)]
        for i in range(copies):
            words = list(base)
            for n, at in enumerate(rng.sample(range(10, size - 10, 10), size // 50)):
                words[at] = f"e{group}x{i}x{n}"
            texts[1000 * group + i] = " ".join(words)
        texts[9000 + group] = " ".join(base)
    want, links = _brute_force(texts)
    assert len(links) < 2 * len(texts) and len(set(want.values())) == 2
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()} == want


def test_short_texts_with_words_before_or_after(spark):
    rng = random.Random(6)
    texts = {}
    for n in range(5, 16):
        for _ in range(12):
            words = [f"s{rng.random()}" for _ in range(n)]
            more = [f"m{rng.random()}" for _ in range(2)]
            one = [words + more[:1], more[:1] + words][rng.random() < 0.5]
            for x in rng.sample([words, one, [more[0], *words, more[1]]], 3):
                texts[len(texts)] = " ".join(x)
    for i in range(300):  # texts that a hot one is in, which are not near each other
        texts[5000 + i] = "a hot line of just eight words here " + (f"v{i}" if i else "")
    for i in range(200):
        texts[6000 + i] = f"a line of seven words with {i}"
    want, links = _brute_force(texts)
    assert len(links) > 450 and len({want[5000 + i] for i in range(300)}) == 1 and len({want[6000 + i] for i in range(200)}) == 200
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()} == want


def test_similar_short_texts_meet():
    rng = random.Random(9)
    lost = tried = 0
    for n in range(4, 41):
        for _ in range(200):
            a = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
            kept = sorted(rng.sample(range(n), n - n // 5))
            b = a[kept] if n > 4 else np.r_[a, np.uint64(rng.getrandbits(64))]
            if rng.random() < 0.5 and n // 5 > 1:  # as many runs changed as may be
                changed = n // 9
                b = a.copy()
                for i in rng.sample(range(n), changed):
                    b[i] = rng.getrandbits(64)
            if order_minhash.alignment(a, b) == 0:
                continue
            tried += 1
            x, y = order_minhash.all_sketches(a), order_minhash.all_sketches(b)
            met = any(i == j for i, j in zip(x, y))
            p, q = order_minhash.left_out(a), order_minhash.left_out(b)
            if p is not None and q is not None:
                met = met or p[0] in q[1:] or q[0] in p[1:]
            lost += not met
    assert tried > 5000 and lost == 0


def test_classes_odd_rows(odd, none):
    rows = order_minhash.classes(odd).collect()
    assert len(rows) == odd.count()
    classes = {r.doc_id: r.class_id for r in rows}
    assert classes == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, None: None}
    assert order_minhash.classes(none).count() == 0
    kept = order_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]


def test_one_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (4, None)], "doc_id long, text string")
    got = order_minhash.classes(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


# SimHash


def _fingerprint(text):
    words = re.split(simhash.SPACES, (text or "").lower())
    votes, total = [0] * 128, 0
    for w in words:
        weight = min(len(w), 16) ** 2
        total += weight
        for i in range(2):
            h = xxhash.xxh64_intdigest(struct.pack("<i", i), xxhash.xxh64_intdigest(w.encode(), 42))
            for j in range(64):
                votes[64 * i + j] += weight * (h >> j & 1)
    longs = [sum(1 << j for j in range(64) if 2 * votes[64 * i + j] > total) for i in range(2)]
    return "".join(f"{x:016x}" for x in longs)


def _distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_fingerprints_equal_brute_force(odd, documents):
    for source in (odd, documents.limit(25)):
        texts = source.select("doc_id", "text").distinct().filter("doc_id is null or doc_id <> 7 or length(text) < 10000")
        got = simhash.fingerprints(texts, ["doc_id"]).collect()
        want = {r.doc_id: _fingerprint(r.text) for r in texts.collect()}
        assert {r.doc_id: r.fingerprint for r in got} == want


def test_edited_likeness(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = simhash.edited_likeness(documents).collect()
    ids = sorted(texts)
    following = dict(zip(ids, [*ids[1:], ids[0]]))
    assert len(rows) == len(texts)
    prints = {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        text, other = texts[r.doc_id], texts[following[r.doc_id]]
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == 1 - _distance(r.fingerprint, r.edited_fingerprint) / 128
        assert r.near_next == 1 - _distance(r.fingerprint, prints[following[r.doc_id]]) / 128
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_edited_likeness_odd_rows(odd, none):
    rows = simhash.edited_likeness(odd).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6, 7, 8]  # repeated rows are one
    assert all((r.near_next is None) == (r.doc_id is None) for r in rows)
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3, 4)} == {"0" * 32}
    assert simhash.edited_likeness(none).count() == 0
    one = simhash.edited_likeness(odd.filter("doc_id = 5")).first()
    assert one.near_next == 1


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_block_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    values = []
    for _ in range(25):
        base = rng.getrandbits(128)
        values += [base] + [base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 9))) for _ in range(4)]
    values += values[:5]
    rows = [(i, f"{v:032x}") for i, v in enumerate(values)] + [(None, "0" * 32), (999, None)]
    pairs, members = simhash.within_radius(spark.createDataFrame(rows, "doc_id long, fingerprint string"), radius)
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i)
    assert {(r.id, r.class_id) for r in members.collect()} == {(i, first[v]) for i, v in enumerate(values)}
    heads = sorted(first.items(), key=lambda x: x[1])
    want = {(i, j): (a ^ b).bit_count() for n, (a, i) in enumerate(heads) for b, j in heads[n + 1 :] if (a ^ b).bit_count() <= radius}
    got = pairs.collect()
    assert len(got) == len(want) and {(r.a, r.b): r.distance for r in got} == want


# Neighbours


def test_probes_come_by_cost():
    costs = np.sort(np.random.default_rng(2).random(6))
    got = [sum(costs[list(p)]) for p in ann.probes(costs, 64)]
    assert got == sorted(got) and len(got) == 64 and len(set(ann.probes(costs, 64))) == 64


def _nearest(ids, x, query, k):
    scores = [float(np.add.accumulate(x[query] * v)[-1]) for v in x]
    order = sorted((-s, ids[i]) for i, s in enumerate(scores) if ids[i] != ids[query])
    return [(i, -s) for s, i in order[:k]]


def test_recall_and_exact_scores(spark, sf):
    table = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/embeddings.parquet")
    rows = table.collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in range(len(ids)):
        if ids[q] % 20 == 0:
            found = got[ids[q]]
            assert [r for r, _, _ in found] == list(range(1, 21))
            assert sorted(found, key=lambda f: (-f[2], f[1])) == found
            hits += len({i for _, i, _ in found} & {i for i, _ in _nearest(ids, x, q, 20)})
            all_scores = dict(_nearest(ids, x, q, len(ids)))
            assert all(all_scores[i] == pytest.approx(s, abs=1e-14) for _, i, s in found)
    assert hits >= 0.9 * 20 * len(got)


def test_odd_vectors_and_few_candidates(spark):
    rows = [(i, [float(i % 7 - 3), 1.0, float(i % 3)]) for i in range(0, 50)] + [(3, [0.0, 1.0, 0.0])]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 1.0]), (160, [float("nan"), 1.0, 1.0]), (180, [float("inf"), 1.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    odd += [(200, []), (220, [1.0, 2.0]), (221, [2.0, 1.0])]  # a dimension of their own
    table = spark.createDataFrame([(i, v, "q", 1.0) for i, v in rows + odd + rows[:5]], "vec_id long, embedding array<double>, bucket string, score double")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=60).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 220}
    assert got[220] == [(221, 4.0)]
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    for query in (0, 20, 40):
        best = {}
        for i, s in _nearest(ids, x, ids.index(query), 200):
            best[i] = max(s, best.get(i, -1e9))
        assert got[query] == sorted(best.items(), key=lambda f: (-f[1], f[0]))


def test_a_hot_bucket_is_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 64)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rng = np.random.default_rng(4)
    x = np.vstack([np.ones((400, 8)), rng.normal(size=(200, 8))])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") % 20 == 0, k=5).collect()
    copies = sorted((r.rank, r.vec_id) for r in got if r.query_id == 40)
    stronger = [i for i, v in enumerate(x) if v.sum() > 8]
    want = (sorted(stronger, key=lambda i: -x[i].sum()) + [i for i in range(400) if i != 40])[:5]
    assert [v for _, v in copies] == want


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(table, F.col("vec_id") % 20 == 0).count() == 0


def test_planted_pairs_among_texts_of_one_template(spark, monkeypatch):
    """All texts share 160 of 184 words, which is not enough; pairs at 0.81 are found in buckets that hold nearly all."""
    monkeypatch.setattr(order_minhash, "SMALL", 8)
    rng = random.Random(1)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]

    template, texts = words(160), {}
    for i in range(150):
        texts[i] = template + words(24)
        twin = list(texts[i])
        for at in (20, 100, 165):
            twin[at : at + 1] = words(1)
        twin[-4:] = words(4)
        texts[i + 1000] = twin
    runs = {i: order_minhash.runs_of(text) for i, text in texts.items()}
    assert all(0.8 < order_minhash.alignment(runs[i], runs[i + 1000]) < 0.82 for i in range(150))
    assert order_minhash.alignment(runs[0], runs[1]) == order_minhash.alignment(runs[0], runs[1002]) == 0
    docs = spark.createDataFrame([(i, " ".join(text)) for i, text in texts.items()], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert sum(found[i + 1000] == found[i] == i for i in range(150)) >= 149
    assert len(set(found.values())) <= 151


def test_rare_runs_meet_whatever_the_order():
    rng = random.Random(3)
    tried = 0
    for _ in range(3000):
        n = rng.randint(1, 60)
        a = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
        b = np.delete(a, rng.sample(range(n), rng.randint(0, n // 5)))
        b = np.r_[b, np.array([rng.getrandbits(64) for _ in range(rng.randint(0, n // 5))], np.uint64)]
        if order_minhash.alignment(a, b) == 0:
            continue
        tried += 1
        known = np.sort(order_minhash.labelled(a)[: rng.randint(0, n)])
        counts = np.array([rng.randint(2, 9) for _ in known], np.int64)
        x, y = (order_minhash.rare_runs(runs, known, counts) for runs in (a, b))
        assert len(np.intersect1d(x, y)) > 0
    assert tried > 1000


def test_no_pair_of_a_large_bucket_is_lost(spark, monkeypatch):
    """All texts meet in one large bucket alone and share no minimum, by which large buckets were parted; all similar pairs are linked."""
    monkeypatch.setattr(order_minhash, "SMALL", 2)
    rng = random.Random(4)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]

    template, texts = words(160), {}
    for i in range(200):
        texts[i] = template + words(24)
        twin = list(texts[i])
        twin[165:166] = words(1)
        twin[-4:] = words(4)
        texts[i + 1000] = twin
    runs = {i: order_minhash.runs_of(text) for i, text in texts.items()}
    want, links = _brute_force({i: " ".join(text) for i, text in texts.items()})
    assert len(links) == 200
    ids = sorted(texts)
    docs = spark.createDataFrame([(i, " ".join(texts[i])) for i in ids], "doc_id long, text string")
    sketched = spark.createDataFrame(
        [(i, [7], [32 * i + j for j in range(32)], None, len(runs[i]), order_minhash.bitmap(runs[i]).tolist()) for i in ids],
        "doc_id long, sketches array<long>, minima array<long>, left_out array<long>, runs int, bits array<long>",
    )
    found = [(r.a, r.b) for r in order_minhash.links(sketched, docs).collect()]
    assert sorted(found) == links and _roots(ids, found) == want


def test_a_pair_is_not_made_again_by_every_run(spark):
    """All similar pairs of one large part are made, by the first of their rare runs and few others."""
    rng = random.Random(6)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]

    template, texts = words(150), {}
    for i in range(20):
        texts[i] = template + words(40)
        texts[i + 100] = texts[i][:-3] + words(3)
    texts = {i: " ".join(text) for i, text in texts.items()}
    _, links = _brute_force(texts)
    assert len(links) == 20
    labelled = spark.createDataFrame([(i, i, text) for i, text in texts.items()], "doc_id long, label long, text string")
    rows = order_minhash._rare_parts(labelled).cache()
    again = order_minhash._met(rows.drop("behind"))
    made = order_minhash._met(rows)
    assert made.count() < 0.7 * again.count()
    assert {(r.a, r.b) for r in made.collect()} >= {(min(x), max(x)) for x in links}
    assert {(r.a, r.b) for r in order_minhash._similar_rare(labelled).collect()} == {(r.a, r.b) for r in made.collect()}


@pytest.mark.parametrize("classes", [1 << 27, 1 << 10])
def test_rows_are_made_of_runs_that_two_texts_have(spark, monkeypatch, classes):
    """Of the rare runs only those that other texts have make rows, none of these is missing, and rows grow with the members of a group."""
    monkeypatch.setattr(order_minhash, "CLASSES", classes)
    monkeypatch.setattr(order_minhash, "_PART", min(1 << 20, classes))
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]

    template, texts = words(150), {}
    for i in range(60):
        texts[i] = template + words(40)
        if i % 10 == 0:
            texts[i + 100] = texts[i][:-3] + words(3)
    made = {}
    for members in (30, 60):
        some = {i: " ".join(text) for i, text in texts.items() if i % 100 < members}
        labelled = spark.createDataFrame([(i, i, text) for i, text in some.items()], "doc_id long, label long, text string").repartition(3)
        frequent, counts = order_minhash._frequent(labelled)
        want, every = set(), []
        for i, text in some.items():
            x = order_minhash.runs_of(order_minhash.words_of(text))
            keys = order_minhash.rare_runs(x, frequent, counts).view(np.int64).tolist()
            every += [(i, key, len(x) - at) for at, key in enumerate(keys)]
        by_key = {}
        for i, key, _ in every:
            by_key.setdefault(key, set()).add(i)
        want = {row for row in every if len(by_key[row[1]]) > 1}
        got = [(r.doc_id, r.key, r.behind) for r in order_minhash._rare_parts(labelled).collect()]
        assert len(got) == len(set(got)) and want <= set(got) <= set(every)
        made[members] = len(got)
        if classes > 1 << 20:
            assert len(want) < len(every) / 2 and len(got) < len(want) + 0.01 * len(every)
    assert made[60] < 2.6 * made[30]
