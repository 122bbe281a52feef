"""Near-duplicates by order MinHash: sketches of k-mers that keep their order in the text, then banded alignment.

A text is a sequence of overlapping runs of five words, each labelled with the number of its occurrence, so
that no two are equal.  A sketch takes the five labelled runs of smallest hash, in the order of the text;
two texts share a sketch only if they share these runs in the same order, which is what an edit
distance looks at.  Texts that share one of the sketches are aligned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import components, drop_stored, stored

K = 5  # words of a run
PICKED = 5  # runs of a sketch
SKETCHES = 32  # of a text: at a similarity of 0.8 one is shared with a probability above 0.99999
SHORT_PICKED = 4  # runs of the further sketches of a text of at most SHORT runs
SHORT = 40  # runs; above, sketches of PICKED runs reach the stated probability
LEFT_OUT = 9  # runs of a text up to which no two similar ones differ by more than one run on either side
SIMILARITY = 0.8
SMALL = 64  # members of a bucket whose pairs of different groups are all aligned
HUBS = 1  # turns in which a larger bucket gets a further centre before rare runs decide
HOPS = 2  # times that groups are merged along their links in one turn
MORE = 4  # from turn to turn, times as many pairs of two groups are aligned
ORDERED_BY = 512  # texts whose runs are counted to tell frequent ones
FREQUENT = 1 << 14  # runs at most that are known to be frequent
BITS = 512  # of a bitmap of a text's runs
CLASSES = 1 << 27  # of rare runs at most; 16 MB tell the classes with several from the others

_WORDS = re.compile(r"\w+")
_BLOCK = 1 << 19  # hashes of a long text that are looked at together
_PART = 1 << 20  # classes of rare runs that are counted together


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(words: list[str]) -> np.ndarray:
    """Hashes of the runs of ``K`` words in order; a shorter text is one run, a wordless one has none."""
    from xxhash import xxh3_64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    for w in words:
        if w not in known:
            known[w] = xxh3_64_intdigest(w.encode("utf-8", "replace"))
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - K + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(K, len(h))):
        out = _mixed(out + h[i : i + n] + np.uint64(i + 1))
    return out


def labelled(runs: np.ndarray) -> np.ndarray:
    """The runs with the number of their occurrence mixed in, so that no two are equal."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    start = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.maximum.accumulate(np.where(start, np.arange(len(runs)), 0))
    number = np.empty(len(runs), np.uint64)
    number[order] = (np.arange(len(runs)) - first).astype(np.uint64)
    return _mixed(runs ^ _mixed(number + np.uint64(0x9E3779B97F4A7C15)))


def sketches(runs: np.ndarray, picks: int = PICKED, first: int = 1) -> np.ndarray:
    """One number for each sketch: the hash of its ``picks`` runs in the order of the text."""
    x = labelled(runs)
    seeds = _mixed(np.arange(first, first + SKETCHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, _BLOCK // len(x))
    for low in range(0, SKETCHES, step):
        hashed = (x[None, :] ^ seeds[low : low + step, None]) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
        if len(x) > picks:
            places = np.sort(np.argpartition(hashed, picks - 1, axis=1)[:, :picks], axis=1)
        else:
            places = np.broadcast_to(np.arange(len(x)), (len(hashed), len(x)))
        picked = x[places]
        key = seeds[low : low + step].copy()
        for i in range(picked.shape[1]):
            key = _mixed(key + picked[:, i])
        out[low : low + step] = key
    return out


def all_sketches(runs: np.ndarray) -> np.ndarray:
    """The sketches of a text; a short one has as many again, of fewer runs."""
    found = sketches(runs)
    return np.r_[found, sketches(runs, SHORT_PICKED, 1 + SKETCHES)] if len(runs) <= SHORT else found


def bitmap(runs: np.ndarray) -> np.ndarray:
    """A bit for each of ``BITS`` classes of hashes: whether an odd number of the text's labelled runs is in it.

    Bits that differ between two texts are at most as many as the runs that only one of them has.
    """
    counts = np.bincount((labelled(runs) % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def left_out(runs: np.ndarray) -> np.ndarray | None:
    """Of a text of 4 to ``LEFT_OUT`` runs: the hash of all its runs in order, then those with one run left out.

    Of two similar ones of unequal lengths the longer has one run more, and all runs of the shorter are aligned.
    """
    if not 4 <= len(runs) <= LEFT_OUT:
        return None
    out = []
    for kept in [runs, *(np.delete(runs, i) for i in range(len(runs)))]:
        key = np.full(1, len(kept), np.uint64)
        for run in kept:
            key = _mixed(key + run)
        out.append(key[0])
    return np.array(out, np.uint64)


def alignment(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Aligned runs over all runs of both texts, m / (a + b - m); 0 if it is below the similarity.

    m is the length of the longest common subsequence, found within the band of diagonals that an
    alignment of that similarity can reach: a bit of an integer stands for a run of ``a``, and
    one addition takes all runs of ``a`` through a run of ``b``.
    """
    n, m = len(a), len(b)
    if n == 0 or m == 0:
        return 0.0
    least = int(np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9))  # runs that must be aligned
    if min(n, m) < least:
        return 0.0
    left, right = n - least, m - least  # runs that may be passed over on either side
    if len(np.intersect1d(a, b)) == 0:
        return 0.0
    places: dict[int, int] = {}
    for i, run in enumerate(a.tolist()):
        places[run] = places.get(run, 0) | (1 << i)
    full = (1 << n) - 1
    state = full
    for j, run in enumerate(b.tolist()):
        hit = places.get(run)
        if hit is None:
            continue
        low, high = max(0, j - right), min(n, j + left + 1)
        hit &= ((1 << high) - 1) ^ ((1 << low) - 1)
        if hit:
            both = state & hit
            state = ((state + both) | (state - both)) & full
    aligned = n - state.bit_count()
    found = aligned / (n + m - aligned)
    return found if aligned >= least else 0.0


SKETCHED = "doc_id long, digest binary, sketches array<long>, left_out array<long>, runs int, bits array<long>"


def _sketched(docs: DataFrame) -> DataFrame:
    """The columns ``SKETCHED``: the digest is that of the words, or of the text if it has none; null for null texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            out = []
            for text in batch["text"]:
                if not isinstance(text, str):
                    out.append((None, None, None, None, None))
                    continue
                words = words_of(text)
                plain = "w" + " ".join(words) if words else "t" + text
                runs = runs_of(words)
                found = all_sketches(runs).view(np.int64) if len(runs) else None
                fewer = left_out(runs)
                fewer = None if fewer is None else fewer.view(np.int64)
                digest = xxh3_128_intdigest(plain.encode("utf-8", "replace")).to_bytes(16, "big")
                out.append((digest, found, fewer, len(runs), bitmap(runs) if len(runs) else None))
            found = pd.DataFrame(out, columns=["digest", "sketches", "left_out", "runs", "bits"])
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield found.astype({"doc_id": "Int64", "runs": "Int32"})

    return docs.select("doc_id", "text").mapInPandas(run, SKETCHED)


def _least(runs_a: str, runs_b: str) -> Column:
    """Runs that two similar texts have in common at least."""
    return F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col(runs_a) + F.col(runs_b)) - F.lit(1e-9))


def _possible(runs_a: str, bits_a: str, runs_b: str, bits_b: str) -> Column:
    """Whether two texts can be similar by their bitmaps; none that ``alignment`` accepts is refused.

    Texts of n and m runs that align to the similarity have at least s / (1 + s) * (n + m) runs in common,
    so at most n + m less twice as many are in one of them only, and no more bits differ.
    """
    total, least = F.col(runs_a) + F.col(runs_b), _least(runs_a, runs_b)
    differ = sum((F.bit_count(F.col(bits_a)[i].bitwiseXOR(F.col(bits_b)[i])) for i in range(1, BITS // 64)), F.bit_count(F.col(bits_a)[0].bitwiseXOR(F.col(bits_b)[0])))
    return (F.least(runs_a, runs_b) >= least) & (differ <= total - 2 * least)


def _aligned(pairs: DataFrame) -> DataFrame:
    """Rows ``(a, b)`` of pairs with texts ``x`` and ``y`` that align."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            last, runs, keep = None, None, []
            for a, x, y in zip(batch["a"], batch["x"], batch["y"]):
                if a != last:
                    last, runs = a, runs_of(words_of(x))
                keep.append(alignment(runs, runs_of(words_of(y))) > 0)
            yield batch.loc[keep, ["a", "b"]]

    return pairs.select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _merge(labels: DataFrame, bonds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels ``(doc_id, label)`` and bonds ``(x, y)`` between labels after one step: a label becomes the smallest that it is bound to.

    Bonds are contracted with the labels, so they shrink as groups merge: a step costs the labels and what is not merged yet,
    never the links within a group.  Equal labels are one group; those of one group become equal after some steps.
    """
    both = bonds.union(bonds.select("y", "x"))
    low = both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("low"))
    lower = low.select(F.col("x").alias("low"), F.col("low").alias("lowest"))
    step = stored(low.join(lower, "low", "left").select("x", F.coalesce("lowest", "low").alias("to")))
    after = labels.join(step, F.col("label") == F.col("x"), "left").select("doc_id", F.coalesce("to", "label").alias("label"))
    return stored(after), stored(_contracted(bonds, step.select(F.col("x").alias("node"), F.col("to").alias("root"))))


def _contracted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct pairs ``(x, y)``, x < y, of the roots of two columns' nodes; nodes without a root stand for themselves."""
    first, second = pairs.columns
    named = pairs.toDF("x", "y").join(roots.toDF("x", "of_x"), "x", "left").join(roots.toDF("y", "of_y"), "y", "left")
    x, y = F.coalesce("of_x", "x"), F.coalesce("of_y", "y")
    return named.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).filter("x < y").distinct()


def _open(rows: DataFrame) -> DataFrame:
    """Rows ``(doc_id, key, label, size, centre)`` of the buckets not known to be one group; the centre is the smallest id's."""
    buckets = rows.groupBy("key").agg(
        F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("doc_id", "label")).alias("centre")
    )
    return rows.join(buckets.filter("low < high").select("key", "size", "centre"), "key")


def _asked(rows: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` of different groups that open buckets ask for, and the rows ``(doc_id, key)`` that stay: those of large ones, but for centres."""
    large = rows.filter(F.col("size") > SMALL)
    met = large.filter(F.col("label") != F.col("centre.label")).select(F.col("centre.doc_id").alias("a"), F.col("doc_id").alias("b"))
    small = rows.filter(F.col("size") <= SMALL).select("doc_id", "label", "key").join(marks, "doc_id")
    return _met(small).select("a", "b").union(met), large.filter(F.col("doc_id") != F.col("centre.doc_id")).select("doc_id", "key")


def _met(rows: DataFrame) -> DataFrame:
    """All pairs ``(a, b)`` of different groups ``(x, y)``, x < y, in the parts of ``(key, doc_id, label, runs, bits)`` whose bitmaps allow the similarity.

    Rows may have ``behind``, the runs of the text from the key on in an order that all texts share.  Where a pair meets by the first of its
    common runs, all of these are among them; where fewer are left than similar texts have in common, the pair either is not similar or has
    met by an earlier run, so it is not made again.
    """
    placed = [c for c in ("behind",) if c in rows.columns]
    names = {"doc_id": "", "label": "of_", "runs": "runs_", "bits": "bits_"} | {c: f"{c}_" for c in placed}
    one, other = (rows.select("key", *[F.col(c).alias(f"{n}{side}") for c, n in names.items()]) for side in "ab")
    near = one.join(other, "key").filter("a < b and of_a <> of_b")
    if placed:
        near = near.filter(F.least("behind_a", "behind_b") >= _least("runs_a", "runs_b"))
    near = near.filter(_possible("runs_a", "bits_a", "runs_b", "bits_b"))
    return near.select("a", "b", F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y"))


def least_shared(n: int) -> int:
    """Runs that a text of ``n`` runs shares with every similar one."""
    return int(np.ceil(SIMILARITY * n - 1e-9))


def rare_runs(runs: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The labelled runs of which two similar texts have one in common: as many of the rarest as not all similar texts share, and one.

    ``frequent`` are sorted runs with their ``counts``; others are rarer.  The order is one for all texts: of the runs that two
    similar texts share, the first in this order is among these of both, whatever the counts.
    """
    x = labelled(runs)
    count = np.zeros(len(x), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
        count = np.where(frequent[at] == x, counts[at], 0)
    return x[np.lexsort((x, count))[: len(x) - least_shared(len(x)) + 1]]


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Runs that several of about ``ORDERED_BY`` texts have, sorted, with their counts; at most ``FREQUENT``, the most frequent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                x = labelled(runs_of(words_of(text))).view(np.int64)
                yield from (pd.DataFrame({"run": x[low : low + _BLOCK]}) for low in range(0, len(x), _BLOCK))

    share = max(1, texts.count() // ORDERED_BY)
    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("text").mapInPandas(run, "run long")
    rows = some.groupBy("run").count().filter("count > 1").orderBy(F.desc("count"), "run").limit(FREQUENT).collect()
    runs, counts = np.array([r["run"] for r in rows], np.int64).view(np.uint64), np.array([r["count"] for r in rows], np.int64)
    order = np.argsort(runs)
    return runs[order], counts[order]


def _classes_of(runs: np.ndarray, classes: int) -> np.ndarray:
    return (runs & np.uint64(classes - 1)).astype(np.int64)


def _repeated(texts: DataFrame, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Little-endian bits: the classes that hold several of the ``rare_runs`` of all texts; a run of another class is in one text only.

    There are about ten times as many classes as runs, up to ``CLASSES``; beyond, more classes hold several, and fewer runs are told to be
    in one text.  No run of two texts ever is.
    """
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    classes = min(CLASSES, max(_PART, 1 << (size // 4).bit_length()))

    def packed(held: list[np.ndarray]) -> pd.DataFrame:
        found, number = np.unique(np.concatenate(held), return_counts=True)
        found = np.repeat(found, np.minimum(number, 2))
        cut = np.flatnonzero(np.diff(found // _PART)) + 1
        parts = [x for x in np.split(found, cut) if len(x)]
        return pd.DataFrame({"part": [x[0] // _PART for x in parts], "held": [(x % _PART).astype(np.uint32).tobytes() for x in parts]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, number = [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(_classes_of(rare_runs(runs_of(words_of(text)), frequent, counts), classes))
                number += len(held[-1])
                if number >= _BLOCK:
                    yield packed(held)
                    held, number = [], 0
        if held:
            yield packed(held)

    def several(rows: pd.DataFrame) -> pd.DataFrame:
        number = np.zeros(_PART, np.int64)
        for held in rows["held"]:
            found, times = np.unique(np.frombuffer(held, np.uint32), return_counts=True)
            number[found] += times
        return pd.DataFrame({"part": rows["part"].iloc[:1], "bits": [np.packbits(number > 1, bitorder="little").tobytes()]})

    out = np.zeros(classes // 8, np.uint8)
    sent = texts.select("text").mapInPandas(run, "part int, held binary")
    for r in sent.groupBy("part").applyInPandas(several, "part int, bits binary").collect():
        out[r["part"] * (_PART // 8) : (r["part"] + 1) * (_PART // 8)] = np.frombuffer(r["bits"], np.uint8)
    return out


def _rare_parts(texts: DataFrame) -> DataFrame:
    """Rows ``(doc_id, label, key, behind, runs, bits)`` of ``(doc_id, label, text)``: a key for each of a text's ``rare_runs`` that another may have, and the runs from it on.

    Most of the rarest runs are in one text only, by which no two texts meet; rows of these are not made.
    """
    frequent, counts = _frequent(texts)
    repeated = _repeated(texts, frequent, counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.iloc[low : low + 64]
                runs = [runs_of(words_of(text)) for text in part["text"]]
                found, places = [], []
                for x in runs:
                    keys = rare_runs(x, frequent, counts)
                    at = _classes_of(keys, len(repeated) * 8)
                    places.append(np.flatnonzero(repeated[at >> 3] >> (at & 7) & 1).astype(np.int32))
                    found.append(keys[places[-1]].view(np.int64))
                number = [len(keys) for keys in found]
                ids, labels = (np.repeat(part[c].to_numpy(np.int64), number) for c in ("doc_id", "label"))
                behind = np.concatenate([np.int32(len(x)) - at for x, at in zip(runs, places)])
                lengths = np.repeat(np.array([len(x) for x in runs], np.int32), number)
                bits = pd.Series([bitmap(x) for x in runs]).repeat(number).to_numpy()
                yield pd.DataFrame({"doc_id": ids, "label": labels, "key": np.concatenate(found), "behind": behind, "runs": lengths, "bits": bits})

    return texts.select("doc_id", "label", "text").mapInPandas(run, "doc_id long, label long, key long, behind int, runs int, bits array<long>")


def _similar_rare(texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different groups ``(x, y)`` that share a rare run and whose bitmaps allow the similarity.

    All similar pairs of different groups of ``(doc_id, label, text)`` are there.  Parts of one group are left out before they are joined.  The pairs of a large part are tried in the join, which Spark splits; no task gathers them.
    """
    rows = stored(_rare_parts(texts))
    parts = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return _met(stored(rows.join(parts.select("key"), "key"))).distinct()


def _differing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose groups differ, with these as ``x`` and ``y``, x < y."""
    named = pairs.join(labels.toDF("a", "of_a"), "a").join(labels.toDF("b", "of_b"), "b").filter("of_a <> of_b")
    return named.select("a", "b", F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y"))


def links(sketched: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links ``(a, b)`` that connect near-duplicates among ``(doc_id, sketches, left_out, runs, bits)`` and their ``(doc_id, text)``.

    In each bucket of equal sketches the member of smallest id is the centre, and every other member is
    aligned with it: one pair for each member, however large the bucket.  A centre that met all leaves; the
    others, aligned or not, stay until links make them one group.  Of a bucket that is open then, all pairs
    of different groups are aligned if it has at most ``SMALL`` members.  A larger one gets ``HUBS`` further centres.

    What is left in large open buckets is searched whole: of two similar texts each shares at least ``least_shared`` of its
    runs with the other, so in any one order of all runs they have one in common among the first that
    are more than the rest.  These texts meet by each of these runs, rare ones first, and all pairs of different
    groups are candidates: no pair of a large bucket is left out, and a passage that many texts have is met only where it
    fills more than the similarity allows to differ.  The candidates wait in a table; of each two groups one pair is aligned, in each
    further turn ``MORE`` times as many, until none is left of different groups.  Where there are few, all are aligned at once.

    Pairs whose bitmaps differ in more bits than similar texts can are not aligned; this refuses no similar pair, and
    so changes no link.  None is capped or gathered.  Two texts of similarity 0.8 share a sketch with 0.33, so about 10 of 32 buckets.

    A text of few runs is also aligned with all that have one run more in its order: these meet by what is left
    of them without that run.
    """
    held = sketched.filter("sketches is not null").select("doc_id", "sketches")
    whole = sketched.filter("left_out is not null").select(F.col("doc_id").alias("whole"), F.col("left_out")[0].alias("key"))
    fewer = sketched.filter("left_out is not null").select("doc_id", F.explode(F.slice("left_out", 2, LEFT_OUT)).alias("key"))
    short = whole.join(fewer, "key").filter("whole <> doc_id")
    short = short.select(F.least("whole", "doc_id").alias("a"), F.greatest("whole", "doc_id").alias("b"))
    rows = held.select("doc_id", F.posexplode("sketches").alias("at", "sketch")).withColumn("key", F.xxhash64("at", "sketch"))
    rows = stored(rows.select("doc_id", "key"))
    centres = rows.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).filter("last > centre")
    rest = stored(rows.join(centres.drop("last"), "key").filter("doc_id > centre"))
    drop_stored(rows)
    pairs = stored(rest.select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).union(short).distinct())
    if pairs.isEmpty():
        return pairs
    ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    involved = stored(texts.join(ids, "doc_id", "left_semi"))
    marks = stored(sketched.select("doc_id", "runs", "bits").join(ids, "doc_id", "left_semi"))
    mark_a, mark_b = marks.toDF("a", "runs_a", "bits_a"), marks.toDF("b", "runs_b", "bits_b")
    labels = ids.select("doc_id", F.col("doc_id").alias("label"))
    rest = rest.select("doc_id", "key")
    tried = found = bonds = waiting = None
    hubs, share = HUBS, 1
    while True:
        near = pairs.join(mark_b, "b").join(mark_a, "a").filter(_possible("runs_a", "bits_a", "runs_b", "bits_b")).select("a", "b")
        right = near.join(involved.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
        both = right.join(involved.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        good = stored(_aligned(both))
        tried = pairs if tried is None else tried.union(pairs)
        found = good if found is None else found.union(good)
        new = _contracted(good, labels)
        bonds = stored(new if bonds is None else bonds.union(new).distinct())
        for _ in range(HOPS):
            if not bonds.isEmpty():
                labels, bonds = _merge(labels, bonds)
        if waiting is None:
            met = stored(_open(stored(rest.join(labels, "doc_id"))))
            if hubs:
                hubs -= 1
                wanted, rest = _asked(met, marks)
                pairs = stored(wanted.distinct().join(tried, ["a", "b"], "left_anti"))
                rest = stored(rest)
                if pairs.isEmpty() and rest.isEmpty():
                    return found
                continue
            left = stored(met.select("doc_id", "label").distinct())
            if left.isEmpty():
                return found
            waiting = stored(_similar_rare(stored(involved.join(left, "doc_id"))).join(tried, ["a", "b"], "left_anti"))
        else:
            waiting = stored(_differing(waiting.join(pairs, ["a", "b"], "left_anti"), labels))
        pairs = waiting
        if waiting.count() > ids.count():
            place = F.row_number().over(Window.partitionBy("x", "y").orderBy("a", "b"))
            pairs = waiting.withColumn("place", place).filter(F.col("place") <= share)
        pairs, share = stored(pairs.select("a", "b")), share * MORE
        if pairs.isEmpty():
            return found


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, class_id)``, one for each row of ``docs``: the smallest id of its group of near-duplicates.

    Two texts are linked if their runs align to a similarity of 0.8 or more; a group is what links connect.
    Texts with the same words (in lower case) are copies and share one representative; so do equal
    texts without words.  Null and unlinked texts are groups of their own.  Repeated rows agree; of
    different texts under one id only one (the smallest) is aligned with others.  A null id takes part
    with no link; its class is that of its copies, or null.  An empty table gives no rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digests = stored(_sketched(named))
    copies = digests.filter("doc_id is not null and digest is not null")
    heads = stored(copies.groupBy("digest").agg(F.min("doc_id").alias("head")))
    # an id that speaks for its copies, once: rows that share an id, which should not be, share a class as well
    chosen = copies.join(heads, "digest").filter("doc_id = head")
    chosen = stored(chosen.groupBy("doc_id").agg(*[F.min_by(c, "digest").alias(c) for c in ("sketches", "left_out", "runs", "bits")]))
    several = copies.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    texts = named.filter("text is not null and doc_id is not null")
    doubled = texts.join(several, "doc_id", "left_semi")
    doubled = doubled.groupBy("doc_id").agg(F.min("text").alias("text"))
    found = links(chosen, texts.join(several, "doc_id", "left_anti").union(doubled))
    roots = components(found)
    classed = digests.join(heads, "digest", "left").join(roots, F.col("head") == F.col("node"), "left")
    return classed.select("doc_id", F.coalesce("root", "head", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: of the smallest id; rows without an id stay.

    Of rows that share that id the smallest, column by column, stays.
    """
    found = classes(docs).filter("doc_id is null or class_id < doc_id").select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct()
    kept = docs.join(found, F.col("doc_id") == F.col("_id"), "left_anti")
    repeated = kept.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.join(repeated, "doc_id", "left_anti").unionByName(several)
