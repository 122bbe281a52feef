"""Near-duplicates by SimHash: vantage-point trees find the fingerprints within a Hamming radius.

A fingerprint has 64 bits.  Two that differ in at most three bits differ in at most one bit of the
left or of the right half, so there are two trees, one for each half, searched with a reach of one:
the distance of halves is a metric of its own, and the smaller reach leaves narrower boundaries.

A tree is grown from a bounded sample.  Each node parts fingerprints by their distance to a vantage
point; every fingerprint has one home leaf, and visits each leaf beyond a boundary that is within its reach
(the triangle bound prunes all others).  Where a half no longer tells fingerprints apart, nodes use all 64 bits
and the whole radius.  The leaves are the shards: each is searched by one task, by a further tree
if it is large, and reports a spanning forest of its near pairs, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import components, stored

RADIUS = 3
LEAF = 4096  # fingerprints that a leaf is meant to hold
SAMPLED = 16  # sampled fingerprints for each leaf
SAMPLE_ROWS = 1 << 20  # about the most fingerprints that the sample may hold
TRIES = 8  # vantage points tried for a node
WORK = 1 << 26  # comparisons of a shard from which it gets a tree of its own
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ALL = (1 << 64) - 1
HALVES = ((1 << 64) - (1 << 32), (1 << 32) - 1)

_PAIR = 0x0000000100000001  # two counters of 32 bits in a long


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, fp)``, one for each row of ``docs``; ``fp`` is the fingerprint as a signed long.

    The shingles are three successive words, A-Z in lower case, joined by spaces, repeats included;
    fewer words are one shingle, and a null or wordless text has none and fingerprint 0.  A bit is set
    if it is set in more than half of the shingles' XXH64 hashes (seed 42).  Rows are told apart by
    their place in the input, so repeated rows and null ids stay.  A text has fewer than 2^30 shingles, which the counters hold.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.array_remove(F.split(text, SPACES), "").alias("w"),
    )
    few = F.expr("array(struct(array_join(w, ' ') AS a, cast(null AS string) AS b, cast(null AS string) AS c))")
    many = F.expr(
        "arrays_zip(slice(w, 1, greatest(size(w) - 2, 0)), slice(w, 2, greatest(size(w) - 2, 0)), slice(w, 3, greatest(size(w) - 2, 0)))"
    ).cast("array<struct<a:string,b:string,c:string>>")
    shingles = F.when(F.size("w") == 0, F.array().cast("array<struct<a:string,b:string,c:string>>")).when(F.size("w") < 3, few).otherwise(many)
    each = rows.select("doc_id", "row", F.explode_outer(shingles).alias("s"))
    each = each.select("doc_id", "row", F.when(F.col("s").isNotNull(), F.xxhash64(F.concat_ws(" ", "s.a", "s.b", "s.c"))).alias("h"))
    counts = [F.sum(F.shiftright("h", j).bitwiseAND(F.lit(_PAIR))).alias(f"c{j}") for j in range(32)]
    votes = each.groupBy("doc_id", "row").agg(F.count("h").alias("n"), *counts)
    bits = F.lit(0).cast("long")
    for j in range(32):
        count = F.col(f"c{j}")
        for value, bit in ((count.bitwiseAND(F.lit(0xFFFFFFFF)), j), (F.shiftrightunsigned(count, 32), j + 32)):
            mark = 1 << bit if bit < 63 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(value * 2 > F.col("n"), F.lit(mark)).otherwise(F.lit(0)))
    return votes.select("doc_id", bits.alias("fp"))


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


@dataclass
class Tree:
    """Nodes as arrays.  ``near`` and ``far`` are child nodes, or ``~leaf``; a tree of one leaf has no nodes."""

    vantage: np.ndarray
    mask: np.ndarray
    bound: np.ndarray
    reach: np.ndarray
    near: np.ndarray
    far: np.ndarray
    leaves: int


def _distances(points: np.ndarray, vantage, mask) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask).astype(np.int16)


def _best_split(points: np.ndarray, mask: int, reach: int):
    """The vantage point and bound with the least estimated work, or None if no split saves a quarter of it.

    Work is the square of what each side holds, counting the near side's boundary, which visits the far side.
    """
    best = None
    for at in np.unique(np.linspace(0, len(points) - 1, TRIES).astype(int)):
        seen = np.bincount(_distances(points, points[at], np.uint64(mask)), minlength=65)
        inside = np.cumsum(seen)
        ring = inside - np.concatenate([np.zeros(reach, int), inside[:-reach]])
        work = inside.astype(float) ** 2 + (len(points) - inside + ring).astype(float) ** 2
        work[inside == len(points)] = np.inf
        bound = int(np.argmin(work))
        if work[bound] < 0.75 * len(points) ** 2 and (best is None or work[bound] < best[0]):
            best = work[bound], points[at], bound
    return best


def grow(sample: np.ndarray, half: int, most: int, radius: int = RADIUS) -> Tree:
    """A tree over the sample whose leaves hold at most ``most`` sampled points, where points can be told apart."""
    nodes: list[list] = []
    leaves = 0
    todo = [(np.sort(sample), -1, "")]  # points, parent, side
    while todo:
        points, parent, side = todo.pop()
        found, metric = None, None
        if len(points) > most:
            for metric in ((half, radius // 2), (ALL, radius)):
                found = _best_split(points, *metric)
                if found:
                    break
        if found is None:
            link, leaves = ~leaves, leaves + 1
        else:
            _, vantage, bound = found
            mask, reach = metric
            link = len(nodes)
            nodes.append([vantage, mask, bound, reach, 0, 0])
            inside = _distances(points, vantage, np.uint64(mask)) <= bound
            todo += [(points[inside], link, "near"), (points[~inside], link, "far")]
        if parent >= 0:
            nodes[parent][4 if side == "near" else 5] = link
    columns = list(zip(*nodes)) if nodes else [()] * 6
    kinds = (np.uint64, np.uint64, np.int16, np.int16, np.int64, np.int64)
    return Tree(*[np.array(c, dtype=k) for c, k in zip(columns, kinds)], leaves=leaves)


def route(tree: Tree, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays ``(index of the point, leaf, home)``: the home leaf of each home point, and the leaves that points visit.

    Of two points within reach, both at home in a node, the near one visits the other's side; a visitor goes
    wherever a point within its reach may be at home.  So the two meet in the home leaf of one of them.
    """
    index = np.arange(len(points))
    if not len(tree.vantage):
        return index, np.zeros(len(points), dtype=np.int64), home
    node = np.zeros(len(points), dtype=np.int64)
    done = []
    while len(index):
        d = _distances(points[index], tree.vantage[node], tree.mask[node])
        bound, reach = tree.bound[node], tree.reach[node]
        inside = d <= bound
        near = np.where(home, inside, d - reach <= bound)
        settled = home & ~inside
        visits = (d + reach > bound) & (inside | ~home)
        node = np.concatenate([tree.near[node[near]], tree.far[node[settled]], tree.far[node[visits]]])
        home = np.concatenate([home[near], home[settled], np.zeros(visits.sum(), dtype=bool)])
        index = np.concatenate([index[near], index[settled], index[visits]])
        leaf = node < 0
        done.append((index[leaf], ~node[leaf], home[leaf]))
        index, node, home = index[~leaf], node[~leaf], home[~leaf]
    return tuple(np.concatenate(parts) for parts in zip(*done))


class Forest:
    """Labels of connected points: the smallest index of each group."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def search(points: np.ndarray, home: np.ndarray, index: np.ndarray, forest: Forest, half: int, radius: int = RADIUS) -> None:
    """Join all points within the radius of a home point; ``index`` are their places in the forest.

    A large shard is parted by a tree of its own, as long as that tells its points apart.
    """
    if home.sum() * len(points) > WORK:
        own = points[home]
        tree = grow(own[:: max(1, len(own) // LEAF)], half, SAMPLED * 4, radius)
        if tree.leaves > 1:
            at, leaf, stays = route(tree, points, home)
            order = np.argsort(leaf, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
                if stays[part].sum() * len(part) < home.sum() * len(points):
                    search(points[at[part]], stays[part], index[at[part]], forest, half, radius)
                else:
                    _compare(points[at[part]], stays[part], index[at[part]], forest, radius)
            return
    _compare(points, home, index, forest, radius)


def _compare(points: np.ndarray, home: np.ndarray, index: np.ndarray, forest: Forest, radius: int) -> None:
    """Compare each home point with all, in blocks of bounded size."""
    own = np.flatnonzero(home)
    step = max(1, (1 << 22) // max(1, len(points)))
    for start in range(0, len(own), step):
        block = own[start : start + step]
        near = np.bitwise_count(points[block][:, None] ^ points[None, :]) <= radius
        a, b = np.nonzero(near)
        forest.join(index[block[a]], index[b])


def _unsigned(fps: pd.Series) -> np.ndarray:
    return fps.to_numpy(dtype=np.int64).view(np.uint64)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct longs ``fp`` exactly as all pairs within the radius do.

    The sample follows from the fingerprints' hashes; it sets the sizes of shards only, never the result.
    """
    rows = stored(prints.select("fp").distinct())
    every = max(LEAF // SAMPLED, rows.count() // SAMPLE_ROWS + 1)
    sample = rows.filter(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).toPandas()
    trees = [grow(_unsigned(sample["fp"]), half, SAMPLED, radius) for half in HALVES]

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = _unsigned(batch["fp"])
            for number, tree in enumerate(trees):
                at, leaf, home = route(tree, points, np.ones(len(points), dtype=bool))
                yield pd.DataFrame({"tree": number, "leaf": leaf, "home": home, "fp": points[at].view(np.int64)})

    def forest(shard: pd.DataFrame) -> pd.DataFrame:
        points, home = _unsigned(shard["fp"]), shard["home"].to_numpy(dtype=bool)
        found = Forest(len(points))
        search(points, home, np.arange(len(points)), found, HALVES[int(shard["tree"].iloc[0])], radius)
        linked = np.flatnonzero(found.label != np.arange(len(points)))
        signed = points.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[found.label[linked]]})

    parts = max(2, sum(tree.leaves for tree in trees) // 4)  # leaves cost time rather than bytes
    routed = rows.mapInPandas(shards, "tree int, leaf long, home boolean, fp long")
    return routed.repartition(parts, "tree", "leaf").groupBy("tree", "leaf").applyInPandas(forest, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Rows ``(doc_id, fingerprint, component_id)``, one for each row of ``docs``.

    Texts whose fingerprints differ in at most ``radius`` bits (up to 3) are linked; ``component_id`` is the
    smallest id that links reach.  Null and wordless texts have fingerprint 0, linked like any
    other.  Rows of one id with different texts are linked by their texts only.  A null id links its
    text but is never the smallest; a component of null ids only has a null ``component_id``.
    An empty table gives no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_col, text_col))
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes, radius))
    grouped = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")
