"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Each table hashes a vector by ``hashes`` random projections, cut into slots of equal width.  A query visits
its own bucket of each table and then those that differ by a slot in some projections, in the order
of how likely they hold a neighbour: by the squared distances to the slots' borders.  All vectors of a
visited bucket are ranked by their exact inner product; the tables' bests are merged.

Inner products become distances by one more coordinate that gives all vectors the largest norm.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored

TABLES = 6
HASHES = 8
WIDTH = 2.4  # of a slot, in norms of the longest vector
PROBES = 90  # buckets that a query visits in each table
ROWS = 4096  # vectors of a bucket that are held together
CELL_ROWS = 32768  # vectors of a task's group, about; a query brings home k of them from each group it visits
QUERIES = 16384  # visits of a bucket that are held together


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Distinct ``(vec_id, v)`` with an id and a vector of finite components that are not all zero, in double precision."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(finite & some).distinct()


def probes(borders: np.ndarray, count: int) -> list[tuple[int, ...]]:
    """Sets of border crossings by increasing cost, the empty set first; ``borders`` has their costs in order.

    A set of places in ``borders`` costs the sum; the next sets are made from the cheapest by moving its
    last place on, or by adding the next one.
    """
    out: list[tuple[int, ...]] = [()]
    heap = [(float(borders[0]), (0,))]
    while heap and len(out) < count:
        cost, places = heapq.heappop(heap)
        out.append(places)
        last = places[-1] + 1
        if last < len(borders):
            heapq.heappush(heap, (cost - borders[last - 1] + borders[last], (*places[:-1], last)))
            heapq.heappush(heap, (cost + borders[last], (*places, last)))
    return out


class Hashes:
    """The tables' hash functions for vectors of one dimension, from a seed."""

    def __init__(self, dimension: int, longest: float, tables: int, hashes: int, width: float, seed: int):
        random = np.random.default_rng([seed, dimension])
        self.width = width * longest
        self.directions = random.normal(size=(tables, dimension + 1, hashes))
        self.offsets = random.uniform(0, self.width, size=(tables, hashes))
        self.mixers = random.integers(1, 1 << 62, size=hashes, dtype=np.int64) | 1
        self.start = np.int64(dimension)

    def slots(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return (vectors @ self.directions[table] + self.offsets[table]) / self.width

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """One number for each row of whole slots."""
        with np.errstate(over="ignore"):
            mixed = ((slots.astype(np.int64) + 0x9E3779B9) * self.mixers).sum(axis=-1) + self.start
            return (mixed ^ (mixed >> np.int64(29))) * np.int64(0x3F4A7C15F39CC061)


def _by_dimension(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = batch["v"].map(len)
    for size in sorted(sizes.unique()):
        part = batch[sizes == size]
        yield part["vec_id"].to_numpy(), np.array(part["v"].tolist(), np.float64)


def _placed(vectors: DataFrame, functions, longest: float, count: int, as_query: bool) -> DataFrame:
    """Rows ``(table, bucket, vec_id, v)``: the bucket of each vector, or the buckets each query visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Hashes] = {}
        for whole in batches:
            for low in range(0, len(whole), 512):
                for ids, v in _by_dimension(whole.iloc[low : low + 512]):
                    own = made[v.shape[1]] = made.get(v.shape[1]) or functions(v.shape[1])
                    norms = np.sqrt(np.square(v).sum(axis=1))
                    if as_query:
                        x = np.hstack([v * (longest / norms)[:, None], np.zeros((len(v), 1))])
                    else:
                        x = np.hstack([v, np.sqrt(np.maximum(longest**2 - norms**2, 0))[:, None]])
                    for table in range(len(own.directions)):
                        slots = own.slots(x, table)
                        floor = np.floor(slots)
                        if not as_query:
                            keys = own.keys(floor)
                            yield pd.DataFrame({"table": table, "bucket": keys, "vec_id": ids, "v": [r.tobytes() for r in v]})
                            continue
                        inside = slots - floor
                        costs = np.hstack([inside**2, (1 - inside) ** 2])
                        order = np.argsort(costs, axis=1)
                        keys, owners = [], []
                        for i in range(len(v)):
                            seen = set()
                            for places in probes(costs[i, order[i]], 4 * count):
                                crossed = order[i, list(places)] % inside.shape[1]
                                if len(set(crossed.tolist())) < len(crossed):
                                    continue  # both borders of one slot
                                moved = floor[i].copy()
                                moved[crossed] += np.where(order[i, list(places)] >= inside.shape[1], 1, -1)
                                seen.add(moved.tobytes())
                                keys.append(moved)
                                if len(seen) == count:
                                    break
                            owners += [i] * len(seen)
                        keys = own.keys(np.array(keys))
                        bytes_ = [r.tobytes() for r in v]
                        yield pd.DataFrame({"table": table, "bucket": keys, "vec_id": ids[owners], "v": [bytes_[i] for i in owners]})

    return vectors.mapInPandas(run, "table int, bucket long, vec_id long, v binary")


def best_of(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k vectors of largest inner product for each query, but itself: ``(query row, vector row, score)``.

    A matrix product finds who may be among them; their scores are then added up in one fixed order, so
    that equal vectors have equal scores, and ties go to smaller ids.
    """
    rough = q @ x.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    n = rough.shape[1]
    if n > k:
        least = np.partition(rough, n - k, axis=1)[:, n - k]
        slack = 1e-12 * np.sqrt(np.square(q).sum(axis=1)) * np.sqrt(np.square(x).sum(axis=1).max())
        rows, columns = np.nonzero(rough >= (least - slack)[:, None])
    else:
        rows, columns = np.nonzero(rough > -np.inf)
    scores = np.empty(len(rows))
    for low in range(0, len(rows), 65536):
        part = slice(low, low + 65536)
        scores[part] = np.add.accumulate(q[rows[part]] * x[columns[part]], axis=1)[:, -1]
    finite = query_ids[rows] != ids[columns]
    rows, columns, scores = rows[finite], columns[finite], scores[finite]
    return _first(rows, ids[columns], scores, k, rows, columns, scores)


def _first(rows, ids, scores, k, *arrays):
    """The first k of each row by score and id, of the arrays."""
    order = np.lexsort((ids, -scores, rows))
    ordered = rows[order]
    start = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    rank = np.arange(len(ordered)) - np.maximum.accumulate(np.where(start, np.arange(len(ordered)), 0))
    keep = order[rank < k]
    return tuple(a[keep] for a in arrays)


def _ranked(visits: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """Rows ``(query_id, vec_id, score)``: the bests of each query in each cell of ``(cell, bucket, vec_id, v)``."""

    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(vectors):
            stored_in = dict(tuple(vectors.groupby("bucket")))
            for bucket, visiting in queries.groupby("bucket"):
                inside = stored_in.get(bucket)
                if inside is None:
                    continue
                x, ids = np.frombuffer(b"".join(inside["v"]), np.float64).reshape(len(inside), -1), inside["vec_id"].to_numpy()
                for low in range(0, len(visiting), 1024):
                    part = visiting.iloc[low : low + 1024]
                    q, own = np.frombuffer(b"".join(part["v"]), np.float64).reshape(len(part), -1), part["vec_id"].to_numpy()
                    rows, columns, scores = best_of(own, q, ids, x, k)
                    found.append((own[rows], ids[columns], scores))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        query, vec, score = (np.concatenate(a) for a in zip(*found))
        query, vec, score = _first(query, vec, score, k, query, vec, score)
        return pd.DataFrame({"query_id": query, "vec_id": vec, "score": score})

    return visits.groupBy("cell").cogroup(held.groupBy("cell")).applyInPandas(run, "query_id long, vec_id long, score double")


def _merged(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", place).filter(F.col("rank") <= k)


def _cells(rows: DataFrame, heavy: DataFrame, cells: int, own: str, other: str, by: Column) -> DataFrame:
    """Deal rows to cells of whole buckets, or of parts of heavy buckets.

    Of a heavy bucket the rows are split into ``own`` parts, and each meets all ``other`` parts.
    """
    joined = rows.join(heavy, ["table", "bucket"], "left")
    mine = F.pmod(F.xxhash64(by, F.lit(3)), F.coalesce(own, F.lit(1)))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)).cast("int") - 1))
    dealt = joined.withColumn("mine", mine.cast("int")).withColumn("theirs", every)
    parts = [F.col("mine"), F.col("theirs")] if own == "vector_parts" else [F.col("theirs"), F.col("mine")]
    cell = F.pmod(F.xxhash64("table", "bucket", *parts), F.lit(cells)).alias("cell")
    return dealt.select(cell, F.xxhash64("table", "bucket", *parts).alias("bucket"), "vec_id", "v")


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes_: int = PROBES,
    seed: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the k nearest found of each query, nearest first, ties to smaller ids.

    ``is_query`` is a condition on ``vec_id``.  Nearness is the inner product in double precision.  A query
    that meets fewer than k vectors in its buckets is compared with all, in blocks.  Vectors that are null,
    empty, zero, or hold null or non-finite components take no part, nor do rows without an id.
    Vectors meet those of their own dimension only.  Equal rows count once; of rows that share an id but
    not the vector the nearest counts.  An empty table, or one without queries, gives no rows.
    """
    vectors = stored(valid_vectors(table, id_col, vector_col))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    size = vectors.agg(F.max(norm).alias("longest"), F.count("*").alias("n")).first()
    longest, n = size["longest"] or 1.0, size["n"]

    def functions(dimension: int) -> Hashes:
        return Hashes(dimension, longest, tables, hashes, width, seed)

    queries = vectors.filter(is_query)
    held = _placed(vectors, functions, longest, probes_, False)
    visits = _placed(queries, functions, longest, probes_, True)
    counted = held.groupBy("table", "bucket").agg(F.count("*").alias("vectors"))
    asked = visits.groupBy("table", "bucket").agg(F.count("*").alias("visits"))
    heavy = stored(
        counted.join(asked, ["table", "bucket"])
        .select(
            "table", "bucket",
            F.ceil(F.col("vectors") / ROWS).alias("vector_parts"), F.ceil(F.col("visits") / QUERIES).alias("visit_parts"),
        )
        .filter("vector_parts > 1 or visit_parts > 1")
    )
    cells = tables * max(1, math.ceil(n / CELL_ROWS))
    found = stored(
        _ranked(
            _cells(visits, heavy, cells, "visit_parts", "vector_parts", F.col("vec_id")),
            _cells(held, heavy, cells, "vector_parts", "visit_parts", F.col("vec_id")),
            k,
        )
    )
    near = _merged(found, k)
    enough = near.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    few = stored(queries.join(enough, "vec_id", "left_anti"))
    if not few.isEmpty():
        near = _merged(found.unionByName(exact(few, vectors, k, n)), k)
    return near.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact(queries: DataFrame, vectors: DataFrame, k: int, n: int) -> DataFrame:
    """Rows ``(query_id, vec_id, score)``: the queries ``(vec_id, v)`` against all vectors, in blocks of both."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(v=[np.asarray(v, np.float64).tobytes() for v in batch["v"]])

    blocks, parts = max(1, math.ceil(n / ROWS)), max(1, math.ceil(queries.count() / ROWS))
    sized = [x.withColumn("bucket", F.size("v").cast("long")) for x in (queries, vectors)]
    asked, held = (x.mapInPandas(pack, "vec_id long, v binary, bucket long") for x in sized)
    part, block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)), F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks))
    asked = asked.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = held.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    cell = (F.col("part") * blocks + F.col("block")).alias("cell")
    return _ranked(asked.select(cell, "bucket", "vec_id", "v"), held.select(cell, "bucket", "vec_id", "v"), k)
