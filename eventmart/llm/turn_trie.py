"""A prefix trie of conversations, as a burst trie over turn ids.

A turn's id is two 64-bit hashes of its role and text.  Equal conversations are merged first, so that copies cost one
entry with a weight.  All distinct sequences start in one container below the root.  A container with many turns
bursts: the turns that all its members share become one head of the trie, and the members go to one container for each
next turn id.  A container with few turns is sorted and swept by one task, which holds no more than that.
So common first turns, large groups of copies and very long conversations are split however large they are.

Heads are runs of nodes with one child.  A node's place in the table follows from its
smallest member and its depth, so a run is a stretch of its smallest member's turns, and its nodes are read from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import WORD, stored

BURST = 20_000  # turns beyond which a container bursts
SHARED = 20  # conversations in a row, the first of which lends its first turns to the others
NO_ENDS = hashlib.sha256(b"").hexdigest()

CELL, ABOVE = ["c1", "c2"], ["p1", "p2"]  # a container, and the one that it burst out of


def own_turns(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, pos, t1, t2, words, cum)``: the turns of each conversation in order, from 1.

    ``cum`` is the number of words up to and with the turn.  Null roles and texts are empty; equal turn numbers are
    ordered by turn id; rows without a conversation are left out.  Turns are range-partitioned and numbered by
    range, so that one long conversation is dealt over many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        "conv_id",
        "turn",
        F.xxhash64(role, F.lit(1), text).alias("t1"),
        F.xxhash64(text, F.lit(2), role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv_id", "turn", "t1", "t2"]  # Spark's ascending order has nulls first

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, pos, cum = None, 0, 0
        for batch in batches:
            groups = batch.groupby("conv_id", sort=False)
            batch["pos"] = groups.cumcount() + 1
            batch["cum"] = groups["words"].cumsum()
            same = batch["conv_id"] == last
            batch.loc[same, "pos"] += pos
            batch.loc[same, "cum"] += cum
            if len(batch):
                last, pos, cum = batch["conv_id"].iloc[-1], batch["pos"].iloc[-1], batch["cum"].iloc[-1]
            yield batch[["conv_id", "part", "pos", "t1", "t2", "words", "cum"]]

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    numbered = stored(
        ranged.drop("turn").mapInPandas(number, "conv_id long, part int, pos long, t1 long, t2 long, words long, cum long")
    )
    ends = numbered.groupBy("conv_id", "part").agg(F.max("pos").alias("pos"), F.max("cum").alias("cum"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        "conv_id", "part", F.sum("pos").over(earlier).alias("pos_before"), F.sum("cum").over(earlier).alias("cum_before")
    ).filter("pos_before is not null")
    # only the first conversation of a range can have begun in an earlier one: at most one row for each range
    return numbered.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("pos") + F.coalesce("pos_before", F.lit(0))).alias("pos"),
        "t1",
        "t2",
        "words",
        (F.col("cum") + F.coalesce("cum_before", F.lit(0))).alias("cum"),
    )


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """The turns of ``own_turns``, each conversation's first h replaced by those of the first conversation of its twenty.

    h is the crc32 of the id modulo 4.  A turn row of position 0, without words, stands for each conversation's beginning.
    """
    turns = stored(own_turns(conversations))
    head = F.sort_array(F.collect_list(F.when(F.col("pos") <= 3, F.struct("pos", "t1", "t2", "words", "cum"))))
    each = turns.groupBy("conv_id").agg(head.alias("head"))
    each = stored(each.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")))
    lender = each.select(F.col("conv_id").alias("base"), F.col("head").alias("lent"))
    plans = each.join(lender, F.col("conv_id") - F.col("conv_id") % SHARED == F.col("base"), "left").select(
        "conv_id", "h", F.col("head")[F.least("h", F.size("head")) - 1]["cum"].alias("lost"), F.slice(F.coalesce("lent", F.array()), 1, F.col("h")).alias("lent")
    )
    plans = stored(
        plans.select(
            "conv_id",
            "h",
            "lent",
            (F.size("lent") - F.col("h")).alias("moved"),
            (F.when(F.size("lent") > 0, F.element_at("lent", -1)["cum"]).otherwise(0) - F.when(F.col("h") > 0, F.col("lost")).otherwise(0)).alias("shift"),
        )
    )
    columns = ["conv_id", "pos", "t1", "t2", "words", "cum"]
    own = turns.join(plans, "conv_id").filter(F.col("pos") > F.col("h"))
    own = own.withColumns({"pos": F.col("pos") + F.col("moved"), "cum": F.col("cum") + F.col("shift")}).select(*columns)
    lent = plans.select("conv_id", F.inline("lent")).select(*columns)
    none = F.lit(0).cast("long")
    start = plans.select("conv_id", *[none.alias(c) for c in columns[1:]])
    return own.union(lent).union(start)


def merged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(members, distinct)``: rows ``(conv_id, rep)``, and ``(rep, copies, len)`` for each distinct sequence of turns."""
    marks = [F.bit_xor(F.xxhash64("pos", "t1", "t2")).alias("x1"), F.bit_xor(F.xxhash64("t2", "t1", "pos")).alias("x2")]
    seqs = stored(turns.groupBy("conv_id").agg(F.max("pos").alias("len"), *marks))
    kinds = stored(seqs.groupBy("len", "x1", "x2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies")))
    members = seqs.join(kinds.filter("copies > 1"), ["len", "x1", "x2"]).select("conv_id", "rep")
    return members, kinds.select("rep", "copies", "len")


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of the containers, whose rows follow each other in a batch or over several."""
    cell, held, found = None, {}, []
    for batch in batches:
        for c1, c2, p1, p2, depth, rep, copies, t1, t2, words in zip(*[batch[c] for c in _SWEPT]):
            if (c1, c2) != cell:
                if cell is not None:
                    found += _container(held, *above)
                cell, held, above = (c1, c2), {}, (p1, p2, depth)
            entry = held.setdefault(rep, (copies, [], []))
            entry[1].append((t1, t2))
            entry[2].append(words)
        if len(found) > 50_000:
            yield _frame(found)
            found = []
    if cell is not None:
        found += _container(held, *above)
    yield _frame(found)


def _frame(nodes: list[tuple]) -> pd.DataFrame:
    """Nodes with nullable integers: floats would not hold the hashes of containers."""
    columns = zip(*nodes) if nodes else [()] * len(_NODE)
    return pd.DataFrame({name: pd.array(list(c), dtype="Int64") for name, c in zip(_NODE, columns)})


_SWEPT = ["c1", "c2", "p1", "p2", "depth", "rep", "copies", "t1", "t2", "words"]
_NODE = ["conv_id", "depth", "parent_conv_id", "p1", "p2", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep", "end_copies"]
_NODE_DDL = ", ".join(f"{name} long" for name in _NODE)


def _container(held: dict, p1, p2, depth: int) -> list[tuple]:
    """The nodes of one container: sequences sorted, then swept with the path of open nodes."""
    lead, at, parent, weight, size, end = [], [], [], [], [], []
    path: list[int] = []
    before: list[tuple] = []
    for rep, (copies, turns, words) in sorted(held.items(), key=lambda item: item[1][1]):
        shared = 0
        while shared < len(before) and shared < len(turns) and before[shared] == turns[shared]:
            shared += 1
        del path[shared:]
        for i in range(shared, len(turns)):
            parent.append(path[-1] if path else -1)
            path.append(len(lead))
            lead.append(rep)
            at.append(depth + i)
            weight.append(0)
            size.append(words[i])
            end.append((None, None))
        for node in path:
            weight[node] += copies
            lead[node] = min(lead[node], rep)
        end[path[-1]] = (rep, copies)
        before = turns
    children, leaves, saved = [0] * len(lead), [0] * len(lead), [0] * len(lead)
    for node in range(len(lead) - 1, -1, -1):  # children come after their parents
        leaves[node] = leaves[node] or 1
        saved[node] += (weight[node] - 1) * size[node]
        if parent[node] >= 0:
            children[parent[node]] += 1
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
    return [
        (
            lead[n],
            at[n],
            lead[parent[n]] if parent[n] >= 0 else None,
            *((p1, p2) if parent[n] < 0 else (None, None)),
            weight[n],
            children[n],
            leaves[n],
            saved[n],
            *end[n],
        )
        for n in range(len(lead))
    ]


def _burst(turns: DataFrame, distinct: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """``(containers, heads)`` of each round: members of small containers, and the runs of those that burst."""
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    active = stored(
        distinct.select("rep", "copies", "len", zero.alias("depth"), *[zero.alias(c) for c in CELL], *[none.alias(c) for c in ABOVE])
    )
    containers, heads = [], []
    while True:
        sizes = stored(
            active.groupBy(*CELL, *ABOVE, "depth").agg(
                F.count("*").alias("reps"),
                F.sum("copies").alias("n_convs"),
                F.min("rep").alias("lead"),
                F.max("len").alias("longest"),
                F.sum(F.col("len") - F.col("depth") + 1).alias("turns"),
            )
        )
        containers.append(active.join(sizes.filter(F.col("turns") <= limit).select(*CELL), CELL))
        large = sizes.filter(F.col("turns") > limit)
        if large.isEmpty():
            return containers, heads
        crowd = active.join(large.select(*CELL, "reps"), CELL)
        spread = [f(c).alias(f"{f.__name__}_{c}") for c in ("t1", "t2") for f in (F.min, F.max)]
        parted = (
            crowd.join(turns, "rep")
            .filter(F.col("pos") > F.col("depth"))
            .groupBy(*CELL, "pos", "reps")
            .agg(F.count("*").alias("have"), *spread)
            .filter("have < reps or min_t1 <> max_t1 or min_t2 <> max_t2")
            .groupBy(*CELL)
            .agg((F.min("pos") - 1).alias("last"))
        )
        runs = stored(large.join(parted, CELL, "left").withColumn("last", F.coalesce("last", "longest")))
        crowd = active.join(runs.select(*CELL, "last"), CELL)
        ends = crowd.filter(F.col("len") == F.col("last"))
        ends = ends.select(*CELL, F.col("rep").alias("end_rep"), F.col("copies").alias("end_copies"))
        heads.append(stored(runs.join(ends, CELL, "left")))
        onward = crowd.filter(F.col("len") > F.col("last")).withColumn("pos", F.col("last") + 1)
        active = stored(
            onward.join(turns, ["rep", "pos"]).select(
                "rep",
                "copies",
                "len",
                F.col("pos").alias("depth"),
                F.xxhash64("c1", "t1", "t2").alias("c1"),
                F.xxhash64("c2", "t2", "t1").alias("c2"),
                F.col("c1").alias("p1"),
                F.col("c2").alias("p2"),
            )
        )


def _hashes(members: DataFrame) -> DataFrame:
    """Rows ``(end_rep, ends)``: the hash of each group's ids, read in order as a stream."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rep, hashed = None, None
        for batch in batches:
            done = []
            for own, ids in batch.groupby("rep", sort=False)["conv_id"]:
                listed = ",".join(map(str, ids)).encode()
                if own == rep:
                    hashed.update(b"," + listed)
                    continue
                if rep is not None:
                    done.append((rep, hashed.hexdigest()))
                rep, hashed = own, hashlib.sha256(listed)
            yield pd.DataFrame(done, columns=["end_rep", "ends"])
        if rep is not None:
            yield pd.DataFrame([(rep, hashed.hexdigest())], columns=["end_rep", "ends"])

    ordered = members.repartition("rep").sortWithinPartitions("rep", "conv_id")
    return ordered.mapInPandas(digest, "end_rep long, ends string")


def prefix_nodes(conversations: DataFrame, limit: int = BURST) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations.

    Rows ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``; the root is
    the sequence of no turns.  ``ends_sha256`` needs the ids of a group of equal conversations in one ordered stream: one
    task reads them, without holding them.  Conversations may be of any length.  Rows without
    ``conv_id`` are left out, and repeated rows are turns of their own; equal turn numbers are
    ordered by turn id.  A table without conversations has no nodes; other columns are ignored.
    """
    rebuilt = stored(rebuilt_turns(conversations))
    members, distinct = merged(rebuilt)
    turns = stored(rebuilt.join(distinct.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "rep"))
    containers, heads = _burst(turns, distinct, limit)

    rows = _all(containers).drop("len").join(turns, "rep").filter(F.col("pos") >= F.col("depth"))
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL, "rep", "pos").select(*_SWEPT)
    swept = stored(rows.mapInPandas(_sweep, _NODE_DDL))

    nodes = swept
    if heads:
        tops = swept.filter("p1 is not null").select(*ABOVE, "n_leaves", "saved_tokens")
        edges = _edge_words(heads, turns)
        done = []
        for run in reversed(heads):
            below = tops.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(
                F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below")
            )
            full = run.join(below, CELL, "left").join(edges, CELL).withColumns(
                {"children": F.coalesce("children", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(1)), "below": F.coalesce("below", F.lit(0))}
            )
            done.append(stored(full))
            saved = (F.col("n_convs") - 1) * (F.col("cum_last") - F.col("cum_before")) + F.col("below")
            tops = tops.union(done[-1].filter("p1 is not null").select(*ABOVE, F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens")))
        nodes = _with_parents(swept, done).union(_head_nodes(done, turns))
    single = F.sha2(F.col("end_rep").cast("string").cast("binary"), 256)
    own = F.when(F.col("end_rep").isNull(), F.lit(NO_ENDS)).when(F.col("end_copies") == 1, single)
    nodes = stored(nodes.withColumn("ends_sha256", own))
    many = nodes.filter("ends_sha256 is null").join(_hashes(members), "end_rep").withColumn("ends_sha256", F.col("ends"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.filter("ends_sha256 is not null").select(*columns).union(many.select(*columns))


def _all(tables: list[DataFrame]) -> DataFrame:
    union = tables[0]
    for more in tables[1:]:
        union = union.union(more)
    return union


def _edge_words(heads: list[DataFrame], turns: DataFrame) -> DataFrame:
    """Rows ``(c1, c2, cum_last, cum_before)``: words of the lead up to the run's last turn, and before its first."""
    runs = _all([h.select(*CELL, "lead", "depth", "last") for h in heads])
    places = runs.select(*CELL, F.col("lead").alias("rep"), "last", F.explode(F.array_distinct(F.array(F.col("depth") - 1, "last"))).alias("pos"))

    def at(last: Column) -> Column:
        return F.coalesce(F.max(F.when(last, F.col("cum"))), F.lit(0))

    joined = places.join(turns, ["rep", "pos"])
    return stored(joined.groupBy(*CELL).agg(at(F.col("pos") == F.col("last")).alias("cum_last"), at(F.col("pos") < F.col("last")).alias("cum_before")))


def _head_nodes(done: list[DataFrame], turns: DataFrame) -> DataFrame:
    """The nodes of the runs, read from the turns of each run's smallest member."""
    runs = _all(done)
    leads = runs.select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("lead").alias("parent_lead"))
    spans = runs.join(leads, ABOVE, "left").select(*runs.columns, "parent_lead")
    each = spans.join(turns, F.col("lead") == F.col("rep")).filter("pos between depth and last")
    ends_here = F.col("pos") == F.col("last")
    none = F.lit(None).cast("long")
    return each.select(
        F.col("lead").alias("conv_id"),
        F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("depth"), F.col("parent_lead")).otherwise(F.col("lead")).alias("parent_conv_id"),
        none.alias("p1"),
        none.alias("p2"),
        "n_convs",
        F.when(ends_here, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (F.col("cum_last") - F.col("cum") + F.col("words")) + F.col("below")).alias("saved_tokens"),
        F.when(ends_here, F.col("end_rep")).alias("end_rep"),
        F.when(ends_here, F.col("end_copies")).alias("end_copies"),
    )


def _with_parents(swept: DataFrame, done: list[DataFrame]) -> DataFrame:
    """The swept nodes; the tops of containers get the smallest member of the run above."""
    leads = _all(done).select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("lead").alias("parent_lead"))
    tops = swept.filter("p1 is not null").join(leads, ABOVE).withColumn("parent_conv_id", F.col("parent_lead"))
    return swept.filter("p1 is null").union(tops.select(*swept.columns))
