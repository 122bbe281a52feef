"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.

DataFrame operations only.  Texts are read once, for their sizes; what follows runs on narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import WORD, stored, unit

BUCKET_ROWS = 20_000  # documents of a source that share a bucket of the seeded order, about


def size_of(text: Column) -> Column:
    """The number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the given weights in turn over the sources by code point, null last.

    Ranks one row per source, so its cost follows the number of sources.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(values, (place % len(weights)).cast("int")))


def water_fill(sources: DataFrame, total: float, max_epochs: float = 3.0) -> DataFrame:
    """Add ``target`` to rows ``(source, source_size, weight)``; targets sum to ``total`` where the caps allow it.

    A source above its cap (``max_epochs`` times its size) is clamped to it, and the rest is shared by
    weight among the others, until none is above.  Each round reads one row of sums; a round
    clamps at least one source.  If all are clamped the total is not reached.
    """
    cap = F.col("source_size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        free = cap > F.col("weight") * level
        sums = sources.agg(
            F.coalesce(F.sum(F.when(~free, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(~free, 1)).alias("clamped"),
        ).first()
        if sums.weight == 0 or sums.clamped == clamped:
            break
        clamped, level = sums.clamped, (total - sums.taken) / sums.weight
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] | DataFrame = (1, 2, 3),
    max_epochs: float = 3.0,
    total: float | None = None,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Rows ``(doc_id, size, source, source_size, weight, target, taken)``, one for each document.

    ``weights``: weights in turn by the order of sources, or rows ``(source, weight)`` (absent: weight 0).
    ``total``: words of the mix, by default those of all documents.  ``taken`` is the whole repetitions
    of the document's words, the same for a whole source, plus those of one partial repetition: documents
    in a seeded order are taken once more until the target is reached, the last of them in part.

    Null source: a source of its own, last.  Null or empty text: size 0, nothing taken.  A source of
    no words has target 0.  Repeated rows count each; equal rows share the order in any way.
    An empty table gives no rows.  Reruns agree.
    """
    sized = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"))
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("given_source"), F.col("weight").cast("double"))
        weighted = sources.join(given, F.col("source").eqNullSafe(F.col("given_source")), "left").drop("given_source")
        weighted = weighted.fillna(0.0, ["weight"])
    else:
        weighted = cycled_weights(sources, weights)
    weighted = stored(weighted)
    if total is None:
        total = float(weighted.agg(F.sum("source_size")).first()[0] or 0)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = (
        water_fill(weighted, total, max_epochs)
        .withColumn("whole", F.least(whole, F.lit(int(max_epochs))).cast("long"))
        .withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
        .withColumn("buckets", F.ceil(F.col("source_rows") / BUCKET_ROWS))
    )
    planned = stored(planned)

    # The seeded order: buckets of it first, whose sums show in which bucket the target is reached.
    order = unit(F.col("doc_id"), F.col("size"), seed=seed)
    same_source = F.col("source").eqNullSafe(F.col("of"))
    rows = (
        sized.join(planned.withColumnRenamed("source", "of"), same_source, "inner")
        .drop("of")
        .withColumn("order", order)
        .withColumn("bucket", F.floor(F.col("order") * F.col("buckets")).cast("long"))
    )
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    last = stored(  # a row for each source: written, its size is known, and Spark broadcasts it if it is small
        sums.withColumn("before", upto - F.col("words"))
        .filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select(F.col("source").alias("of"), F.col("bucket").alias("cut"), "before")
    )
    marked = rows.join(last, same_source, "left").drop("of")
    inside = F.col("bucket") == F.col("cut")
    settled = marked.filter(F.coalesce(~inside, F.lit(True))).withColumn(
        "extra", F.when(F.coalesce(F.col("bucket") < F.col("cut"), F.lit(True)), F.col("size")).otherwise(0)
    )
    running = F.sum("size").over(Window.partitionBy("source").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    room = F.col("rest") - F.col("before") - F.coalesce(running, F.lit(0))
    partly = marked.filter(inside).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), room)))
    return settled.unionByName(partly).select(
        "doc_id", "size", "source", "source_size", "weight", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )


def repeated(docs: DataFrame, weights: tuple[float, ...] | DataFrame = (1, 2, 3), max_epochs: float = 3.0, seed: int = 42) -> DataFrame:
    """The mix as rows of ``docs``: each as often as ``mix`` takes it, with the same columns.

    A partial repetition has the first words of the text, up to the end of the last one taken; ``n_chars``
    follows.  Rows of which nothing is taken are absent.  ``docs`` needs ``doc_id``, ``text``,
    ``source`` and ``n_chars``; rows that share an id (and a source) are taken alike, by their size.
    """
    keys = ["doc_id", "source", "size"]
    plan = mix(docs, weights, max_epochs, seed=seed).groupBy(*keys).agg(F.max("taken").alias("taken")).filter("taken > 0")
    plan = plan.toDF("_doc_id", "_source", "_size", "taken")
    sized = docs.withColumn("size", size_of(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    joined = sized.join(plan, same)
    whole, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    parts = F.array_compact(F.concat(F.array_repeat(F.lit(0), whole), F.array(F.when(rest > 0, rest).otherwise(None))))
    rows = joined.withColumn("part", F.explode(parts))
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), 0)
    rows = rows.withColumn("text", F.when(F.col("part") > 0, F.array_join(F.slice(words, F.lit(1), F.col("part")), "")).otherwise(F.col("text")))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
