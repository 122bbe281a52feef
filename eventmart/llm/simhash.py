"""SimHash fingerprints and search within a Hamming radius, by DataFrame operations only.

Terms are exploded and summed rather than folded with higher-order functions, so that the votes
stay in generated code: a long holds two counters of 32 bits, and 32 sums make 64 bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored

LONGS = 2  # longs of 64 bits in a fingerprint
BITS = 64 * LONGS
SPACES = r"[\x20\x09-\x0D]+"
LONGEST = 16  # letters of a word that add to its weight

_PAIR = 0x0000000100000001


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Rows ``(*keys, fingerprint)``, one for each distinct combination of keys: 128 bits as 32 hex digits.

    The terms are the words in lower case.  Each occurrence votes with the square of the word's
    length (16 at most), so that short, common words say little: a bit is set if the words
    that hash to it outweigh the others.  Rows with equal keys are taken as copies of one text.
    Null and wordless texts have no votes: all bits are 0.  Null keys are kept.
    """
    word = texts.select(*keys, F.explode(F.split(F.lower(F.coalesce(text_col, F.lit(""))), SPACES)).alias("_word"))
    size = F.least(F.length("_word"), F.lit(LONGEST)).cast("long")
    word = word.select(*keys, (size * size).alias("_w"), *[F.xxhash64("_word", F.lit(i)).alias(f"_h{i}") for i in range(LONGS)])
    counts = [
        F.sum(F.shiftright(f"_h{i}", j).bitwiseAND(F.lit(_PAIR)) * F.col("_w")).alias(f"_c{i}_{j}")
        for i in range(LONGS)
        for j in range(32)
    ]
    votes = word.groupBy(*keys).agg(F.sum("_w").alias("_all"), *counts)
    parts = []
    for i in range(LONGS):
        bits = F.lit(0).cast("long")
        for j in range(32):
            count = F.col(f"_c{i}_{j}")
            few, many = count.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(count, 32)
            for value, bit in ((few, j), (many, j + 32)):
                bits = bits.bitwiseOR(F.when(value * 2 > F.col("_all"), F.lit(_signed(1 << bit))).otherwise(F.lit(0)))
        parts.append(F.lpad(F.lower(F.hex(bits)), 16, "0"))
    return votes.select(*keys, F.concat(*parts).alias("fingerprint"))


def _long(fingerprint: Column, i: int) -> Column:
    """The i-th long of a fingerprint, from two halves so that the sign bit is no overflow."""
    high = F.conv(F.substring(fingerprint, 16 * i + 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(fingerprint, 16 * i + 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def distance(a: Column, b: Column) -> Column:
    """The number of bits in which two fingerprints differ."""
    parts = [F.bit_count(_long(a, i).bitwiseXOR(_long(b, i))) for i in range(LONGS)]
    return sum(parts[1:], parts[0])


def likeness(a: Column, b: Column) -> Column:
    """The share of bits in which two fingerprints agree: 0 to 1."""
    return 1.0 - distance(a, b) / float(BITS)


def within_radius(prints: DataFrame, radius: int = 3, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All fingerprints at most ``radius`` bits apart: ``(pairs, members)``.

    ``members`` has ``(id, class_id)``: ids of equal fingerprints share their smallest id as class.
    ``pairs`` has ``(a, b, distance)`` with a < b between classes.  The bits are cut into ``radius + 2``
    blocks; two near fingerprints agree in at least two of them, so one table for each pair of
    blocks finds them all, and the first table in which they meet reports them.  Null
    fingerprints and null ids belong to no class.  Empty input gives empty tables.
    """
    rows = prints.select(F.col(id_col).alias("id"), "fingerprint").filter("id is not null and fingerprint is not null")
    classes = rows.groupBy("fingerprint").agg(F.min("id").alias("class_id"))
    members = rows.join(classes, "fingerprint").select("id", "class_id").distinct()
    digits, count = BITS // 4, radius + 2
    cuts = [round(digits * i / count) for i in range(count + 1)]
    tables = list(combinations(range(count), 2))

    def block(fingerprint: Column, i: int) -> Column:
        return F.substring(fingerprint, cuts[i] + 1, cuts[i + 1] - cuts[i])

    def key(fingerprint: Column, table: tuple[int, int]) -> Column:
        return F.concat(*[block(fingerprint, i) for i in table])

    fp = F.col("fingerprint")
    keyed = classes.select(
        "class_id", "fingerprint", F.posexplode(F.array(*[key(fp, t) for t in tables])).alias("table", "key")
    )
    left, right = keyed.alias("x"), keyed.alias("y")
    x, y = F.col("x.fingerprint"), F.col("y.fingerprint")
    first = F.array_position(F.array(*[key(x, t) == key(y, t) for t in tables]), True) - 1
    pairs = (
        left.join(right, (F.col("x.table") == F.col("y.table")) & (F.col("x.key") == F.col("y.key")))
        .filter(F.col("x.class_id") < F.col("y.class_id"))
        .filter(first == F.col("x.table"))
        .select(F.col("x.class_id").alias("a"), F.col("y.class_id").alias("b"), distance(x, y).alias("distance"))
        .filter(F.col("distance") <= radius)
    )
    return pairs, members


def predecessors(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, previous)`` over distinct ids in ascending order; the first follows the last.

    ``docs`` has ``doc_id`` and ``n_chars``; ``previous_chars`` is the largest ``n_chars`` of the previous id.
    Ids are range-partitioned, each range is ordered by itself, and the ranges' last ids link them.
    """
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    ranged = stored(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()))
    here = F.struct("doc_id", "n_chars")
    ends = ranged.groupBy("part").agg(F.max(here).alias("end"))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(  # one row for each range
        F.col("part").alias("at"), F.coalesce(F.lag("end").over(Window.orderBy("part")), F.max("end").over(every)).alias("before")
    )
    before = F.lag(here).over(Window.partitionBy("part").orderBy("doc_id"))
    return (
        ranged.withColumn("own", before)
        .join(ends, F.col("part") == F.col("at"))
        .select("doc_id", F.coalesce("own", "before").alias("p"))
        .select("doc_id", F.col("p.doc_id").alias("previous"), F.col("p.n_chars").alias("previous_chars"))
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of
    the next document's (ascending id, the last is followed by the first).  Rows ``(doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    Null text: empty.  Equal rows give one row; rows that share an id but not the text each give
    one, and the next document is then the one with the smallest text hash.  A null id has no
    place in the order: its next document is empty and ``near_next`` null.  A table of one id
    follows itself.  An empty table gives no rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    links = stored(predecessors(named.select("doc_id", F.length("text").cast("long").alias("n_chars"))))
    # the one shuffle of whole texts: its columns are the same for both uses, so that Spark runs it once
    placed = named.join(links, "doc_id", "left").withColumn("hash", F.xxhash64("text"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))
    heads = (
        placed.withColumn("row", first)
        .filter("row = 1 and previous is not null")
        .select(F.col("previous").alias("doc_id"), F.expr("substring(text, 1, cast(previous_chars div 2 as int))").alias("head"))
    )
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.coalesce(F.substring("head", F.lit(1), half), F.lit("")))
    pairs = placed.join(heads, "doc_id", "left").withColumn("edited", edited)
    texts = pairs.select(
        "doc_id", "hash", length.cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.posexplode(F.array("text", "edited")).alias("kind", "text"),
    )
    keys = ["doc_id", "hash", "n_chars", "sha"]
    prints = fingerprints(texts, [*keys, "kind"])
    both = stored(
        prints.groupBy(*keys).agg(
            F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
        )
    )
    following = both.groupBy("doc_id").agg(F.min_by("fingerprint", "hash").alias("next")).join(links, "doc_id")
    following = following.select(F.col("previous").alias("doc_id"), "next")
    return both.join(following, "doc_id", "left").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
