"""Helpers of the operators: shared storage, held-out rows, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # what the contracts call a word


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only in local mode without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventmart-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to shared storage and read them back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table made by ``stored`` that no later plan reads."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; rows without an id count as held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def unit(*columns: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that follows from the columns and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) / F.lit(float(1 << 53))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected links ``(a, b)``: rows ``(node, root)``.

    ``root`` is the smallest id of the component; only ids in links appear.  Large-star and
    small-star steps alternate until no edge changes.  Each step is a minimum per key (combined
    before the shuffle) and a join back that Spark may split; edges are kept as written tables.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("m")).distinct())
    mark = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("m").alias("n"), F.col("n").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("root"))
        large = both.join(low, "n").filter("m > n").select(F.col("m").alias("n"), F.col("root").alias("m"))
        # nodes without a larger neighbour keep their own edges through the other end
        large = stored(large.filter("n <> m").distinct())
        down = large.groupBy("n").agg(F.min("m").alias("root"))
        small = large.join(down, "n").select(F.col("m").alias("n"), F.col("root").alias("m"))
        after = stored(small.union(down.select("n", F.col("root").alias("m"))).filter("n <> m").distinct())
        drop_stored(large)
        drop_stored(edges)
        edges = after
        seen = edges.agg(F.count("*").alias("c"), F.sum(F.xxhash64("n", "m").cast("decimal(38,0)")).alias("s")).first()
        if mark == (seen.c, seen.s):
            break
        mark = (seen.c, seen.s)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("n").alias("node"), F.col("m").alias("root"))
    return roots.union(edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())
