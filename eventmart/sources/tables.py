"""Reading, creating and registering the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from eventmart.layout import BUCKET, Layout, Table


def read_stored(spark: SparkSession, table: Table) -> DataFrame:
    """The table with its bucket column.

    Where it is registered in the catalog, which knows its partitions, Spark lists only the files of
    those that a query needs; by path it lists the whole tree.
    """
    if is_registered(spark, table):
        return spark.read.table(table.name)
    return spark.read.schema(table.stored_ddl).parquet(table.path)


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    """The table's own columns."""
    return read_stored(spark, table).drop(BUCKET)


def read_if_exists(spark: SparkSession, table: Table) -> DataFrame | None:
    """The table with its bucket column, or None where its path is missing."""
    try:
        return read_stored(spark, table)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ensure_tables(spark: SparkSession, layout: Layout, layer: str | None = None) -> None:
    """Create the tables (of one layer, or all) that do not exist yet, empty."""
    for table in layout.tables.values():
        if layer in (None, table.name.split(".")[0]):
            empty = spark.createDataFrame([], table.stored_ddl)
            empty.write.mode("ignore").partitionBy(BUCKET).parquet(table.path)


def register_tables(spark: SparkSession, layout: Layout) -> None:
    """Make the tables known to the catalog under their names, for SQL users.

    Once is enough: merges add the partitions that they fill.  Run it again after files were put in place
    by other means.
    """
    ensure_tables(spark, layout)
    for table in layout.tables.values():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.name.split('.')[0]}")
        ddl = table.spec.ddl.replace(
            "`ingested_at` timestamp_ntz", "`ingested_at` timestamp_ntz DEFAULT localtimestamp()"
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.name} ({ddl}, {BUCKET} int) USING parquet "
            f"PARTITIONED BY ({BUCKET}) LOCATION '{table.path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table.name}")
        spark.catalog.refreshTable(table.name)


def is_registered(spark: SparkSession, table: Table) -> bool:
    """Whether the catalog has the table under its name and at its path."""
    if not spark.catalog.tableExists(table.name):
        return False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").filter("col_name = 'Location'").collect()
    location = spark._jvm.org.apache.hadoop.fs.Path(rows[0]["data_type"]) if rows else None
    path = spark._jvm.org.apache.hadoop.fs.Path(table.path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return location is not None and files.makeQualified(path).equals(files.makeQualified(location))


def add_partitions(spark: SparkSession, table: Table, buckets: Sequence[int]) -> None:
    """Tell the catalog, where the table is registered, of buckets that got files."""
    if not is_registered(spark, table):
        return
    if buckets:
        listed = " ".join(f"PARTITION ({BUCKET} = {bucket})" for bucket in buckets)
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {listed}")
    spark.catalog.refreshTable(table.name)
