"""Raw input files and report export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from eventmart.schemas import EVENTS_RAW, SESSIONS_RAW

Paths = str | Sequence[str]

REJECTED = "_rejected"


def _as_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, ddl: str, keep_text: bool) -> DataFrameReader:
    """A reader with the columns and, if asked for, the text of malformed records."""
    if not keep_text:
        return spark.read.schema(ddl)
    return spark.read.schema(f"{ddl}, {REJECTED} string").option("columnNameOfCorruptRecord", REJECTED)


def read_events_csv(
    spark: SparkSession,
    paths: Paths,
    mode: str = "FAILFAST",
    line_breaks: bool = False,
    keep_text: bool = False,
) -> DataFrame:
    """Event files: one header line, five columns by position, optional quotes.

    A doubled quote inside a quoted field is one quote; an empty unquoted field
    is NULL, as is the marker ``\\N`` in a text column.  A malformed value, or a row
    of too few fields, raises; with ``mode="PERMISSIVE"`` it becomes NULL, and
    cleaning drops the row where the column is required.  ``line_breaks=True`` allows
    line breaks within quoted fields; a file is then read by one task.  ``keep_text`` adds the
    text of malformed lines as a column, NULL for others.
    """
    rows = (
        _reader(spark, EVENTS_RAW, keep_text)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .option("mode", mode)
        .csv(_as_list(paths))
    )
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string" and f.name != REJECTED]
    return rows.withColumns({name: F.nullif(F.col(name), F.lit("\\N")) for name in texts})


def read_sessions_json(
    spark: SparkSession,
    paths: Paths,
    lines: bool = False,
    mode: str = "FAILFAST",
    keep_text: bool = False,
) -> DataFrame:
    """Session files: a top-level array per file, each element one row.

    Nested values are kept whole as variants, with all their fields; a missing one is NULL.
    Such a file cannot be split, so it is read by one task; many files are read
    in parallel.  ``lines=True`` reads one object per line, which can be split:
    use it for large inputs.
    """
    return (
        _reader(spark, SESSIONS_RAW, keep_text)
        .option("multiLine", not lines)
        .option("mode", mode)
        .json(_as_list(paths))
    )


REJECTS_DDL = "file string, line string, fields string, load string"


def read_events_csv_lenient(spark: SparkSession, paths: Paths, line_breaks: bool = False) -> tuple[DataFrame, DataFrame]:
    """``read_events_csv`` as ``(events, rejects)``: what fails there is set aside with its text, not lost.

    ``rejects`` has ``(file, line, fields)``: the lines with a malformed value or another number of fields, and what could be
    read of them as JSON.  Every line but headers is in one of the two.  Both are to be stored
    before they are queried: Spark tells malformed records by the columns that a query uses, here all.
    """
    rows = read_events_csv(spark, paths, "PERMISSIVE", line_breaks, keep_text=True)
    return _parted(rows)


def read_sessions_json_lenient(spark: SparkSession, paths: Paths, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """``read_sessions_json`` as ``(sessions, rejects)``; a file with a malformed array is one rejected text."""
    return _parted(read_sessions_json(spark, paths, lines, "PERMISSIVE", keep_text=True))


def _parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bad = F.col(REJECTED).isNotNull()
    rejects = rows.filter(bad).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(REJECTED).alias("line"),
        F.to_json(F.struct(*[name for name in rows.columns if name != REJECTED])).alias("fields"),
    )
    return rows.filter(~bad).drop(REJECTED), rejects


def write_rejects(rejects: DataFrame, path: str, load: str) -> None:
    """Keep the rejects of a load, in place of those of an earlier attempt at the same load."""
    rejects.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(file, line, fields, load)`` of all loads; none where nothing was ever rejected."""
    try:
        return spark.read.schema(REJECTS_DDL).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], REJECTS_DDL)
        raise


def write_report_csv(report: DataFrame, path: str) -> None:
    """Write a report as CSV files with a header, one or more per ``path``."""
    (
        report.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
