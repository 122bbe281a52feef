"""Column expressions shared by the jobs and the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType

Instant = str | dt.date | dt.datetime


def ntz(value: Instant) -> Column:
    """A zone-free timestamp literal; a date stands for its midnight.

    The text form is cast, not the Python object: a ``datetime`` literal would
    be a zoned timestamp, and comparing a column with it would cast the column
    and lose the push-down to the file scan.
    """
    return F.lit(str(value)).cast("timestamp_ntz")


def minute_diff(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two zone-free timestamps.

    00:00:59 to 00:01:00 is 1.  ``timestampdiff`` counts whole minutes elapsed
    instead and would give 0.
    """
    days = F.datediff(F.to_date(end), F.to_date(start))
    return (
        days.cast("bigint") * 1440
        + (F.hour(end) - F.hour(start)) * 60
        + (F.minute(end) - F.minute(start))
    )


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, 0.0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def or_zero(column: Column) -> Column:
    """The metric, or 0 where it is NULL."""
    return F.coalesce(column, F.lit(0))


def lenient_double(column: Column) -> Column:
    """The value as double; text that is no number becomes NULL."""
    return column.try_cast("double")


def as_variant(df: DataFrame, name: str) -> Column:
    """The column as a variant: nested values whole, text parsed as JSON."""
    kind = df.schema[name].dataType
    if isinstance(kind, VariantType):
        return F.col(name)
    return F.parse_json(name) if isinstance(kind, StringType) else F.to_variant_object(name)


def text_at(column: str, path: str) -> Column:
    """The value at a path of a variant as text; NULL where the path leads nowhere."""
    return F.try_variant_get(column, path, "string")
