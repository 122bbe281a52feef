"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import lenient_double


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Count rows in ``bins`` equal bins over [min, max] of ``column``.

    Returns bin, bin_lo, bin_hi and num_users.  The maximum falls in the last
    bin, a single-valued column in bin 1; empty bins are left out, as are values
    that are NULL or no number.  The bounds come from a scalar subquery, so the
    data is only aggregated, never joined.
    """
    x = F.col("_x")
    values = df.select(lenient_double(F.col(column)).alias("_x")).filter(
        x.isNotNull() & ~F.isnan(x)
    )
    bounds = values.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    position = F.floor((x - lo) / (hi - lo) * bins) + 1
    bin_ = F.when(lo == hi, F.lit(1)).otherwise(F.least(position, F.lit(bins)))
    width = (hi - lo) / bins
    return (
        values.select(bin_.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("num_users"))
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
            (lo + F.col("bin") * width).alias("bin_hi"),
            "num_users",
        )
    )
