"""Report queries over the metric tables.

Dates select by ``ingested_at``, the stamp of the batch that last wrote a key,
not by event time.  ``end`` defaults to ``start``; with neither, the last 30 days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import ntz, or_zero
from eventmart.operators.histogram import histogram

Day = str | dt.date


def date_range(start: Day | None = None, end: Day | None = None) -> tuple[dt.date, dt.date]:
    """The range as two dates, with the defaults filled in."""
    if start is None:
        last = _as_date(end) if end is not None else dt.date.today()
        return last - dt.timedelta(days=30), last
    first = _as_date(start)
    return first, (first if end is None else _as_date(end))


def kpis(
    session_metrics: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    whole_end_day: bool = False,
    zero_when_empty: bool = False,
) -> DataFrame:
    """Distinct users, distinct sessions and mean session duration: one row.

    The range ends at the midnight that opens the end date, unless
    ``whole_end_day``.  An empty range gives a NULL duration, or 0.0 with
    ``zero_when_empty``.
    """
    rows = session_metrics.filter(_stamped(start, end, whole_end_day))
    duration = F.avg("session_duration_minutes")
    means = rows.agg((or_zero(duration) if zero_when_empty else duration).alias("avg_session_duration"))
    # two counts of their own, where one aggregate with both would double every row first
    users, sessions = (rows.select(name).distinct().agg(F.count(name)).scalar() for name in ("user_id", "session_id"))
    return means.select(users.alias("users"), sessions.alias("sessions"), "avg_session_duration")


def user_behavior(
    user_metrics: DataFrame, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Metrics of each user in the range, whole end day included."""
    return user_metrics.filter(_stamped(start, end, whole_end_day=True)).select(
        "user_id", "total_events", "num_purchases", "num_clicks", "conversion_rate"
    )


def total_events_histogram(
    user_metrics: DataFrame, start: Day | None = None, end: Day | None = None, bins: int = 20
) -> DataFrame:
    """Users by number of events."""
    return histogram(user_behavior(user_metrics, start, end), "total_events", bins)


def conversion_rate_histogram(
    user_metrics: DataFrame, start: Day | None = None, end: Day | None = None, bins: int = 20
) -> DataFrame:
    """Users by conversion rate."""
    return histogram(user_behavior(user_metrics, start, end), "conversion_rate", bins)


def funnel(
    product_metrics: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    whole_end_day: bool = False,
) -> DataFrame:
    """Total views, cart adds and purchases: one row, zeros for an empty range.

    The range ends at the midnight that opens the end date, unless ``whole_end_day``.
    """
    return product_metrics.filter(_stamped(start, end, whole_end_day)).agg(
        or_zero(F.sum("num_views")).alias("views"),
        or_zero(F.sum("num_add_to_cart")).alias("add_to_cart"),
        or_zero(F.sum("num_purchases")).alias("purchases"),
    )


def top_products(
    product_metrics: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    whole_end_day: bool = False,
    limit: int = 10,
) -> DataFrame:
    """The products with most purchases; equal ones by product_id.

    The range ends at the midnight that opens the end date, unless ``whole_end_day``.
    """
    return (
        product_metrics.filter(_stamped(start, end, whole_end_day))
        .select("product_id", "num_purchases", "num_add_to_cart", "num_views")
        .orderBy(F.desc("num_purchases"), F.asc_nulls_last("product_id"))
        .limit(limit)
    )


def _as_date(day: Day) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def _stamped(start: Day | None, end: Day | None, whole_end_day: bool) -> Column:
    first, last = date_range(start, end)
    stamp = F.col("ingested_at")
    if whole_end_day:
        return F.to_date(stamp).between(F.lit(first), F.lit(last))
    return stamp.between(ntz(first), ntz(last))
