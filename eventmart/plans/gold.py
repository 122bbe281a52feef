"""Metrics per user, session and product.

Each metric table is described once: its keys, sums over source rows that can be merged, and the columns that follow from
the sums.  The functions read the rows stamped after ``since`` and take a ``scope``:

* ``"batch"``: metrics of those rows alone.  Merged into a stored table they
  replace a returning key's row, so it then shows its last batch.
* ``"touched"``: lifetime metrics, over all rows, of the keys that have one of
  those rows.

Both agree on a first load.  ``"touched"`` keeps the rows of the new keys by a semi
join below the aggregate, so that history of other keys is not aggregated: a
broadcast where the new keys are few, else a sort-merge join whose large partitions
Spark can split.  (The load jobs keep stored sums instead and do not read history, see ``lifetime``.)
The NULL group is treated like any other.

Every result row carries the latest stamp of the batch as ``ingested_at``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import Instant, guarded_ratio, minute_diff, ntz
from eventmart.operators.incremental import newer_than

Scope = Literal["batch", "touched"]

CLICK_TYPES = ("view_product", "add_to_cart", "remove_from_cart")


@dataclass(frozen=True)
class Metrics:
    """A metric table: ``sums`` are aggregates that add up over parts of the rows, ``derived`` follow from them.

    ``columns`` are the table's columns in order.
    """

    keys: tuple[str, ...]
    sums: Mapping[str, Column]
    derived: Mapping[str, Column]
    columns: tuple[str, ...]

    def finish(self, sums: DataFrame, stamp: Column) -> DataFrame:
        """The metric rows, from rows of keys and sums."""
        return sums.withColumns({**self.derived, "ingested_at": stamp}).select(*self.columns)


def _of_users() -> Metrics:
    kind = F.col("event_type")
    return Metrics(
        ("user_id",),
        {
            "total_events": F.count("*"),
            "num_purchases": F.count_if(kind == "purchase"),
            "num_clicks": F.count_if(kind.isin(*CLICK_TYPES)),
        },
        {"conversion_rate": guarded_ratio(F.col("num_purchases"), F.col("num_clicks"))},
        ("user_id", "total_events", "num_purchases", "num_clicks", "conversion_rate", "ingested_at"),
    )


def _of_sessions() -> Metrics:
    minutes = minute_diff(F.col("start_time"), F.col("end_time"))
    timed = F.col("timed_events")
    return Metrics(
        ("session_id", "user_id"),
        {
            "num_events": F.count("*"),
            "total_minutes": F.coalesce(F.sum(minutes), F.lit(0)),
            "timed_events": F.count(minutes),
        },
        {
            "session_duration_minutes": F.when(timed > 0, F.col("total_minutes") / timed),
            "is_bounce": F.col("num_events") == 1,
        },
        ("session_id", "user_id", "session_duration_minutes", "num_events", "is_bounce", "ingested_at"),
    )


def _of_products() -> Metrics:
    kind = F.col("event_type")
    return Metrics(
        ("product_id",),
        {
            "num_views": F.count_if(kind == "view_product"),
            "num_add_to_cart": F.count_if(kind == "add_to_cart"),
            "num_purchases": F.count_if(kind == "purchase"),
        },
        {
            "click_to_purchase_rate": guarded_ratio(
                F.col("num_purchases"), F.col("num_views") + F.col("num_add_to_cart")
            )
        },
        ("product_id", "num_views", "num_add_to_cart", "num_purchases", "click_to_purchase_rate", "ingested_at"),
    )


# Built when asked for: columns need a running session.
METRICS = {
    "gold.user_metrics": _of_users,
    "gold.session_metrics": _of_sessions,
    "gold.product_metrics": _of_products,
}


def user_metrics(
    events: DataFrame,
    since: Instant | None = None,
    scope: Scope = "batch",
    stamp: Instant | None = None,
) -> DataFrame:
    """Events, purchases, clicks (views, cart adds and removals) and purchases per click."""
    return _metrics(_of_users(), events, since, scope, stamp)


def session_metrics(
    session_events: DataFrame,
    since: Instant | None = None,
    scope: Scope = "batch",
    stamp: Instant | None = None,
) -> DataFrame:
    """Duration in minutes (their mean over the events), kept events and whether there was only one of them."""
    return _metrics(_of_sessions(), session_events, since, scope, stamp)


def product_metrics(
    events: DataFrame,
    since: Instant | None = None,
    scope: Scope = "batch",
    stamp: Instant | None = None,
) -> DataFrame:
    """Views, cart adds, purchases, and purchases per view or cart add.

    Events without a product form the group of product NULL.
    """
    return _metrics(_of_products(), events, since, scope, stamp)


def _metrics(metrics: Metrics, rows: DataFrame, since: Instant | None, scope: Scope, stamp: Instant | None) -> DataFrame:
    sums = [column.alias(name) for name, column in metrics.sums.items()]
    return metrics.finish(_aggregate(rows, metrics.keys, sums, since, scope), _stamp(rows, since, stamp))


def _aggregate(
    rows: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Column],
    since: Instant | None,
    scope: Scope,
) -> DataFrame:
    if scope == "batch":
        return newer_than(rows, since).groupBy(*keys).agg(*metrics)
    if scope != "touched":
        raise ValueError(f"unknown scope: {scope}")
    if since is not None:
        new = newer_than(rows, since).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        rows = rows.join(new, same, "left_semi")
    return rows.groupBy(*keys).agg(*metrics)


def _stamp(rows: DataFrame, since: Instant | None, stamp: Instant | None) -> Column:
    """The given batch stamp, or the latest one of the batch as a scalar subquery."""
    if stamp is not None:
        return ntz(stamp)
    return newer_than(rows, since).agg(F.max("ingested_at")).scalar()
