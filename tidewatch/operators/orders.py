"""State of an order from its create and pay events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import SECOND, micros
from .slices import with_neighbours

PAID = "payed successfully"
PAID_LATE = "payed but timeout"
NO_CREATE = "payed but not found create"
TIMED_OUT = "timeout"


def order_results(
    logs: DataFrame,
    within_s: int = 900,
    grace_s: int | None = None,
    create: str = "create",
    pay: str = "pay",
    key: str = "order_id",
    kind: str = "event_type",
    arrival: str = "arrival",
    ts: str = "ts",
    slice_s: int = 600,
) -> DataFrame:
    """``key, us, result_msg``; ``us`` is the time of the pay, or of the create
    that timed out.

    A pay right after a create is ``payed successfully`` before the deadline
    (exclusive) and ``payed but timeout`` after it; without an open create it is
    ``payed but not found create``. A create that is never paid, or followed by
    a create after its deadline, is a ``timeout``; an earlier second create
    renews the order. ``grace_s`` ends the wait for a late pay that long after
    the deadline, as a stream must; None waits for ever. ``slice_s`` sets how
    finely the timeline of a key is spread over tasks.
    """
    return decided_results(
        logs, within_s, grace_s, create, pay, key, kind, arrival, ts, slice_s
    ).drop("decided_us")


def decided_results(
    logs: DataFrame,
    within_s: int = 900,
    grace_s: int | None = None,
    create: str = "create",
    pay: str = "pay",
    key: str = "order_id",
    kind: str = "event_type",
    arrival: str = "arrival",
    ts: str = "ts",
    slice_s: int = 600,
) -> DataFrame:
    """``order_results`` with ``decided_us``, the last time a row could still have
    changed the result (with ``grace_s`` given)."""
    within = within_s * SECOND
    rows = logs.where(F.col(kind).isin(create, pay)).select(
        key, (F.col(kind) == create).alias("opens"), F.col(arrival).alias("_seq"), micros(ts).alias("us")
    )
    both = with_neighbours(rows, [key], ["us", "_seq"], ["opens", "us"], slice_s * SECOND)
    waited = F.col("us") - F.col("prev_us")
    kept = within + grace_s * SECOND if grace_s is not None else None
    still_open = F.coalesce(F.col("prev_opens"), F.lit(False))
    paid_later = F.col("next_us").isNotNull() & ~F.col("next_opens")
    if kept is not None:
        still_open = still_open & (waited < kept)
        paid_later = paid_later & (F.col("next_us") - F.col("us") < kept)
    renewed = F.coalesce(F.col("next_opens") & (F.col("next_us") - F.col("us") < within), F.lit(False))
    result = F.when(
        F.col("opens"), F.when(~paid_later & ~renewed, TIMED_OUT)
    ).otherwise(
        F.when(~still_open, NO_CREATE).when(waited < within, PAID).otherwise(PAID_LATE)
    )
    expires = F.col("us") + kept - 1 if kept is not None else F.lit(None).cast("bigint")
    replaced = F.when(F.col("next_opens"), F.col("next_us"))
    decided = F.when(F.col("opens"), F.least(expires, replaced)).otherwise(F.col("us"))
    return both.select(
        key, "us", result.alias("result_msg"), decided.alias("decided_us")
    ).where(F.col("result_msg").isNotNull())
