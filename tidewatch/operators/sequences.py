"""Event sequences of one key within a time limit.

Only rows less than the limit apart can match, so the timeline of a key is cut
into slices whose margin is the limit: one shuffle, and a hot key is spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import SECOND, micros
from .slices import with_margins

# Width of a slice in time limits. Fewer spread a hot key further, but one in
# SLICES rows is sent twice.
SLICES = 16


def repeated_failures(
    events: DataFrame,
    within_s: int = 5,
    fail: str = "fail",
    key: str = "user_id",
    kind: str = "event_type",
    arrival: str = "arrival",
    ts: str = "ts",
    slices: int = SLICES,
) -> DataFrame:
    """A failure directly followed by a failure of the same key less than
    ``within_s`` later; every row between them breaks the pair, and pairs may
    overlap. Returns ``key, first_us, last_us, msg``."""
    within = within_s * SECOND
    rows = events.select(key, (F.col(kind) == fail).alias("failed"), F.col(arrival).alias("_seq"),
                         micros(ts).alias("us"))
    sliced = with_margins(rows, within * slices, after=within)
    in_order = Window.partitionBy(key, "slice").orderBy("us", "_seq")
    following = sliced.select(
        key, "failed", "us", "home",
        F.lead("failed").over(in_order).alias("next_failed"),
        F.lead("us").over(in_order).alias("next_us"),
    )
    return following.where(
        F.col("home") & F.col("failed") & F.col("next_failed") & (F.col("next_us") - F.col("us") < within)
    ).select(key, F.col("us").alias("first_us"), F.col("next_us").alias("last_us"),
             F.lit("login fail").alias("msg"))


PAID, TIMED_OUT = "payed", "timeout"


def followed_within(
    events: DataFrame,
    within_s: int = 900,
    first: str = "create",
    then: str = "pay",
    key: str = "order_id",
    kind: str = "event_type",
    arrival: str = "arrival",
    ts: str = "ts",
    slices: int = 4,
) -> DataFrame:
    """Every ``first`` row with the next ``then`` row of its key, whatever lies
    between: ``kind`` is ``payed`` if it comes less than ``within_s`` later and
    ``timeout`` otherwise. Returns ``key, kind, first_us, then_us, result_msg``."""
    within = within_s * SECOND
    rows = events.where(F.col(kind).isin(first, then)).select(
        key, (F.col(kind) == first).alias("opens"), F.col(arrival).alias("_seq"), micros(ts).alias("us")
    )
    sliced = with_margins(rows, within * slices, after=within, guests=~F.col("opens"))
    # Read backwards: the closest later ``then`` is the last one seen so far.
    backwards = (
        Window.partitionBy(key, "slice").orderBy(F.desc("us"), F.desc("_seq"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    then_us = F.last(F.when(~F.col("opens"), F.col("us")), ignorenulls=True).over(backwards)
    opened = sliced.withColumn("then_us", then_us).where(F.col("home") & F.col("opens"))
    in_time = F.col("then_us") - F.col("us") < within
    return opened.select(
        key,
        F.when(in_time, PAID).otherwise(TIMED_OUT).alias("kind"),
        F.col("us").alias("first_us"),
        F.when(in_time, F.col("then_us")).alias("then_us"),
        F.when(in_time, F.lit("payed successfully")).otherwise(
            F.concat(F.lit("timeOut at"), F.unix_millis(F.timestamp_micros(F.col("us") + within)).cast("string"))
        ).alias("result_msg"),
    )
