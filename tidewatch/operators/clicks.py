"""Cap on the clicks of one user on one ad, with a warning when it is reached."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import DAY, floor_to, micros

PASS, WARNING = "pass", "warning"


def cap_clicks(
    clicks: DataFrame,
    limit: int = 100,
    strict: bool = False,
    keys: tuple[str, ...] = ("user_id", "ad_id"),
    arrival: tuple[str, ...] = ("arrival",),
    ts: str = "ts",
    clock: str | None = None,
) -> DataFrame:
    """Adds ``kind``: the first ``limit`` clicks per key and UTC day ``pass``, the
    next one becomes the ``warning``, all later ones are dropped. ``strict``
    warns only once the count is above the limit, so one more click passes.
    The day is that of the event time, or of the ``clock``, a column of
    microseconds, where one is given.

    The rank filter becomes a group limit in front of the shuffle: a task sends
    at most ``limit + 2`` rows per key and day, however hot the key is (Spark
    does so for limits below spark.sql.optimizer.windowGroupLimitThreshold).
    """
    allowed = limit + 1 if strict else limit
    day = floor_to(F.col(clock) if clock else micros(ts), DAY)
    by_arrival = Window.partitionBy(*keys, "_day").orderBy(*arrival)
    return (
        clicks.withColumn("_day", day)
        .withColumn("_nth", F.row_number().over(by_arrival))
        .where(F.col("_nth") <= allowed + 1)
        .withColumn("kind", F.when(F.col("_nth") <= allowed, PASS).otherwise(WARNING))
        .drop("_day", "_nth")
    )


def passed(capped: DataFrame) -> DataFrame:
    return capped.where(F.col("kind") == PASS).drop("kind")


def warnings(capped: DataFrame, limit: int = 100) -> DataFrame:
    """``user_id, ad_id, msg``"""
    return capped.where(F.col("kind") == WARNING).select(
        "user_id", "ad_id", F.lit(f"Click over{limit}times").alias("msg")
    )
