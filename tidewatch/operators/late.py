"""Rows that arrive after all their windows have been closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.event_time import SECOND, floor_to, micros

ON_TIME, LATE = "on_time", "late"


def last_window_end(us: Column, size_s: int, slide_s: int) -> Column:
    """End of the latest sliding window that holds the time."""
    return floor_to(us, slide_s * SECOND) + size_s * SECOND


def is_late(us: Column, watermark_us: Column, size_s: int, slide_s: int, lateness_s: int) -> Column:
    """A window stays open until the watermark has reached its last millisecond
    plus the allowed lateness."""
    closes = last_window_end(us, size_s, slide_s) - 1000 + lateness_s * SECOND
    return F.coalesce(closes <= watermark_us, F.lit(False))


def tag_late(
    df: DataFrame,
    place: Column,
    arrival: list[str],
    fine: int,
    coarse: int,
    size_s: int = 600,
    slide_s: int = 10,
    delay_s: int = 1,
    lateness_s: int = 60,
    ts: str = "ts",
    seen: int | None = None,
) -> DataFrame:
    """Adds ``kind`` (``on_time`` or ``late``) against the watermark that stood
    when the row arrived: the largest event time of the rows before it, less
    ``delay_s``. ``place`` is the integer place of a row in the arrival order (a
    time or an offset), ``arrival`` the full order. ``seen`` is the largest event
    time of rows that came before all of these, if there were any.

    The running maximum over all rows is taken in three levels: inside blocks of
    ``fine`` places, over the blocks inside ``coarse`` places, and over those.
    Each level hands one number per block to the next, so only as many rows
    meet in the last task as there are coarse blocks."""
    rows = df.withColumns({"_fine": _block(place, fine), "_us": micros(ts)})
    blocks = rows.groupBy("_fine").agg(F.max("_us").alias("top")).withColumn(
        "_coarse", _block(F.col("_fine"), coarse)
    )
    spans = blocks.groupBy("_coarse").agg(F.max("top").alias("span_top")).select(
        "_coarse", F.max("span_top").over(_before("_coarse")).alias("span_seen")
    )
    carried = blocks.withColumn("block_seen", F.max("top").over(_before("_fine", "_coarse"))).join(
        spans, "_coarse"
    ).select("_fine", F.greatest("block_seen", "span_seen").alias("_carried"))
    inside = Window.partitionBy("_fine").orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1)
    top = F.greatest("_seen", "_carried", F.lit(seen).cast("bigint"))
    late = is_late(F.col("_us"), top - delay_s * SECOND, size_s, slide_s, lateness_s)
    # Running maximum first: its shuffle and order also serve the join.
    return (
        rows.withColumn("_seen", F.max("_us").over(inside))
        .join(carried, "_fine")
        .withColumn("kind", F.when(late, LATE).otherwise(ON_TIME))
        .drop("_fine", "_us", "_seen", "_carried")
    )


def _block(place: Column, width: int) -> Column:
    # Never NULL, so that joins infer no filters and both uses of the blocks share one scan.
    return F.coalesce(floor_to(place, width), F.lit(0).cast("bigint"))


def _before(order: str, *parts: str) -> WindowSpec:
    spec = Window.partitionBy(*parts) if parts else Window.partitionBy()
    return spec.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
