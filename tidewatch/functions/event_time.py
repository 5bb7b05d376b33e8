"""Event-time columns. Windows work on epoch microseconds (bigint): cheap to
hash, to shuffle and to do arithmetic on, and independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds the event time from ``epoch_s`` or ``epoch_ms``, whichever the layout has."""
    if "epoch_s" in df.columns:
        return df.withColumn(ts, F.timestamp_seconds("epoch_s"))
    return df.withColumn(ts, F.timestamp_millis("epoch_ms"))


def watermarked(df: DataFrame, delay_s: int = 0, ts: str = "ts") -> DataFrame:
    """Bounded disorder of ``delay_s`` seconds; 0 stands for ascending times."""
    return df.withWatermark(ts, f"{delay_s} seconds")


def micros(ts: str | Column = "ts") -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def floor_to(us: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``us``; also right before 1970."""
    return us - F.pmod(us, F.lit(width))


def to_millis(us: Column) -> Column:
    """Whole milliseconds, rounded down; no detour over doubles."""
    return F.unix_millis(F.timestamp_micros(us))


def text_time(us: Column) -> Column:
    """``2017-11-26 09:05:00.0``: seconds with one fractional digit."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.S")


def where_watermarked(df: DataFrame, condition: Column, ts: str = "ts") -> DataFrame:
    """A filter behind the watermark. A plain ``where`` would be pushed in front
    of it, and then rows of no interest could not move the time forward."""
    return df.where(F.when(F.col(ts).isNotNull(), condition))
