"""Window counts on streams, emitted once per window when the watermark passes
its end. The input must carry a watermark on ``ts``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(df: DataFrame, keys: list[str], size_s: int, ts: str = "ts") -> DataFrame:
    w = F.window(ts, f"{size_s} seconds").alias("w")
    return _flat(df.groupBy(w, *keys).agg(F.count(F.lit(1)).alias("cnt")), keys)


def sliding_counts(df: DataFrame, keys: list[str], size_s: int, slide_s: int, ts: str = "ts") -> DataFrame:
    """Counts panes of one slide first; only closed panes, one row per key and
    slide, are copied into the windows that contain them."""
    if size_s % slide_s or size_s == slide_s:
        w = F.window(ts, f"{size_s} seconds", f"{slide_s} seconds").alias("w")
        return _flat(df.groupBy(w, *keys).agg(F.count(F.lit(1)).alias("cnt")), keys)
    panes = df.groupBy(F.window(ts, f"{slide_s} seconds").alias("pane"), *keys).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = F.window(F.window_time("pane"), f"{size_s} seconds", f"{slide_s} seconds").alias("w")
    return _flat(panes.groupBy(w, *keys).agg(F.sum("n").alias("cnt")), keys)


def updating_counts(
    df: DataFrame, keys: list[str], size_s: int, slide_s: int, ts: str = "ts"
) -> DataFrame:
    """For update mode: a row for every window whose count changed, early results
    and corrections by late rows included."""
    w = F.window(ts, f"{size_s} seconds", f"{slide_s} seconds").alias("w")
    return _flat(df.groupBy(w, *keys).agg(F.count(F.lit(1)).alias("cnt")), keys)


def distinct_per_window(df: DataFrame, subject: str, size_s: int, ts: str = "ts") -> DataFrame:
    """Exact distinct count in two steps. State is one small row per window and
    subject, spread over all tasks, instead of one growing set per window."""
    once = df.groupBy(F.window(ts, f"{size_s} seconds").alias("first_w"), subject).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = F.window(F.window_time("first_w"), f"{size_s} seconds").alias("w")
    return _flat(once.groupBy(w).agg(F.count(F.lit(1)).alias("cnt")), [])


def approx_distinct_per_window(df: DataFrame, subject: str, size_s: int, ts: str = "ts") -> DataFrame:
    w = F.window(ts, f"{size_s} seconds").alias("w")
    return _flat(df.groupBy(w).agg(F.approx_count_distinct(subject).alias("cnt")), [])


def _flat(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.select(*keys, F.unix_millis("w.end").alias("window_end"), "cnt")
