"""Counts per tumbling and sliding event-time window.

Window ends are exclusive, epoch aligned and given in milliseconds. Only
windows that hold at least one row are returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import SECOND, floor_to, micros, text_time, to_millis
from .slices import with_margins


def pane_counts(df: DataFrame, keys: list[str], width: int, ts: str) -> DataFrame:
    """``keys, _end, cnt`` per pane of ``width`` microseconds. Counted before the
    shuffle, so a hot key sends one row per pane and task."""
    pane_end = (floor_to(micros(ts), width) + F.lit(width)).alias("_end")
    return df.select(*keys, pane_end).groupBy(*keys, "_end").agg(F.count(F.lit(1)).alias("cnt"))


def tumbling_counts(df: DataFrame, keys: list[str], size_s: int, ts: str = "ts") -> DataFrame:
    """``keys, window_end, cnt``. Without keys the window itself is the key."""
    counts = pane_counts(df, keys, size_s * SECOND, ts)
    return counts.select(*keys, to_millis(F.col("_end")).alias("window_end"), "cnt")


def sliding_counts(df: DataFrame, keys: list[str], size_s: int, slide_s: int, ts: str = "ts") -> DataFrame:
    """``keys, window_end, cnt`` for windows of ``size_s`` every ``slide_s``.

    Rows are not copied into each window they fall in. They are counted once
    per pane of one slide; a pane then raises the running count at its own end
    and lowers it again one window size later. Between two such steps the count
    is constant, and only there the windows are written out. The shuffles carry
    panes, whatever the ratio of size to slide, and a task of the running sum
    holds a few window sizes of a key at a time.
    """
    if size_s == slide_s:
        return tumbling_counts(df, keys, size_s, ts)
    if size_s % slide_s:
        return _copied_counts(df, keys, size_s, slide_s, ts)
    return windows_of(pane_counts(df, keys, slide_s * SECOND, ts), keys, size_s, slide_s)


def windows_of(panes: DataFrame, keys: list[str], size_s: int, slide_s: int, slices: int = 8) -> DataFrame:
    """The windows of pane counts, one row per key and pane."""
    if size_s == slide_s:
        return panes.select(*keys, to_millis(F.col("_end")).alias("window_end"), "cnt")
    return written_out(runs_of(panes, keys, size_s, slide_s, slices), keys, slide_s)


def written_out(runs: DataFrame, keys: list[str], slide_s: int) -> DataFrame:
    """``keys, window_end, cnt`` for every window end of the runs."""
    slide = slide_s * SECOND
    ends = F.sequence(F.col("at"), F.col("until") - slide, F.lit(slide))
    return runs.select(*keys, F.explode(ends).alias("_end"), "cnt").select(
        *keys, to_millis(F.col("_end")).alias("window_end"), "cnt"
    )


def runs_of(panes: DataFrame, keys: list[str], size_s: int, slide_s: int, slices: int = 8) -> DataFrame:
    """``keys, at, until, cnt``: stretches of window ends of equal count, from ``at`` on and before ``until``, none empty.

    The running sum is cut into slices of ``slices`` window sizes, in which the panes of the last
    window before count as guests: so few keys, or none, still make as many
    tasks as there are slices, for a copy of 1 / ``slices`` of the panes."""
    size = size_s * SECOND
    width = size * slices
    # Where the running sum needs them, while there is one row per pane and not two.
    sliced = with_margins(panes, width, before=size, us="_end").repartition(*keys, "slice")
    start = F.col("slice") * width
    up, down = F.greatest("_end", start), F.least(F.col("_end") + size, start + width)
    steps = sliced.where(up < down).select(
        *keys,
        "slice",
        F.explode(F.array(
            F.struct(up.alias("at"), F.col("cnt").alias("step")),
            F.struct(down.alias("at"), (-F.col("cnt")).alias("step")),
        )).alias("s"),
    ).select(*keys, "slice", "s.at", "s.step")
    by_time = Window.partitionBy(*keys, "slice").orderBy("at")
    runs = steps.select(
        *keys,
        "at",
        F.sum("step").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("cnt"),
        F.lead("at").over(by_time).alias("until"),
    )
    # Of steps at the same time only the last one has the full sum and a later successor.
    return runs.where((F.col("cnt") > 0) & (F.col("until") > F.col("at")))


def _copied_counts(df: DataFrame, keys: list[str], size_s: int, slide_s: int, ts: str) -> DataFrame:
    # Panes do not tile the window when the slide does not divide the size.
    w = F.window(ts, f"{size_s} seconds", f"{slide_s} seconds")
    return df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("cnt")).select(
        *keys, F.unix_millis("w.end").alias("window_end"), "cnt"
    )


def distinct_per_window(
    df: DataFrame, subject: str, size_s: int, ts: str = "ts", approximate: bool = False
) -> DataFrame:
    """Distinct ``subject`` values per tumbling window: ``window_end, cnt``. The
    exact count shuffles by (window, subject) first, so no task holds the whole
    set of a window; the approximate one keeps a fixed-size sketch instead."""
    end = to_millis(floor_to(micros(ts), size_s * SECOND) + size_s * SECOND).alias("window_end")
    rows = df.select(end, subject)
    count = F.approx_count_distinct(subject) if approximate else F.count_distinct(subject)
    return rows.groupBy("window_end").agg(count.alias("cnt"))


def distinct_per_sliding_window(
    df: DataFrame, subject: str, size_s: int, slide_s: int, ts: str = "ts", approximate: bool = False, log2_size: int = 12
) -> DataFrame:
    """Distinct ``subject`` values per sliding window: ``window_end, cnt``.

    Exact: a subject's panes become runs of windows that hold it, each window counts its runs, and no task holds the
    subjects of a window. Approximate: a sketch of 2**``log2_size`` registers for each pane, whatever the number of
    subjects; windows unite the sketches of their panes, so windows of any length cost one sketch a pane. The standard
    error is about 1.04 / 2**(``log2_size`` / 2).
    """
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    slide = slide_s * SECOND
    if not approximate:
        held = runs_of(pane_counts(df.where(F.col(subject).isNotNull()), [subject], slide, ts), [subject], size_s, slide_s)
        return written_out(held, [], slide_s).groupBy("window_end").agg(F.count(F.lit(1)).alias("cnt"))
    panes = df.where(F.col(subject).isNotNull()).groupBy((floor_to(micros(ts), slide) + slide).alias("_end"))
    sketches = panes.agg(F.hll_sketch_agg(subject, log2_size).alias("sketch"))
    ends = F.explode(F.sequence(F.col("_end"), F.col("_end") + size_s * SECOND - slide, F.lit(slide)))
    windows = sketches.select(ends.alias("_end"), "sketch").groupBy("_end").agg(F.hll_union_agg("sketch").alias("sketch"))
    return windows.select(to_millis(F.col("_end")).alias("window_end"), F.hll_sketch_estimate("sketch").alias("cnt"))


def with_window_texts(counts: DataFrame, size_s: int) -> DataFrame:
    """Replaces ``window_end`` by the texts ``window_start`` and ``window_end``."""
    end = F.col("window_end") * 1000
    others = [c for c in counts.columns if c != "window_end"]
    return counts.select(
        text_time(end - size_s * SECOND).alias("window_start"), text_time(end).alias("window_end"), *others
    )
