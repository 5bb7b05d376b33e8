"""The first few rows of every window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import SECOND, floor_to, micros, to_millis
from .windows import pane_counts, runs_of, sliding_counts, windows_of, written_out


def top_per_window(counts: DataFrame, subject: str, k: int) -> DataFrame:
    """``window_end, rank, subject, cnt`` for the ``k`` largest counts; ties go to
    the smaller subject. Spark turns ``rank <= k`` into a group limit in front
    of the shuffle, so each task sends at most ``k`` rows per window."""
    best = Window.partitionBy("window_end").orderBy(F.desc("cnt"), F.asc(subject))
    return (
        counts.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("window_end", "rank", subject, "cnt")
    )


def top_sliding(df: DataFrame, subject: str, k: int, size_s: int, slide_s: int, ts: str = "ts") -> DataFrame:
    """``top_per_window`` of the sliding counts of ``df``."""
    if size_s == slide_s or size_s % slide_s:
        return top_per_window(sliding_counts(df, [subject], size_s, slide_s, ts), subject, k)
    return top_of_panes(pane_counts(df, [subject], slide_s * SECOND, ts), subject, k, size_s, slide_s)


def top_of_panes(panes: DataFrame, subject: str, k: int, size_s: int, slide_s: int, cells: int = 6) -> DataFrame:
    """The same from pane counts, writing out few windows that are not among the first ``k``.

    Runs of equal counts are cut at the borders of cells, ``cells`` to a window size. The k-th best run among those that
    last a whole cell bounds it: what ranks behind that run is behind k others in every window of the cell and is
    dropped before it is written out. Cells with fewer whole runs drop nothing."""
    cell = -(-size_s // (cells * slide_s)) * slide_s * SECOND
    runs = runs_of(panes, [subject], size_s, slide_s)
    over = F.sequence(floor_to(F.col("at"), cell), floor_to(F.col("until") - 1, cell), F.lit(cell))
    parts = runs.select(subject, "cnt", "at", "until", F.explode(over).alias("cell")).select(
        subject, "cnt", "cell", F.greatest("at", "cell").alias("at"), F.least("until", F.col("cell") + cell).alias("until"))
    whole = parts.where((F.col("at") == F.col("cell")) & (F.col("until") == F.col("cell") + cell))
    best = Window.partitionBy("cell").orderBy(F.desc("cnt"), F.asc(subject))
    bounds = whole.select("cell", "cnt", subject).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    bounds = bounds.where(F.col("rank") == k).select(F.col("cell").alias("_cell"), F.col("cnt").alias("_cnt"), F.col(subject).alias("_last"))
    behind = (F.col("cnt") < F.col("_cnt")) | ((F.col("cnt") == F.col("_cnt")) & (F.col(subject) > F.col("_last")))
    kept = parts.join(bounds, parts["cell"] == bounds["_cell"], "left").where(~F.coalesce(behind, F.lit(False)))
    return top_per_window(written_out(kept.select(subject, "at", "until", "cnt"), [subject], slide_s), subject, k)


def top_by_sketches(
    df: DataFrame, subject: str, k: int, size_s: int, slide_s: int, folder: str, ts: str = "ts", tracked: int = 500,
    candidates: int | None = None,
) -> DataFrame:
    """The same for subjects without bound: what is kept for a window does not grow with their number.

    A pane has one sketch of its frequent subjects, of fixed size; windows unite the sketches of their panes and name
    ``candidates`` subjects (ten times ``k``). A second pass counts the rows of these alone. A subject that was not named
    has no more rows than ``_most_missed`` says; only windows whose k-th count does not exceed that are counted in full, so
    the result is exact whatever the data. Rows without a subject count nowhere; ties go to the smaller subject. The
    candidates and their ranks, a few rows a window, are written below ``folder``, which all executors must share: later
    steps read them there and do not sketch or count again.
    """
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    if not 0 < tracked <= 768:
        raise ValueError("sketches track 1 to 768 subjects; with more the bound of their error is no longer certain")
    size, slide, named = size_s * SECOND, slide_s * SECOND, candidates or 10 * k
    if not k <= named <= tracked:
        raise ValueError("there must be k candidates or more, and no more than a sketch tracks")
    rows = df.where(F.col(subject).isNotNull()).select(F.col(subject).alias("_subject"), (floor_to(micros(ts), slide) + slide).alias("_end"))
    sketches = rows.groupBy("_end").agg(F.expr(f"approx_top_k_accumulate(_subject, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    ends = F.explode(F.sequence(F.col("_end"), F.col("_end") + (size - slide), F.lit(slide)))
    united = sketches.select(ends.alias("window"), "sketch", "n").groupBy("window").agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    found = _written(united.select("window", "n", F.expr(f"approx_top_k_estimate(sketch, {named})").alias("found")), f"{folder}/candidates")

    named_ones = found.select("window", F.explode("found.item").alias("_named"))
    panes_of = F.explode(F.sequence(F.col("window") - (size - slide), F.col("window"), F.lit(slide))).alias("_pane")
    asked = named_ones.select(panes_of, "_named").distinct()
    counts = _windows_of_rows(rows.join(asked, (rows["_end"] == asked["_pane"]) & (rows["_subject"] == asked["_named"]), "left_semi"), size_s, slide_s)
    of_window = named_ones.select(to_millis(F.col("window")).alias("_window"), "_named")
    # A subject may be named for some of the windows of its panes only; in the others its count is not whole.
    whole = counts.join(of_window, (counts["window_end"] == of_window["_window"]) & (counts["_subject"] == of_window["_named"]), "left_semi")
    best = _written(top_per_window(whole, "_subject", k), f"{folder}/ranks")

    last = best.where(F.col("rank") == k).select(F.col("window_end").alias("_window"), F.col("cnt").alias("_last"))
    bounds = found.select("window", to_millis(F.col("window")).alias("window_end"), _most_missed(tracked, named).alias("missed"))
    sure = (F.col("missed") < 1) | (F.coalesce("_last", F.lit(0)) > F.col("missed"))
    unsure = bounds.join(last, bounds["window_end"] == last["_window"], "left").where(~sure).select("window", "window_end")
    in_full = rows.join(unsure.select(panes_of).distinct(), F.col("_end") == F.col("_pane"), "left_semi")
    others = top_per_window(_windows_of_rows(in_full, size_s, slide_s).join(unsure, "window_end", "left_semi"), "_subject", k)
    return best.join(unsure, "window_end", "left_anti").unionByName(others).withColumnRenamed("_subject", subject)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _most_missed(tracked: int, named: int) -> Column:
    """An upper bound of the rows in ``n`` of a subject that is not in ``found``.

    A map of M counters is off by at most 3.5 n / M. Subjects are named by their least possible count, if that is above the
    error; so one that has more than twice the error is named, or lies behind the last one where not all were."""
    counters = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    behind = F.when(F.size("found") >= named, F.element_at("found", -1)["count"]).otherwise(0)
    return F.greatest(F.col("n") * (2 * 3.5 / counters), behind.cast("double"))


def _windows_of_rows(rows: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    panes = rows.groupBy("_subject", "_end").agg(F.count(F.lit(1)).alias("cnt"))
    return windows_of(panes, ["_subject"], size_s, slide_s)
