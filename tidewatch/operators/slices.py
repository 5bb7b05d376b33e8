"""Ordered work on keys that may be hot.

``lag`` and ``lead`` over a key need all its rows in one task. The helpers here
cut the timeline of a key into slices, so that a hot key spreads over as many
tasks as it has slices, and put the seams right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_margins(
    df: DataFrame, width: int, before: int = 0, after: int = 0, guests: Column | None = None, us: str = "us"
) -> DataFrame:
    """Adds ``slice`` and ``home``. A row belongs to the slice it lies in
    (``home``); as a guest it is also sent to the next slice when it lies within
    the last ``before`` microseconds of its own, and to the previous slice when
    it lies within the first ``after``. So each slice sees ``before`` back and
    ``after`` ahead of its own rows, for a copy of (before + after) / width of
    the rows, or of those rows only that meet ``guests``. ``width`` must be at
    least ``before`` and ``after``."""
    if width < max(before, after):
        raise ValueError("slices must be at least as wide as their margins")
    own = F.expr(f"({us} - pmod({us}, {width}L)) div {width}L")
    offset = F.pmod(F.col(us), F.lit(width))
    may = F.lit(True) if guests is None else guests
    targets = [own]
    if before:
        targets.append(F.when(may & (offset >= width - before), own + 1))
    if after:
        targets.append(F.when(may & (offset <= after), own - 1))
    copies = F.filter(F.array(*targets), lambda t: t.isNotNull())
    return (
        df.withColumn("_own", own)
        .withColumn("slice", F.explode(copies))
        .withColumn("home", F.col("slice") == F.col("_own"))
        .drop("_own")
    )


def with_neighbours(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], width: int, us: str = "us"
) -> DataFrame:
    """Adds ``prev_<column>`` and ``next_<column>`` for the neighbouring rows of the
    same key, at any distance in time. Inside a slice they are found next to
    each other; only the first and last row of each slice, at most two per
    slice, meet again in one task per key to find their neighbours there. Both
    steps read the same shuffle of the input."""
    near = Window.partitionBy(*keys, "slice").orderBy(*order)
    far = Window.partitionBy(*keys).orderBy(*order)
    sliced = df.withColumn("slice", F.expr(f"({us} - pmod({us}, {width}L)) div {width}L"))
    local = sliced.withColumns({
        **{f"prev_{c}": F.lag(c).over(near) for c in columns},
        **{f"next_{c}": F.lead(c).over(near) for c in columns},
        "_first": F.lag(us).over(near).isNull(),
        "_last": F.lead(us).over(near).isNull(),
    })
    inner = ~F.col("_first") & ~F.col("_last")
    edges = local.where(~inner).withColumns({
        **{f"prev_{c}": F.when(F.col("_first"), F.lag(c).over(far)).otherwise(F.col(f"prev_{c}")) for c in columns},
        **{f"next_{c}": F.when(F.col("_last"), F.lead(c).over(far)).otherwise(F.col(f"next_{c}")) for c in columns},
    })
    return local.where(inner).unionByName(edges).drop("slice", "_first", "_last")
