"""Payments and receipts of the same transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import MINUTE, SECOND, floor_to, micros
from .slices import with_margins

MATCHED, UNMATCHED_PAY, UNMATCHED_RECEIPT = "matched", "unmatched_pay", "unmatched_receipt"


def one_line(pays: DataFrame, receipts: DataFrame, key: str, pay_id: str, receipt_id: str,
             ts: str = "ts") -> DataFrame:
    """Both inputs in one: ``key, us, is_receipt, pay_id, receipt_id``. The ids may
    be of any sortable type, structs included; each is NULL on the other side."""
    left = pays.select(key, micros(ts).alias("us"), F.lit(False).alias("is_receipt"), F.col(pay_id).alias("pay_id"))
    right = receipts.select(
        key, micros(ts).alias("us"), F.lit(True).alias("is_receipt"), F.col(receipt_id).alias("receipt_id")
    )
    return left.unionByName(right, allowMissingColumns=True)


# At equal times pays come first.
IN_ORDER = ("us", "is_receipt", "pay_id", "receipt_id")


def match_one_to_one(
    pays: DataFrame,
    receipts: DataFrame,
    pay_waits_s: int = 5,
    receipt_waits_s: int = 3,
    key: str = "tx_id",
    pay_id: str = "pay_id",
    receipt_id: str = "receipt_id",
    ts: str = "ts",
    slices: int = 16,
) -> DataFrame:
    """Each pay with at most one receipt, in event order, every input row exactly
    once: ``key, kind, pay_id, pay_us, receipt_id, receipt_us``.

    Per key one row waits for its counterpart at a time, a pay ``pay_waits_s``
    and a receipt ``receipt_waits_s`` (both inclusive); a second row of the same
    side takes the place of the waiting one, which stays unmatched. So only
    neighbours can match. Call a row a start if it cannot match its
    predecessor (same side, or too late). Counted from the latest start, rows
    0 and 1 match, rows 2 and 3, and so on.

    Cut into slices, neighbours come from the margins, and nearly all rows find
    their start in their own slice. Only where the first row of the next slice is
    no start, a slice hands on how far its last row is from one: a slice with a
    start says so by itself, one without adds its rows to what it was handed, so
    these few rows add up over any number of slices. No join of the inputs, hence
    no pairs to emit or drop. ``slices`` is the width of a slice in waiting times.
    """
    rows = one_line(pays, receipts, key, pay_id, receipt_id, ts)
    return match_line(rows, pay_waits_s, receipt_waits_s, key, slices).drop("last")


def match_line(
    rows: DataFrame, pay_waits_s: int, receipt_waits_s: int, key: str, slices: int = 16
) -> DataFrame:
    """``match_one_to_one`` on the output of ``one_line``. Adds ``last``: no row of
    the key followed in time, so an unmatched row could still find a partner."""
    waits = (pay_waits_s * SECOND, receipt_waits_s * SECOND)
    margin = max(waits)
    sliced = with_margins(rows, max(margin * slices, MINUTE), before=margin, after=margin)

    part = Window.partitionBy(key, "slice").orderBy(*IN_ORDER)
    so_far = part.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sliced.withColumns({
            **{f"prev_{c}": F.lag(c).over(part) for c in IN_ORDER},
            **{f"next_{c}": F.lead(c).over(part) for c in IN_ORDER[:2]},
            "nth": F.sum(F.col("home").cast("bigint")).over(so_far),
        })
        .withColumn("start", _cannot_match("prev_", "", waits))
        .withColumn("start_nth", F.max(F.when(F.col("home") & F.col("start"), F.col("nth"))).over(so_far))
        .where("home")
    )
    # How slices that go on into the next one end: their rows, and the number of the latest start among them.
    ends = F.struct("us", "is_receipt", "next_us", "next_is_receipt")
    ended = placed.groupBy(key, "slice").agg(
        F.max("nth").alias("rows"), F.max("start_nth").alias("last_start"), F.max_by(ends, "nth").alias("end")
    ).select(key, "slice", "rows", "last_start", "end.*").where(~_cannot_match("", "next_", waits))
    by_slice = Window.partitionBy(key).orderBy("slice")
    before = F.coalesce(F.sum("rows").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    so_many = by_slice.rowsBetween(Window.unboundedPreceding, 0)
    counted = ended.select(key, "slice", "rows", "last_start", before.alias("before"))
    handed = counted.select(
        key, (F.col("slice") + 1).alias("slice"),
        (F.col("before") + F.col("rows") - F.max(F.col("before") + F.col("last_start")).over(so_many)).alias("handed"),
    )
    # A key that is NULL is a key like any other.
    same = placed[key].eqNullSafe(handed[key]) & (placed["slice"] == handed["slice"])
    joined = placed.join(handed, same, "left").select(placed["*"], "handed")
    odd = (F.col("nth") - F.coalesce("start_nth", -F.col("handed"))) % 2 == 1
    taken = ~odd & ~_cannot_match("", "next_", waits)
    # An odd row closes a pair with the row before it; the ids it lacks are there.
    is_pay = ~F.col("is_receipt")
    other = {c: F.when(odd, F.col(f"prev_{c}")) for c in IN_ORDER}
    kind = F.when(odd, MATCHED).when(is_pay, UNMATCHED_PAY).otherwise(UNMATCHED_RECEIPT)
    return joined.where(~taken).select(
        key,
        kind.alias("kind"),
        F.coalesce("pay_id", other["pay_id"]).alias("pay_id"),
        F.when(is_pay, F.col("us")).otherwise(other["us"]).alias("pay_us"),
        F.coalesce("receipt_id", other["receipt_id"]).alias("receipt_id"),
        F.when(is_pay, other["us"]).otherwise(F.col("us")).alias("receipt_us"),
        F.col("next_us").isNull().alias("last"),
    )


def _cannot_match(earlier: str, later: str, waits: tuple[int, int]) -> Column:
    """By the columns ``us`` and ``is_receipt`` under two prefixes."""
    side, other = F.col(f"{earlier}is_receipt"), F.col(f"{later}is_receipt")
    wait = F.when(side, F.lit(waits[1])).otherwise(F.lit(waits[0]))
    cannot = (side == other) | (F.col(f"{later}us") - F.col(f"{earlier}us") > wait)
    return F.coalesce(cannot, F.lit(True))


def interval_join(
    pays: DataFrame,
    receipts: DataFrame,
    receipt_before_s: int = 3,
    receipt_after_s: int = 5,
    key: str = "tx_id",
    pay_id: str = "pay_id",
    receipt_id: str = "receipt_id",
    ts: str = "ts",
) -> DataFrame:
    """All pairs whose receipt lies between ``receipt_before_s`` before and
    ``receipt_after_s`` after the pay: ``key, pay_id, pay_us, receipt_id,
    receipt_us``. The join also runs on a time cell as wide as the interval: a
    pay goes to the at most two cells its interval touches, a receipt to its
    own, so rows of a hot key far apart in time never meet."""
    before, after = receipt_before_s * SECOND, receipt_after_s * SECOND
    cell = max(before + after, 1)
    left = pays.select(key, F.col(pay_id).alias("pay_id"), micros(ts).alias("pay_us")).withColumn(
        "cell",
        F.explode(F.sequence(
            floor_to(F.col("pay_us") - before, cell), floor_to(F.col("pay_us") + after, cell), F.lit(cell)
        )),
    )
    right = receipts.select(key, F.col(receipt_id).alias("receipt_id"), micros(ts).alias("receipt_us")).withColumn(
        "cell", floor_to(F.col("receipt_us"), cell)
    )
    gap = F.col("receipt_us") - F.col("pay_us")
    return left.join(right, [key, "cell"]).where((gap >= -before) & (gap <= after)).drop("cell")
