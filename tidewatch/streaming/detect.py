"""The join of two streams within an interval of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import SECOND, floor_to, micros


def interval_join(
    pays: DataFrame, receipts: DataFrame, receipt_before_s: int = 3, receipt_after_s: int = 5,
    key: str = "tx_id", pay_id: str = "pay_id", receipt_id: str = "receipt_id",
) -> DataFrame:
    """All pairs within the interval; both inputs watermarked, so that Spark
    drops rows from the join state once no partner can come."""
    before, after = receipt_before_s * SECOND, receipt_after_s * SECOND
    cell = max(before + after, 1)
    # As in batch: rows of a hot key meet only within the cells of the interval.
    left = pays.select(
        F.col(key).alias("pay_key"), F.col(pay_id).alias("pay_id"), F.col("ts").alias("pay_ts"),
        F.explode(F.sequence(
            floor_to(micros() - before, cell), floor_to(micros() + after, cell), F.lit(cell)
        )).alias("pay_cell"),
    )
    right = receipts.select(
        key, F.col(receipt_id).alias("receipt_id"), F.col("ts").alias("receipt_ts"),
        floor_to(micros(), cell).alias("cell"),
    )
    near = (
        (F.col("receipt_ts") >= F.col("pay_ts") - F.expr(f"INTERVAL {receipt_before_s} SECONDS"))
        & (F.col("receipt_ts") <= F.col("pay_ts") + F.expr(f"INTERVAL {receipt_after_s} SECONDS"))
    )
    same = (F.col("pay_key") == F.col(key)) & (F.col("pay_cell") == F.col("cell"))
    return left.join(right, same & near).select(
        key, "pay_id", micros("pay_ts").alias("pay_us"), "receipt_id", micros("receipt_ts").alias("receipt_us")
    )
