"""Batch operators on streams, in event order.

Each micro-batch runs a batch operator on the rows that have become final
together with the rows earlier batches left open, so a stream gets the plans of
the batch form: all in the JVM, hot keys spread, no call per key. Results and
open rows are tables next to each other below one shared path; a repeated batch
rewrites its own part of both, so a failure loses and doubles nothing.

Time has come as far as the newest row, of the slowest input if there are
several, less the allowed disorder. Rows behind it are late. Operators with a
``lateness`` take such rows in and correct what they have said: their table is a
log of rows that begin (``sign`` 1) or cease to hold (``sign`` -1), which
``read`` adds up. What is later than that is written to a table of its own, which
``late`` reads. ``finish`` closes a bounded input. ``parts`` keeps the tables to
few files, however many batches there are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.event_time import DAY, SECOND, floor_to, micros
from ..operators.clicks import PASS, WARNING
from ..operators import late as late_rows
from ..operators.orders import decided_results
from ..operators.reconcile import MATCHED, UNMATCHED_RECEIPT, interval_join, match_line, one_line
from ..operators.sequences import followed_within, repeated_failures
from ..operators.windows import pane_counts, windows_of
from . import parts

NEVER, FOREVER = -(2**62), 2**62


@dataclass(frozen=True)
class Incremental:
    """``start`` the writer with a trigger of your choice; ``read`` what it has written."""

    writer: DataStreamWriter
    path: str
    schema: StructType
    line: StructType
    close: Callable[[], None] | None = None
    corrected: bool = False

    def finish(self) -> None:
        """Decides what is still open, once a bounded input has been worked through.
        The stream may go on later: its next batch replaces what was decided here."""
        if self.close:
            self.close()

    def late(self, spark: SparkSession) -> DataFrame:
        """The rows that came when their time was over, or that have no time."""
        return parts.read(spark, f"{self.path}/late", self.line).drop("batch", "us", "_day")

    def changes(self, spark: SparkSession) -> DataFrame:
        """What was said in each batch, with ``sign`` -1 for rows that were taken back."""
        return parts.read(spark, f"{self.path}/rows", self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        results = parts.read(spark, f"{self.path}/rows", self.schema)
        if self.corrected:
            told = [c for c in self.schema.names if c != "sign"]
            held = results.groupBy(*told).agg(F.sum("sign").alias("sign")).where("sign > 0")
            return held.withColumn("sign", F.explode(F.sequence(F.lit(1), "sign"))).drop("sign")
        results = results.drop("batch", "_day", "_seen")
        return results.where(~F.col("held")).drop("held") if "held" in results.columns else results


def _differences(old: DataFrame, now: DataFrame) -> DataFrame:
    """Rows that hold now and did not before with ``sign`` 1, the others the other way; repeated rows count."""
    both = now.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
    return both.groupBy(*now.columns).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")


def in_event_order(
    line: DataFrame,
    path: str,
    delay_s: int,
    results: Callable[[DataFrame, int, int], DataFrame],
    carry: Callable[[DataFrame, DataFrame, int], DataFrame],
    side: str | None = None,
    idle_s: int | None = None,
    take_late: bool = False,
) -> Incremental:
    """``results(rows, before, reached)`` gets the rows up to the time ``reached``
    and returns what was decided after ``before``. ``carry(results, rows,
    reached)`` picks the rows the next batch needs again. ``side`` is a boolean
    column telling two inputs apart; an input is waited for until the other one is
    ``idle_s`` ahead, for ever if that is None. With ``take_late`` late rows meet
    what is still open; else they are only kept aside."""
    spark = line.sparkSession
    schema = results(spark.createDataFrame([], line.schema), NEVER, NEVER).schema

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        before, reached, behind = _advance(batch, path, number, delay_s, side, idle_s)
        least = F.lit(NEVER if take_late else before)
        if behind:
            _write(batch.where(~(F.coalesce("us", F.lit(NEVER)) > least)), _part(path, "late", number))
        rows = batch.where(F.col("us") > least)
        if number > 0:
            rows = rows.unionByName(spark.read.schema(line.schema).parquet(_part(path, "open", number - 1)))
        _write(results(rows.where(F.col("us") <= reached), before, reached), _part(path, "rows", number))
        written = spark.read.schema(schema).parquet(_part(path, "rows", number))
        _write(carry(written, rows, reached), _part(path, "open", number))
        batch.unpersist()
        _settle(spark, path, number, schema, line.schema)

    def close() -> None:
        number, reached = _last(spark, path, delay_s, idle_s)
        if number is not None:
            rows = spark.read.schema(line.schema).parquet(_part(path, "open", number))
            _write(results(rows, reached, FOREVER), _part(path, "rows", number + 1))

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema, close)


def corrected_by_late_rows(
    line: DataFrame, path: str, delay_s: int, lateness_s: int, horizon: int, operator: Callable[[DataFrame], DataFrame],
    decided: Column, *drop: str,
) -> Incremental:
    """For operators whose result at a time ``us`` depends on rows less than ``horizon`` from it and stands from the time
    it is ``decided``, less than ``horizon`` later. Rows up to ``lateness_s`` late are put where they belong, and what was
    said there before is taken back where it no longer holds. Carries the rows and the results that a row as late as
    that can still change."""
    spark, lateness = line.sparkSession, lateness_s * SECOND
    plain = operator(spark.createDataFrame([], line.schema)).drop(*drop).schema
    schema = StructType([*plain.fields, StructField("sign", IntegerType())])

    def told(rows: DataFrame, before: int, reached: int) -> DataFrame:
        still = F.col("us") > before - lateness - horizon
        return operator(rows.where(F.col("us") <= reached)).where(still & (decided <= reached)).drop(*drop)

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        before, reached, behind = _advance(batch, path, number, delay_s)
        in_time = F.coalesce("us", F.lit(NEVER)) > F.lit(before - lateness)
        if behind:
            _write(batch.where(~in_time), _part(path, "late", number))
        rows, old = batch.where(in_time), spark.createDataFrame([], plain)
        if number > 0:
            rows = rows.unionByName(spark.read.schema(line.schema).parquet(_part(path, "open", number - 1)))
            old = spark.read.schema(plain).parquet(_part(path, "told", number - 1))
        _write(told(rows, before, reached), _part(path, "told", number))
        now = spark.read.schema(plain).parquet(_part(path, "told", number))
        _write(_differences(old.where(F.col("us") > before - lateness - horizon), now), _part(path, "rows", number))
        _write(rows.where(F.col("us") > reached - lateness - 2 * horizon), _part(path, "open", number))
        batch.unpersist()
        _settle(spark, path, number, schema, line.schema)

    def close() -> None:
        number, reached = _last(spark, path, delay_s)
        if number is not None:
            rows = spark.read.schema(line.schema).parquet(_part(path, "open", number))
            old = spark.read.schema(plain).parquet(_part(path, "told", number))
            old = old.where(F.col("us") > reached - lateness - horizon)
            _write(_differences(old, told(rows, reached, FOREVER)), _part(path, "rows", number + 1))

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema, close, corrected=True)


def _last(spark: SparkSession, path: str, delay_s: int, idle_s: int | None = None) -> tuple[int | None, int]:
    """The number of the last batch, None before the first, and the time it reached."""
    files, root = parts.file_system(spark, f"{path}/tops")
    if not files.exists(root):
        return None, NEVER
    names = [status.getPath().getName() for status in files.listStatus(root)]
    numbers = [int(name.removeprefix("batch=")) for name in names if name.removeprefix("batch=").isdigit()]
    return (max(numbers), _reached(_tops(spark, path, max(numbers)), delay_s, idle_s)) if numbers else (None, NEVER)


def _tops(spark: SparkSession, path: str, number: int) -> list[int]:
    return parts.read_json(spark, _part(path, "tops", number))


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Drops what only batch ``number + 1``, long committed, has needed."""
    for name in ("open", "tops", "told"):
        files, old = parts.file_system(spark, _part(path, name, number))
        files.delete(old, True)


def _settle(spark: SparkSession, path: str, number: int, rows: StructType, late: StructType | None = None) -> None:
    """Ends batch ``number``: drops what no batch needs again, and puts parts of the tables together. Batches before this
    one are committed; this one may run again."""
    _forget(spark, path, number - 2)
    if number % parts.FAN == 0:
        parts.compact(spark, f"{path}/rows", rows, number)
        if late:
            parts.compact(spark, f"{path}/late", late, number)


def _part(path: str, name: str, number: int) -> str:
    return f"{path}/{name}/batch={number}"


def _advance(
    batch: DataFrame, path: str, number: int, delay_s: int, side: str | None = None, idle_s: int | None = None
) -> tuple[int, int, bool]:
    """The times reached before and with this batch, and whether it may hold rows to be
    kept aside: rows behind the former or without a time. The first one counts as such,
    so there is a table of them. Keeps the newest row of each side, two numbers at most,
    in a small file for the next batch."""
    spark = batch.sparkSession
    sides = (False, True) if side else (False,)
    old = _tops(spark, path, number - 1) if number > 0 else [NEVER] * len(sides)
    which = F.col(side) if side else F.lit(False)
    newest = batch.groupBy(which.alias("side")).agg(F.max("us").alias("top"), F.min(F.coalesce("us", F.lit(NEVER))).alias("low")).collect()
    now = {r["side"]: r["top"] for r in newest if r["top"] is not None}
    tops = [max(top, now.get(s, NEVER)) for s, top in zip(sides, old)]
    parts.write_json(spark, _part(path, "tops", number), tops)
    before = _reached(old, delay_s, idle_s)
    return before, _reached(tops, delay_s, idle_s), number == 0 or any(r["low"] <= before for r in newest)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _reached(tops: list[int], delay_s: int, idle_s: int | None = None) -> int:
    slowest = min(tops) if idle_s is None else max(min(tops), max(tops) - idle_s * SECOND)
    # Whole milliseconds, as the watermarks of Spark.
    return slowest // 1000 * 1000 - delay_s * SECOND


def _within_horizon(
    line: DataFrame, path: str, delay_s: int, horizon: int, operator: Callable[[DataFrame], DataFrame],
    decided: Column, *drop: str,
) -> Incremental:
    """For operators whose results depend on rows less than ``horizon`` before the
    time they are ``decided``: the last rows that long are carried along."""
    return in_event_order(
        line, path, delay_s,
        lambda rows, before, reached: operator(rows).where((decided > before) & (decided <= reached)).drop(*drop),
        lambda results, rows, reached: rows.where(F.col("us") > reached - horizon),
    )


def failures(
    events: DataFrame, path: str, within_s: int = 5, delay_s: int = 6, fail: str = "fail",
    key: str = "user_id", kind: str = "event_type", arrival: str = "arrival",
) -> Incremental:
    line = events.select(key, kind, arrival, "ts", micros().alias("us"))
    names = {"fail": fail, "key": key, "kind": kind, "arrival": arrival}
    return _within_horizon(
        line, path, delay_s, within_s * SECOND,
        lambda rows: repeated_failures(rows, within_s, **names), F.col("last_us"),
    )


def sequences(
    events: DataFrame, path: str, within_s: int = 900, delay_s: int = 0, first: str = "create", then: str = "pay",
    key: str = "order_id", kind: str = "event_type", arrival: str = "arrival",
) -> Incremental:
    line = events.select(key, kind, arrival, "ts", micros().alias("us"))
    names = {"first": first, "then": then, "key": key, "kind": kind, "arrival": arrival}
    within = within_s * SECOND
    return _within_horizon(
        line, path, delay_s, within, lambda rows: followed_within(rows, within_s, **names),
        F.coalesce("then_us", F.col("first_us") + within - 1),
    )


def order_states(
    logs: DataFrame, path: str, within_s: int = 900, grace_s: int = 0, delay_s: int = 0, create: str = "create",
    pay: str = "pay", key: str = "order_id", kind: str = "event_type", arrival: str = "arrival",
    lateness_s: int | None = None,
) -> Incremental:
    """Creates and pays up to ``lateness_s`` late, by default as long as an order can stay open, still decide: a state
    that was told too early is taken back."""
    line = logs.select(key, kind, arrival, "ts", micros().alias("us"))
    names = {"create": create, "pay": pay, "key": key, "kind": kind, "arrival": arrival}
    lateness_s = within_s + grace_s if lateness_s is None else lateness_s
    return corrected_by_late_rows(
        line, path, delay_s, lateness_s, (within_s + grace_s) * SECOND,
        lambda rows: decided_results(rows, within_s, grace_s, **names), F.col("decided_us"), "decided_us",
    )


def matches(
    pays: DataFrame, receipts: DataFrame, path: str, pay_waits_s: int = 5, receipt_waits_s: int = 3,
    delay_s: int = 0, key: str = "tx_id", pay_id: str = "pay_id", receipt_id: str = "receipt_id",
    idle_s: int | None = None,
) -> Incremental:
    """Who matches whom can depend on a chain of rows of any length, so not a
    stretch of time is carried along but the rows that still wait. A late row
    meets those, in event order; if none is its partner, it is told as unmatched
    once its own wait is over."""
    line = one_line(pays, receipts, key, pay_id, receipt_id)

    def results(rows: DataFrame, before: int, reached: int) -> DataFrame:
        final = match_line(rows, pay_waits_s, receipt_waits_s, key)
        deadline = F.coalesce(
            F.col("pay_us") + pay_waits_s * SECOND, F.col("receipt_us") + receipt_waits_s * SECOND
        )
        held = (F.col("kind") != MATCHED) & F.col("last") & (deadline > reached)
        return final.withColumn("held", held).drop("last")

    def carry(written: DataFrame, rows: DataFrame, reached: int) -> DataFrame:
        waiting = written.where("held").select(
            key, F.coalesce("pay_us", "receipt_us").alias("us"),
            (F.col("kind") == UNMATCHED_RECEIPT).alias("is_receipt"), "pay_id", "receipt_id",
        )
        return waiting.unionByName(rows.where(F.col("us") > reached))

    return in_event_order(line, path, delay_s, results, carry, "is_receipt", idle_s, take_late=True)


def pairs(
    pays: DataFrame, receipts: DataFrame, path: str, receipt_before_s: int = 3, receipt_after_s: int = 5,
    delay_s: int = 0, key: str = "tx_id", pay_id: str = "pay_id", receipt_id: str = "receipt_id",
    idle_s: int | None = None, counted: Column | None = None,
) -> Incremental:
    """All pairs within the interval, in the batch in which the later row of a pair comes. Carries the rows that can
    still get a partner. Pays that are not ``counted`` move the time only."""
    if counted is not None:
        pays = pays.withColumn(key, F.when(counted, F.col(key)))
    line = one_line(pays, receipts, key, pay_id, receipt_id)
    spark = line.sparkSession
    before_us, after_us = receipt_before_s * SECOND, receipt_after_s * SECOND

    def met(pay_rows: DataFrame, receipt_rows: DataFrame) -> DataFrame:
        rows = [df.withColumn("ts", F.timestamp_micros("us")) for df in (pay_rows.where("NOT is_receipt"), receipt_rows.where("is_receipt"))]
        return interval_join(*rows, receipt_before_s, receipt_after_s, key, "pay_id", "receipt_id")

    nothing = spark.createDataFrame([], line.schema)
    schema = met(nothing, nothing).schema

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        before, reached, behind = _advance(batch, path, number, delay_s, "is_receipt", idle_s)
        if behind:
            _write(batch.where(~(F.coalesce("us", F.lit(NEVER)) > before)), _part(path, "late", number))
        # Without a key a row meets none.
        fresh = batch.where((F.col("us") > before) & F.col(key).isNotNull())
        rows = fresh
        found = met(fresh, fresh)
        if number > 0:
            waiting = spark.read.schema(line.schema).parquet(_part(path, "open", number - 1))
            rows = fresh.unionByName(waiting)
            found = found.unionByName(met(fresh, waiting)).unionByName(met(waiting, fresh))
        _write(found, _part(path, "rows", number))
        wait = F.when(F.col("is_receipt"), F.lit(before_us)).otherwise(F.lit(after_us))
        _write(rows.where(F.col("us") + wait > reached), _part(path, "open", number))
        batch.unpersist()
        _settle(spark, path, number, schema, line.schema)

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema)


def click_cap(
    clicks: DataFrame, path: str, limit: int = 100, strict: bool = False, delay_s: int = 0,
    keys: tuple[str, ...] = ("user_id", "ad_id"), arrival: str = "arrival", clock: str | None = None,
    then: Callable[[DataFrame, int, int, int], None] | None = None,
) -> Incremental:
    """The click cap by arrival, batch after batch. Carries one small row per key
    and open UTC day: how many of its clicks have been let through or warned
    about, at most ``limit + 2``. Clicks of days that are over are late. Days are
    those of the event time, or of ``clock``, a column of microseconds that tells
    when a click came in: then its micro-batches close the days.
    ``then`` goes on with the clicks of a batch, its number and its times."""
    allowed = limit + 1 if strict else limit
    us = F.col(clock) if clock else micros()
    line = clicks.withColumns({"us": us, "_day": floor_to(us, DAY)})
    kept = [field for field in clicks.schema if field.name != "kind"]
    counted = StructType([clicks.schema[k] for k in keys] + StructType.fromDDL("_day bigint, _seen bigint").fields)
    schema = StructType(kept + StructType.fromDDL("kind string, _day bigint, _seen bigint").fields)
    spark = line.sparkSession
    by_arrival = Window.partitionBy(*keys, "_day").orderBy(arrival)

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        before, reached, behind = _advance(batch, path, number, delay_s)
        if behind:
            _write(batch.where(~(F.coalesce("_day", F.lit(NEVER)) + DAY > before)), _part(path, "late", number))
        first = (
            batch.where(F.col("_day") + DAY > before)
            .withColumn("nth", F.row_number().over(by_arrival)).where(F.col("nth") <= allowed + 1)
        )
        counts = spark.createDataFrame([], counted)
        if number > 0:
            counts = spark.read.schema(counted).parquet(_part(path, "open", number - 1))
        total = F.coalesce("_seen", F.lit(0)) + F.col("nth")
        # A key that is NULL is a key like any other.
        same_day = functools.reduce(and_, [first[k].eqNullSafe(counts[k]) for k in (*keys, "_day")])
        told = (
            first.join(counts, same_day, "left").select(first["*"], "_seen").withColumn("_seen", total)
            .where(F.col("_seen") <= allowed + 1)
            .withColumn("kind", F.when(F.col("_seen") <= allowed, PASS).otherwise(WARNING))
        )
        _write(told.select(*schema.names), _part(path, "rows", number))
        written = spark.read.schema(schema).parquet(_part(path, "rows", number))
        open_days = written.select(*counted.names).unionByName(counts).where(F.col("_day") + DAY > reached)
        _write(open_days.groupBy(*keys, "_day").agg(F.max("_seen").alias("_seen")), _part(path, "open", number))
        if then:
            then(written, number, before, reached)
        batch.unpersist()
        _settle(spark, path, number, schema, line.schema)

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema)


def window_counts(
    events: DataFrame, path: str, keys: list[str], size_s: int, slide_s: int, delay_s: int = 0, lateness_s: int = 0,
    counted: Column | None = None, change: Callable[[DataFrame], DataFrame] = lambda counts: counts,
) -> Incremental:
    """Sliding counts ``keys, window_end, cnt``, each window once it is over, corrected
    by rows up to ``lateness_s`` late: only what they change is told again, the old
    row with ``sign`` -1 and the new one with 1. ``change`` goes on with the counts
    of the windows of a batch, all there, so it may rank them. Rows that are not
    ``counted`` move the time only. Carries the pane counts of the windows that can
    still change and what was told of them."""
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    spark = events.sparkSession
    size, slide, lateness = size_s * SECOND, slide_s * SECOND, lateness_s * SECOND
    line = events.withColumn("us", micros())
    panes_schema = StructType([events.schema[k] for k in keys] + StructType.fromDDL("_end bigint, cnt bigint").fields)
    end = F.col("window_end") * 1000

    def counts(panes: DataFrame) -> DataFrame:
        return windows_of(panes, keys, size_s, slide_s)

    plain = change(counts(spark.createDataFrame([], panes_schema))).schema
    schema = StructType([*plain.fields, StructField("sign", IntegerType())]) if lateness else plain

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        before, reached, behind = _advance(batch, path, number, delay_s)
        last_end = F.coalesce(floor_to(F.col("us"), slide) + size, F.lit(NEVER))
        if behind:
            _write(batch.where(last_end + lateness <= before), _part(path, "late", number))
        rows = batch.where(last_end + lateness > before)
        fresh = pane_counts(rows if counted is None else rows.where(counted), keys, slide, "ts")
        panes = fresh
        if number > 0:
            panes = panes.unionByName(spark.read.schema(panes_schema).parquet(_part(path, "open", number - 1)))
        panes = panes.groupBy(*keys, "_end").agg(F.sum("cnt").alias("cnt"))
        # Windows that are over, those that late rows can still change included.
        due = change(counts(panes).where((end > before - lateness) & (end <= reached)))
        if lateness:
            _write(due, _part(path, "told", number))
            old = spark.createDataFrame([], plain)
            if number > 0:
                old = spark.read.schema(plain).parquet(_part(path, "told", number - 1)).where(end > before - lateness)
            due = _differences(old, spark.read.schema(plain).parquet(_part(path, "told", number)))
        _write(due, _part(path, "rows", number))
        _write(panes.where(F.col("_end") + size - slide + lateness > reached), _part(path, "open", number))
        batch.unpersist()
        _settle(spark, path, number, schema, line.schema)

    def close() -> None:
        number, reached = _last(spark, path, delay_s)
        if number is not None:
            panes = spark.read.schema(panes_schema).parquet(_part(path, "open", number))
            left = change(counts(panes).where(end > reached))
            _write(left.withColumn("sign", F.lit(1)) if lateness else left, _part(path, "rows", number + 1))

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema, close, corrected=bool(lateness))


def tag_late(
    events: DataFrame, path: str, place: Column, arrival: list[str], fine: int, coarse: int,
    size_s: int = 600, slide_s: int = 10, delay_s: int = 1, lateness_s: int = 60,
) -> Incremental:
    """The batch form on each micro-batch, going on from the time that the ones before
    have reached: each row against the rows that came before it, however they fall
    into micro-batches."""
    kept = [field for field in events.schema if field.name != "kind"]
    schema = StructType(kept + StructType.fromDDL("kind string").fields)
    line = events.withColumn("us", micros())

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        _advance(batch, path, number, delay_s)
        top = _tops(batch.sparkSession, path, number - 1)[0] if number > 0 else None
        told = late_rows.tag_late(batch, place, arrival, fine, coarse, size_s, slide_s, delay_s, lateness_s, seen=top)
        _write(told.select(*schema.names), _part(path, "rows", number))
        batch.unpersist()
        _settle(batch.sparkSession, path, number, schema)

    writer = line.writeStream.foreachBatch(work).option("checkpointLocation", f"{path}/checkpoint")
    return Incremental(writer, path, schema, line.schema)


def capped_windows(
    clicks: DataFrame, path: str, group: str = "province", size_s: int = 3600, slide_s: int = 300,
    limit: int = 100, **cap,
) -> Incremental:
    """The click cap, as above, and sliding counts of the clicks within it in the
    same micro-batches: ``group, window_end, cnt``, each window once it is over.
    Carries the pane counts of the windows still open."""
    spark = clicks.sparkSession
    place = f"{path}/windows"
    size, slide = size_s * SECOND, slide_s * SECOND
    fields = [clicks.schema[group]]
    panes_schema = StructType(fields + StructType.fromDDL("_end bigint, cnt bigint").fields)
    schema = StructType(fields + StructType.fromDDL("window_end bigint, cnt bigint").fields)

    def count(told: DataFrame, number: int, before: int, reached: int) -> None:
        panes = pane_counts(told.where(F.col("kind") == PASS), [group], slide, "ts")
        if number > 0:
            panes = panes.unionByName(spark.read.schema(panes_schema).parquet(_part(place, "open", number - 1)))
        panes = panes.groupBy(group, "_end").agg(F.sum("cnt").alias("cnt"))
        end = F.col("window_end") * 1000
        over = windows_of(panes, [group], size_s, slide_s).where((end > before) & (end <= reached))
        _write(over, _part(place, "rows", number))
        _write(panes.where(F.col("_end") + size - slide > reached), _part(place, "open", number))
        _settle(spark, place, number, schema)

    def close() -> None:
        number, reached = _last(spark, path, cap.get("delay_s", 0))
        if number is not None:
            panes = spark.read.schema(panes_schema).parquet(_part(place, "open", number))
            left = windows_of(panes, [group], size_s, slide_s).where(F.col("window_end") * 1000 > reached)
            _write(left, _part(place, "rows", number + 1))

    job = click_cap(clicks, path, limit, then=count, **cap)
    return Incremental(job.writer, place, schema, job.line, close)
