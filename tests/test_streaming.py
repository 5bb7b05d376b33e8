"""Streams must end with the results of their batch forms on the same rows."""

import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streams import as_stream, rows, rows_with_nulls
from tidewatch.functions.event_time import SECOND, watermarked, where_watermarked
from tidewatch.operators import clicks as batch_clicks
from tidewatch.operators import orders as batch_orders
from tidewatch.operators import ranking
from tidewatch.operators import reconcile as batch_reconcile
from tidewatch.operators import sequences as batch_sequences
from tidewatch.operators import windows as batch_windows
from tidewatch.plans import stream_jobs
from tidewatch.streaming import clicks, detect, incremental, sinks, windows

START = 1_700_000_000 * SECOND
FAR = START + 400 * 86_400 * SECOND
LIMIT_S = 240


def events(n, kinds, keys, span_s, jitter_s=0, seed=7):
    rng = np.random.default_rng(seed)
    us = np.sort(rng.integers(0, span_s * 4, n)) * (SECOND // 4)
    arrival = np.argsort(us + rng.integers(0, jitter_s + 1, n) * SECOND, kind="stable")
    pdf = pd.DataFrame({
        "key": rng.integers(0, keys, n), "kind": rng.choice(kinds, n), "us": START + us,
    }).iloc[arrival].reset_index(drop=True)
    return pdf.assign(seq=np.arange(n))


def batch(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("ts", F.timestamp_micros("us"))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "in")


END = {"key": -1, "kind": "end", "us": FAR, "seq": 10**9}
END_AD = {"key": -1, "ad": "end", "us": FAR, "seq": 10**9}


def finished(job, spark):
    sinks.run_available(job.writer, LIMIT_S)
    job.finish()
    return job.read(spark)


def test_failures(spark, folder):
    pdf = events(600, ["fail", "fail", "ok"], 5, 900, jitter_s=6)
    names = {"key": "key", "kind": "kind", "arrival": "seq"}
    job = incremental.failures(as_stream(spark, pdf, folder), folder + "o", 5, 7, **names)
    got = finished(job, spark)
    want = batch_sequences.repeated_failures(batch(spark, pdf), 5, **names)
    assert rows(want, "*") == rows(got, *want.columns) and want.count() > 50


def test_sequences(spark, folder):
    pdf = events(500, ["create", "pay", "other"], 8, 9000, jitter_s=6)
    names = {"key": "key", "kind": "kind", "arrival": "seq"}
    job = incremental.sequences(as_stream(spark, pdf, folder), folder + "o", 90, 7, **names)
    got = finished(job, spark)
    want = batch_sequences.followed_within(batch(spark, pdf), 90, **names)
    assert rows_with_nulls(want, "*") == rows_with_nulls(got, *want.columns)
    assert {r.kind for r in want.select("kind").distinct().collect()} == {"payed", "timeout"}


@pytest.mark.parametrize("grace_s", [0, 60])
def test_orders(spark, folder, grace_s):
    pdf = events(500, ["create", "pay"], 8, 9000, jitter_s=6)
    names = {"key": "key", "kind": "kind", "arrival": "seq"}
    job = incremental.order_states(as_stream(spark, pdf, folder), folder + "o", 90, grace_s, 7, **names)
    got = finished(job, spark)
    want = batch_orders.order_results(batch(spark, pdf), 90, grace_s, slice_s=60, **names)
    assert rows(want, "*") == rows(got, *want.columns)
    assert want.select("result_msg").distinct().count() == (4 if grace_s else 3)


@pytest.mark.parametrize("batches", [1, 5])
def test_one_to_one(spark, folder, batches):
    pdf = events(500, ["pay", "receipt"], 6, 600, jitter_s=4).rename(columns={"seq": "rid"})
    end = [{"key": -1, "kind": "pay", "us": FAR, "rid": 10**9}, {"key": -2, "kind": "receipt", "us": FAR, "rid": 10**9}]
    stream = as_stream(spark, pdf, folder, batches, end)
    pays, receipts = (stream.where(F.col("kind") == k) for k in ("pay", "receipt"))
    names = {"key": "key", "pay_id": "rid", "receipt_id": "rid"}
    job = incremental.matches(pays, receipts, folder + "o", delay_s=5, **names)
    sinks.run_available(job.writer, LIMIT_S)
    got = job.read(spark)
    b = batch(spark, pdf)
    want = batch_reconcile.match_one_to_one(b.where("kind = 'pay'"), b.where("kind = 'receipt'"), **names)
    assert rows_with_nulls(want, *want.columns) == rows_with_nulls(got, *want.columns)
    assert want.select("kind").distinct().count() == 3


@pytest.mark.parametrize("batches", [1, 5])
def test_incremental(spark, folder, batches):
    """The batch operators run over micro-batches."""
    kinds = ["fail", "fail", "create", "pay"]
    pdf = events(600, kinds, 5, 1500, jitter_s=6)
    b, names = batch(spark, pdf), {"key": "key", "kind": "kind", "arrival": "seq"}
    cases = {
        "failures": (5, {}, batch_sequences.repeated_failures(b, 5, **names)),
        "sequences": (30, {}, batch_sequences.followed_within(b, 30, **names)),
        "order_states": (10, {"grace_s": 15}, batch_orders.order_results(b, 10, 15, **names)),
    }
    for name, (within_s, options, want) in cases.items():
        stream = as_stream(spark, pdf, folder + name, batches, END)
        job = getattr(incremental, name)(stream, f"{folder}{name}o", within_s, delay_s=7, **options, **names)
        sinks.run_available(job.writer, LIMIT_S)
        assert rows_with_nulls(want, "*") == rows_with_nulls(job.read(spark), *want.columns), name


@pytest.mark.parametrize("strict,batches", [(False, 4), (True, 7)])
def test_incremental_click_cap(spark, folder, strict, batches):
    pdf = events(900, ["a", "b"], 4, 3 * 86_400, jitter_s=600).rename(columns={"kind": "ad"})
    job = incremental.click_cap(
        as_stream(spark, pdf, folder, batches), folder + "o", 20, strict, 600, keys=("key", "ad"), arrival="seq")
    sinks.run_available(job.writer, LIMIT_S)
    want = batch_clicks.cap_clicks(batch(spark, pdf), 20, strict, keys=("key", "ad"), arrival=("seq",))
    columns = ("key", "ad", "seq", "us", "kind")
    assert rows(want, *columns) == rows(job.read(spark), *columns)
    assert want.where("kind = 'warning'").count() > 10
    # Only days that can still get clicks are carried along.
    last = spark.read.parquet(folder + f"o/open/batch={batches - 1}")
    assert last.select("_day").distinct().count() <= 2


def test_incremental_capped_windows(spark, folder):
    pdf = events(900, ["a", "b"], 4, 2 * 86_400).rename(columns={"kind": "ad"}).assign(province="p")
    pdf["province"] = "p" + (pdf["seq"] % 3).astype(str)
    end = {**END_AD, "province": "end"}
    job = incremental.capped_windows(
        as_stream(spark, pdf, folder, 5, end), folder + "o", "province", 3600, 300, 20,
        keys=("key", "ad"), arrival="seq")
    sinks.run_available(job.writer, LIMIT_S)
    kept = batch_clicks.passed(batch_clicks.cap_clicks(batch(spark, pdf), 20, keys=("key", "ad"), arrival=("seq",)))
    want = batch_windows.sliding_counts(kept, ["province"], 3600, 300)
    assert rows(want, *want.columns) == rows(job.read(spark).where("province <> 'end'"), *want.columns)


def test_incremental_batch_runs_again(spark, folder):
    """A batch that is repeated after a failure replaces what it had written."""
    pdf = events(300, ["fail", "ok"], 3, 600)
    job = incremental.failures(
        as_stream(spark, pdf, folder, 3, END), folder + "o", 5, 0, key="key", kind="kind", arrival="seq")
    sinks.run_available(job.writer, LIMIT_S)
    before = rows(job.read(spark), "*")
    commits = folder + "o/checkpoint/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in os.listdir(commits):
        if str(last) in name.split("."):
            os.unlink(f"{commits}/{name}")
    sinks.run_available(job.writer, LIMIT_S)
    assert rows(job.read(spark), "*") == before and before


def test_interval_join(spark, folder):
    pdf = events(400, ["pay", "receipt"], 6, 600, jitter_s=4).rename(columns={"seq": "rid"})
    end = {"key": -1, "kind": "pay", "us": FAR, "rid": 10**9}
    stream = watermarked(as_stream(spark, pdf, folder, end=end), 5)
    pays, receipts = (where_watermarked(stream, F.col("kind") == k) for k in ("pay", "receipt"))
    names = {"key": "key", "pay_id": "rid", "receipt_id": "rid"}
    got = sinks.table_of(detect.interval_join(pays, receipts, **names), LIMIT_S)
    b = batch(spark, pdf)
    want = batch_reconcile.interval_join(b.where("kind = 'pay'"), b.where("kind = 'receipt'"), **names)
    assert rows(want, *want.columns) == rows(got, *want.columns) and want.count() > 50


@pytest.mark.parametrize("strict,salts", [(False, 1), (True, 3)])
def test_click_cap(spark, folder, strict, salts):
    pdf = events(600, ["a", "b"], 4, 3 * 86_400)
    stream = watermarked(as_stream(spark, pdf.rename(columns={"kind": "ad"}), folder, end=END_AD), 0)
    got = sinks.table_of(clicks.cap_clicks(stream, 20, strict, keys=("key", "ad"), salts=salts), LIMIT_S)
    b = batch(spark, pdf.rename(columns={"kind": "ad"}))
    want = batch_clicks.cap_clicks(b, 20, strict, keys=("key", "ad"), arrival=("seq",))
    columns = ("key", "ad", "seq", "us", "kind")
    assert rows(want, *columns) == rows(got.where("key >= 0"), *columns)
    assert want.where("kind = 'warning'").count() > 5 and want.count() < 600


def test_click_cap_by_clock(spark, folder):
    """All rows come in on one day of the clock, whatever their event time."""
    pdf = events(300, ["a"], 2, 3 * 86_400).rename(columns={"kind": "ad"})
    stream = as_stream(spark, pdf, folder)
    writer = sinks.to_parquet(
        clicks.cap_clicks(stream, 20, keys=("key", "ad"), by_event_day=False), folder + "o", folder + "c"
    )
    # Timers of the clock ask for one more batch for ever, so wait for the input only.
    query = writer.trigger(processingTime="1 second").start()
    try:
        end = time.time() + 60
        while sum(p.numInputRows for p in query.recentProgress) < 300 and time.time() < end:
            time.sleep(0.5)
    finally:
        query.stop()
    got = spark.read.parquet(folder + "o").groupBy("key", "kind").count()
    assert {(r[0], r[1]): r[2] for r in got.collect()} == {
        (k, kind): n for k in (0, 1) for kind, n in (("pass", 20), ("warning", 1))
    }


def test_windows(spark, folder):
    pdf = events(800, ["x", "y"], 6, 3600, jitter_s=5)
    for n, (stream_form, batch_form) in enumerate([
        (lambda s: windows.sliding_counts(s, ["key"], 600, 60),
         lambda b: batch_windows.sliding_counts(b, ["key"], 600, 60)),
        (lambda s: windows.tumbling_counts(s, [], 300), lambda b: batch_windows.tumbling_counts(b, [], 300)),
        (lambda s: windows.distinct_per_window(s, "key", 300),
         lambda b: batch_windows.distinct_per_window(b, "key", 300)),
        # So few keys are counted exactly.
        (lambda s: windows.approx_distinct_per_window(s, "key", 300),
         lambda b: batch_windows.distinct_per_window(b, "key", 300)),
    ]):
        end = {"key": -1, "kind": "end", "us": FAR, "seq": 10**9}
        stream = watermarked(as_stream(spark, pdf, f"{folder}{n}", end=end), 6)
        got = sinks.table_of(stream_form(stream), LIMIT_S)
        want = batch_form(batch(spark, pdf))
        assert rows(want, *want.columns) == rows(got.where(F.col("window_end") < FAR // 1000), *want.columns)


def test_top_per_window(spark, folder):
    pdf = events(800, ["x", "y"], 12, 1800, jitter_s=5)
    stream = watermarked(as_stream(spark, pdf, folder, end=END), 6)
    counts = windows.sliding_counts(stream, ["key"], 600, 60)
    writer = sinks.to_top_per_window(counts, "key", 3, folder + "o", folder + "c")
    schema = "window_end bigint, rank int, key bigint, cnt bigint"
    got = sinks.batches_table(writer, spark, folder + "o", schema, LIMIT_S).where(F.col("window_end") < FAR // 1000)
    want = ranking.top_per_window(batch_windows.sliding_counts(batch(spark, pdf), ["key"], 600, 60), "key", 3)
    assert rows(want, *want.columns) == rows(got, *want.columns)


def test_updates(spark, folder):
    """Early results are corrected by rows within the allowed lateness."""
    pdf = events(600, ["x"], 5, 900, jitter_s=40)
    stream = watermarked(as_stream(spark, pdf, folder, batches=6, end=END), 61)
    counts = windows.updating_counts(stream, ["key"], 600, 60)
    sinks.run_available(sinks.to_batches(counts, folder + "o", folder + "c", mode="update"), LIMIT_S)
    updates = spark.read.parquet(folder + "o").where("key >= 0")
    want = batch_windows.sliding_counts(batch(spark, pdf), ["key"], 600, 60)
    assert updates.count() > want.count()
    assert rows(want, "key", "window_end", "cnt") == rows(
        sinks.latest_counts(updates, ["key"]), "key", "window_end", "cnt")


@pytest.mark.parametrize("size_s,slide_s", [(600, 60), (120, 120)])
def test_corrected_windows(spark, folder, size_s, slide_s):
    """Ranked when they are over, and again when late rows come."""
    pdf = events(600, ["x", "x", "no"], 5, 900, jitter_s=40)
    job = incremental.window_counts(
        as_stream(spark, pdf, folder, batches=6), folder + "o", ["key"], size_s, slide_s, 1, 60, F.col("kind") == "x",
        lambda counts: ranking.top_per_window(counts, "key", 3))
    sinks.run_available(job.writer, LIMIT_S)
    job.finish()
    kept = batch(spark, pdf).where("kind = 'x'")
    want = ranking.top_per_window(batch_windows.sliding_counts(kept, ["key"], size_s, slide_s), "key", 3)
    assert rows(want, *want.columns) == rows(job.read(spark), *want.columns)
    changes = job.changes(spark)
    back = changes.where("sign < 0").count()
    # Only what changed is told again: each row taken back once, and no more rows than hold and were taken back.
    assert back > 0 and changes.where("sign > 0").count() == want.count() + back and job.late(spark).count() == 0


def test_rows_too_late_for_any_window_are_kept_aside(spark, folder):
    pdf = pd.DataFrame({
        "key": [1, 1, 1, 1], "kind": "x", "us": [START, START + 7200 * SECOND, START + 60 * SECOND, START + 7260 * SECOND],
        "seq": range(4)})
    job = incremental.window_counts(as_stream(spark, pdf, folder, batches=4), folder + "o", ["key"], 600, 60, 0, 60)
    sinks.run_available(job.writer, LIMIT_S)
    job.finish()
    want = batch_windows.sliding_counts(batch(spark, pdf).where("seq <> 2"), ["key"], 600, 60)
    assert rows(want, *want.columns) == rows(job.read(spark), *want.columns)
    assert [r.seq for r in job.late(spark).collect()] == [2]


def test_late_rows(spark, folder):
    """Each row against all rows before it, however they fall into micro-batches."""
    pdf = events(400, ["x"], 5, 3600, jitter_s=1500)
    want, top = [], None
    for us, seq in zip(pdf["us"], pdf["seq"]):
        closes = us - us % (10 * SECOND) + 60 * SECOND - 1000 + 60 * SECOND
        want.append((seq, "late" if top is not None and closes <= top - SECOND else "on_time"))
        top = us if top is None else max(top, us)
    assert {k for _, k in want} == {"late", "on_time"}
    for batches in (1, 5):
        stream = as_stream(spark, pdf, f"{folder}{batches}", batches=batches)
        job = incremental.tag_late(stream, f"{folder}o{batches}", F.col("seq"), ["seq"], 20, 100, 60, 10, 1, 60)
        assert rows(finished(job, spark), "seq", "kind") == sorted(want)


def test_late_pays_decide(spark, folder):
    """A pay that comes after time has passed it, one that takes a timeout back, and one that is too late for anything."""
    records = [
        (1, "create", 1000), (2, "create", 1000), (3, "pay", 1010),
        (1, "pay", 1005), (9, "create", 2100),
        (2, "pay", 1200), (3, "create", 1001), (9, "pay", 2200),
        (9, "create", 9000), (9, "pay", 9100),
        (4, "pay", 1500), (9, "create", 9200),
    ]
    pdf = pd.DataFrame(records, columns=["key", "kind", "s"])
    pdf = pdf.assign(us=START + pdf["s"] * SECOND, seq=range(len(pdf))).drop(columns="s")
    names = {"create": "create", "pay": "pay", "key": "key", "kind": "kind", "arrival": "seq"}
    stream = as_stream(spark, pdf, folder, batches=len(records))
    job = incremental.order_states(stream, folder + "o", 900, 0, lateness_s=1800, **names)
    got = rows(finished(job, spark), "key", "us", "result_msg")
    want = batch_orders.order_results(batch(spark, pdf).where("seq <> 10"), 900, 0, **names)
    assert got == rows(want, "key", "us", "result_msg")
    assert (1, START + 1005 * SECOND, "payed successfully") in got and (2, START + 1200 * SECOND, "payed successfully") in got
    back = rows(job.changes(spark).where("sign < 0"), "key", "us", "result_msg")
    assert (2, START + 1000 * SECOND, "timeout") in back and (3, START + 1010 * SECOND, "payed but not found create") in back
    assert [r.key for r in job.late(spark).collect()] == [4]


def test_orders_in_disorder(spark, folder):
    pdf = events(500, ["create", "pay"], 12, 600, jitter_s=40)
    names = {"create": "create", "pay": "pay", "key": "key", "kind": "kind", "arrival": "seq"}
    job = incremental.order_states(as_stream(spark, pdf, folder, 6), folder + "o", 20, 10, lateness_s=40, **names)
    got = finished(job, spark)
    want = batch_orders.order_results(batch(spark, pdf), 20, 10, **names)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert job.changes(spark).where("sign < 0").count() > 0 and job.late(spark).count() == 0


def test_late_receipts_meet_who_still_waits(spark, folder):
    """Seconds; each row is a micro-batch. The pay at 100 waits until 105."""
    records = [("a", "pay", 100), ("b", "pay", 100), ("x", "pay", 103), ("x", "receipt", 103), ("a", "receipt", 99),
               ("x", "pay", 120), ("x", "receipt", 120), ("b", "receipt", 102)]
    pdf = pd.DataFrame(records, columns=["key", "kind", "s"])
    pdf = pdf.assign(us=START + pdf["s"] * SECOND, rid=range(len(pdf))).drop(columns="s")
    stream = as_stream(spark, pdf, folder, batches=len(records))
    job = incremental.matches(
        stream.where("kind = 'pay'"), stream.where("kind = 'receipt'"), folder + "o", key="key", pay_id="rid", receipt_id="rid")
    got = rows_with_nulls(finished(job, spark), "key", "kind", "pay_id", "receipt_id")
    assert got == sorted([
        ("a", "matched", 0, 4), ("b", "unmatched_pay", 1, None), ("b", "unmatched_receipt", None, 7),
        ("x", "matched", 2, 3), ("x", "matched", 5, 6)], key=repr)


def test_a_silent_input_is_not_waited_for(spark, folder):
    pdf = pd.DataFrame({"key": "a", "us": [START + s * SECOND for s in (100, 200, 300, 400)], "rid": range(4), "kind": "pay"})
    stream = as_stream(spark, pdf, folder, batches=4)
    pays, receipts = (stream.where(F.col("kind") == k) for k in ("pay", "receipt"))
    for idle_s, decided in ((None, 0), (50, 3)):
        job = incremental.matches(pays, receipts, f"{folder}o{idle_s}", key="key", pay_id="rid", receipt_id="rid", idle_s=idle_s)
        sinks.run_available(job.writer, LIMIT_S)
        assert job.read(spark).count() == decided
        job.finish()
        assert job.read(spark).count() == 4


def test_capped_clicks_go_on_as_a_stream(spark, folder):
    """Cap with timers and windows in one query."""
    pdf = events(500, ["a", "b"], 4, 86_400).rename(columns={"kind": "ad"})
    pdf["province"] = "p" + (pdf["seq"] % 3).astype(str)
    stream = as_stream(spark, pdf, folder, end={**END_AD, "province": "end"})
    names = {"keys": ("key", "ad"), "seq": "seq"}
    got = sinks.table_of(stream_jobs.province_clicks(stream, 20, **names), LIMIT_S)
    kept = batch_clicks.passed(batch_clicks.cap_clicks(batch(spark, pdf), 20, keys=("key", "ad"), arrival=("seq",)))
    want = batch_windows.sliding_counts(kept, ["province"], 3600, 300)
    assert rows(want, *want.columns) == rows(got.where("province <> 'end'"), *want.columns)
