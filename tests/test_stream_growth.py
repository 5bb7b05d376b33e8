"""What streams keep and call must not grow with the number of keys."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from streams import as_stream, rows, rows_with_nulls
from tidewatch.functions.event_time import SECOND, watermarked
from tidewatch.operators import clicks as batch_clicks
from tidewatch.operators import reconcile as batch_reconcile
from tidewatch.operators import windows as batch_windows
from tidewatch.plans import driver_tables, stream_jobs
from tidewatch.streaming import clicks, incremental, sinks

START = 1_700_000_000 * SECOND
LIMIT_S = 240


def test_click_cap_keeps_a_state_per_part_and_not_per_key(spark, tmp_path):
    """3,000 keys, NULL and whole numbers that no double holds among them."""
    n, rng = 4000, np.random.default_rng(3)
    user = pd.Series(2**60 + rng.integers(0, 3000, n), dtype="Int64")
    user[:40] = None
    pdf = pd.DataFrame({
        "user": user, "ad": rng.choice(["a", None], n), "us": START + np.arange(n) * SECOND,
        "seq": 2**60 + np.arange(n), "note": pd.Series(2**60 + np.arange(n), dtype="Int64").where(np.arange(n) % 3 > 0)})
    stream = watermarked(as_stream(spark, pdf, str(tmp_path / "in"), 2), 0)
    capped = clicks.cap_clicks(stream, 1, keys=("user", "ad"), parts=8)
    query = sinks.run_available(sinks.to_parquet(capped, str(tmp_path / "o"), str(tmp_path / "c")), LIMIT_S)
    table = spark.read.parquet(str(tmp_path / "in")).withColumn("ts", F.timestamp_micros("us"))
    want = batch_clicks.cap_clicks(table, 1, keys=("user", "ad"), arrival=("seq",))
    columns = ("user", "ad", "seq", "us", "note", "kind")
    got = spark.read.schema(capped.schema).parquet(str(tmp_path / "o"))
    assert rows_with_nulls(want, *columns) == rows_with_nulls(got, *columns)
    assert want.where("user IS NULL AND kind = 'warning'").count() == 2
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) <= 8 * 4


def spark_state(query):
    return [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]


def test_pairs_keep_no_rows_in_sparks_state(spark, tmp_path):
    n, rng = 400, np.random.default_rng(5)
    pdf = pd.DataFrame({
        "key": pd.Series(rng.integers(0, 6, n), dtype="Int64"), "kind": rng.choice(["pay", "receipt"], n),
        "us": START + np.arange(n) * SECOND, "rid": np.arange(n)})
    pdf.loc[:20, "key"] = None
    names = {"key": "key", "pay_id": "rid", "receipt_id": "rid"}
    stream = as_stream(spark, pdf, str(tmp_path / "in"), 5)
    sides = [stream.where(F.col("kind") == k) for k in ("pay", "receipt")]
    job = incremental.pairs(*sides, str(tmp_path / "o"), 30, 50, counted=F.col("rid") % 7 != 0, **names)
    assert spark_state(sinks.run_available(job.writer, LIMIT_S)) == []
    table = spark.read.parquet(str(tmp_path / "in")).withColumn("ts", F.timestamp_micros("us"))
    want = batch_reconcile.interval_join(
        table.where("kind = 'pay' AND rid % 7 <> 0"), table.where("kind = 'receipt'"), 30, 50, **names)
    assert rows(want, *want.columns) == rows(job.read(spark), *want.columns) and want.count() > 100
    # Only what can still get a partner is carried along.
    assert spark.read.parquet(str(tmp_path / "o/open/batch=4")).count() < 60


def test_visitors_keep_no_rows_in_sparks_state(spark, tmp_path):
    n, rng = 500, np.random.default_rng(6)
    pdf = pd.DataFrame({"user_id": rng.integers(0, 40, n), "behavior": rng.choice(["pv", "buy"], n), "us": START + np.arange(n) * 30 * SECOND})
    stream = as_stream(spark, pdf, str(tmp_path / "in"), 4)
    job = stream_jobs.visitor_table(stream, str(tmp_path / "o"), view="pv")
    assert spark_state(sinks.run_available(job.writer, LIMIT_S)) == []
    job.finish()
    table = spark.read.parquet(str(tmp_path / "in")).withColumn("ts", F.timestamp_micros("us"))
    want = batch_windows.distinct_per_window(table.where("behavior = 'pv'"), "user_id", 3600)
    assert rows(want, *want.columns) == rows(job.read(spark), *want.columns)


def test_replayed_batches_do_not_overlap_in_time(spark, tmp_path):
    """However many rows a range gets: what comes behind the watermark is lost."""
    table = spark.range(3000).select(F.timestamp_micros(START + (F.col("id") * 7919 % 3000) * 1000).alias("ts"), F.col("id"))
    stream = driver_tables._replayed(table, parts=2, most_rows=1000)
    sinks.run_available(sinks.to_batches(stream, str(tmp_path / "o"), str(tmp_path / "c")), LIMIT_S)
    spans = spark.read.parquet(str(tmp_path / "o")).groupBy("batch").agg(F.min("ts"), F.max("ts")).orderBy("batch").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:])) and len(spans) == 3
