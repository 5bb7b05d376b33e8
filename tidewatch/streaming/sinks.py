"""Where streaming results go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.ranking import top_per_window


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. A machine-local one serves
    only where that is unset and the session is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def to_console(df: DataFrame, label: str, mode: str = "append", rows: int = 20) -> DataStreamWriter:
    return (df.writeStream.queryName(label).outputMode(mode).format("console")
        .option("truncate", "false").option("numRows", rows))


def to_parquet(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only results, each written exactly once."""
    return (df.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint))


def to_batches(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append",
    change: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataStreamWriter:
    """Applies ``change`` to each micro-batch and writes it below
    ``path/batch=<id>``. A repeated batch replaces its own folder, so a retry
    after a failure leaves no duplicates."""
    def write(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (df.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint))


def to_top_per_window(counts: DataFrame, subject: str, k: int, path: str, checkpoint: str) -> DataStreamWriter:
    """Ranks each window when it is final. All counts of a window leave the
    append-mode aggregation in the micro-batch in which the watermark passes
    its end, so ranking inside the batch is exact and keeps no further state."""
    return to_batches(counts, path, checkpoint, change=lambda batch: top_per_window(batch, subject, k))


def latest_counts(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last word of an update-mode change log (``to_batches(..., "update")``):
    one row per key and window, however often it was corrected."""
    return updates.groupBy(*keys, "window_end").agg(F.max_by("cnt", "batch").alias("cnt"))


def run_available(writer: DataStreamWriter, timeout_s: int | None = None) -> StreamingQuery:
    """Works through what the source holds now, over several micro-batches, and stops."""
    query = writer.trigger(availableNow=True).start()
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s")
    return query


def table_of(df: DataFrame, timeout_s: int | None = None) -> DataFrame:
    """Runs an append-mode stream over the available input into a table and reads it."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    run_available(to_parquet(df, f"{folder}/rows", f"{folder}/checkpoint"), timeout_s)
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def batches_table(writer: DataStreamWriter, spark: SparkSession, path: str, schema: str,
                  timeout_s: int | None = None) -> DataFrame:
    run_available(writer, timeout_s)
    return spark.read.schema(schema).parquet(path)
