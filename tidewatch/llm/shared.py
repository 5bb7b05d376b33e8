"""What the operators share: tables, the folder for intermediate data, text in Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a temporary one if the session is local."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidewatch-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remainder_of_id(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id gives -1, so such rows are in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(-1))


def let(value: Column, use) -> Column:
    """use(value) with value computed once a row, for use inside lambda functions."""
    return F.transform(F.array(value), use)[0]


def text_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of bounded text size (one row at least), with the UTF-8 bytes of each text (None for null)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        sizes = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
            yield batch.slice(start, end - start), texts.slice(start, end - start).to_pylist()
            start = end
