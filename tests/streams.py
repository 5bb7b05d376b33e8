"""Small streams for the tests: one parquet file per micro-batch."""

import os

import pandas as pd
from pyspark.sql import functions as F


def as_stream(spark, pdf: pd.DataFrame, folder: str, batches: int = 3, end: dict | list | None = None):
    """``pdf`` needs ``us`` and comes in row order. ``end`` is a last row (or more) far
    in the future that lets the watermark pass everything else."""
    os.makedirs(folder)
    size = -(-len(pdf) // batches)
    parts = [pdf.iloc[i:i + size] for i in range(0, len(pdf), size)]
    if end is not None:
        ends = end if isinstance(end, list) else [end]
        parts.append(pd.DataFrame(ends)[list(pdf.columns)].astype(pdf.dtypes))
    for i, part in enumerate(parts):
        path = f"{folder}/{i:03d}.parquet"
        part.to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.withColumn("ts", F.timestamp_micros("us"))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def rows_with_nulls(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
