"""Delimited files as typed records, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.event_time import with_event_time


def read_records(spark: SparkSession, path: str, layout: StructType, arrival: bool = False) -> DataFrame:
    """CSV lines as records with event time ``ts``. ``arrival=True`` adds the
    sortable column ``arrival``: place of the line in its file."""
    df = with_event_time(spark.read.schema(layout).csv(path))
    return df.withColumn("arrival", line_position()) if arrival else df


def stream_records(
    spark: SparkSession, folder: str, layout: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(layout)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_event_time(reader.csv(folder))


def line_position() -> Column:
    """Orders lines by file, split and line without any shuffle."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
    )
