"""Lines from a socket, for trying a job by hand; not fault tolerant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
