"""Session defaults. Only what the jobs rely on; sizing stays with the cluster."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

SETTINGS = {
    # Window edges and report texts are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Click caps above the default of 1000 are also cut before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # Streaming state lives off-heap, with changelog checkpoints only.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tidewatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Python workers must run the interpreter of the driver.
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
