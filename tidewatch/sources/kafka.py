"""Topics as line sources and sinks. Needs the public Kafka connector package
of Spark on the class path (``spark.jars.packages``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def source_options(servers: str, topic: str, starting: str = "latest", group: str | None = None,
                   rows_per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    return options


def topic_lines(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The values of a topic as text, with partition and offset as arrival order."""
    raw = spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load()
    return raw.selectExpr("CAST(value AS STRING) AS value", "partition", "offset")


def publish_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Sends every ``value`` of a batch to a topic."""
    (lines.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def publish_stream(lines: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (lines.select("value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint))
