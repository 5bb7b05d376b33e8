"""The ``events`` table seen as the inputs of the jobs. Columns are derived row
by row, so every view stays a pruned scan of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.event_time import DAY
from ..sources.lines import to_csv_lines
from ..streaming.sinks import shared_folder

# What the kinds of the table stand for. The views keep them as they are, so
# that filters on them reach the file.
VIEW, REMOVED, FAIL, CREATE, PAY, RECEIVE = "view", "error", "error", "signup", "purchase", "click"
HALF_HOUR = 1_800_000_000


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark.read.parquet(f"{folder}/events.parquet"))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table as a stream in several micro-batches, each later in time than the one before."""
    return _typed(_replayed(spark.read.parquet(f"{folder}/events.parquet")))


def closed_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a last row far ahead in time and NULL otherwise: it closes the
    windows of Spark's own aggregations and passes no filter of the jobs."""
    return _typed(_replayed(spark.read.parquet(f"{folder}/events.parquet"), closing=True))


def delayed_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table as a stream in the order in which ``delayed`` rows arrive, up to three hours late."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    return _typed(_replayed(table, wait=F.get_json_object("props", "$.k").cast("bigint") % 7 * F.lit(HALF_HOUR)))


def _replayed(
    table: DataFrame, parts: int = 6, most_rows: int = 1_000_000, closing: bool = False, wait: Column | None = None
) -> DataFrame:
    """Files in order of time, one for each micro-batch: cut by ranges in one job, so that none
    gets more rows than others however uneven the times are. A range is one file: cut by its rows it would
    come in two batches of the same times, and the second one would be late."""
    spark = table.sparkSession
    place = shared_folder(spark)
    us = F.unix_micros(F.col("ts").cast("timestamp")) + (F.lit(0) if wait is None else wait)
    rows, high = table.agg(F.count("*"), F.max(us)).first()
    n = max(parts, -(-rows // most_rows))
    table.repartitionByRange(n, us).write.option("maxRecordsPerFile", 0).parquet(place)
    if closing and rows:
        ahead = F.timestamp_micros(F.lit(high + 1000 * DAY)).cast(table.schema["ts"].dataType)
        columns = [ahead.alias(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
        spark.range(1).select(*columns).coalesce(1).write.parquet(f"{place}/closing")
    # A stream takes files by their times, and tasks end in any order.
    at = spark._jvm.org.apache.hadoop.fs.Path(place)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in files.listStatus(at) if f.getPath().getName().startswith("part-"))
    for k, name in enumerate(names):
        files.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{name}"), 1_000_000_000_000 + 1000 * k, -1)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(place)


def _typed(raw: DataFrame) -> DataFrame:
    # The file has times without a zone; they are UTC, as the session is.
    return raw.select(
        F.col("event_id").alias("arrival"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def behaviors(events: DataFrame) -> DataFrame:
    return events.select(
        "arrival", "user_id", F.col("k").alias("item_id"), (F.col("k") % 5).cast("int").alias("category_id"),
        F.col("event_type").alias("behavior"), "ts",
    )


def market_behaviors(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("behavior"),
        F.concat(F.lit("store"), (F.col("k") % 5).cast("string")).alias("channel"), "ts",
    )


def ad_clicks(events: DataFrame, *keep: str) -> DataFrame:
    return events.select(
        *keep, "arrival", "user_id", F.expr("k div 50").alias("ad_id"),
        F.concat(F.lit("province"), (F.col("k") % 5).cast("string")).alias("province"),
        F.concat(F.lit("city"), (F.col("k") % 10).cast("string")).alias("city"), "ts",
    )


def logins(events: DataFrame) -> DataFrame:
    return events.select(
        "arrival", "user_id", F.concat(F.lit("10.0.0."), F.col("k").cast("string")).alias("ip"), "event_type", "ts"
    )


def order_logs(events: DataFrame) -> DataFrame:
    paid = F.concat(F.lit("tx"), F.col("user_id").cast("string"))
    return events.where(F.col("event_type").isin(CREATE, PAY)).select(
        "arrival", F.col("user_id").alias("order_id"), "event_type",
        F.when(F.col("event_type") == PAY, paid).otherwise("").alias("tx_id"), "ts",
    )


def receipts(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == RECEIVE).select(
        "arrival", F.concat(F.lit("tx"), F.col("user_id").cast("string")).alias("tx_id"),
        F.when(F.col("k") % 2 == 0, "wechat").otherwise("alipay").alias("pay_channel"), "ts",
    )


def behavior_lines(events: DataFrame) -> DataFrame:
    return to_csv_lines(
        behaviors(events).withColumn("epoch_s", F.unix_seconds("ts")),
        ["user_id", "item_id", "category_id", "behavior", "epoch_s"],
    )


def broken_behavior_lines(events: DataFrame) -> DataFrame:
    """CSV lines with their arrival; one in 50 lacks its last field, one in 50 has no number for its item."""
    columns = ["user_id", "item_id", "category_id", "behavior", "epoch_s"]
    records = behaviors(events).withColumn("epoch_s", F.unix_seconds("ts"))
    lines = to_csv_lines(records, columns, ("arrival",))
    short, odd = F.col("arrival") % 50 == 7, F.col("arrival") % 50 == 8
    broken = F.when(short, F.substring_index("value", ",", 4)).when(odd, F.regexp_replace("value", r"^(\d+),\d+", "$1,item"))
    return lines.select("arrival", F.coalesce(broken, "value").alias("value"))


def web_log_lines(events: DataFrame, *keep: str) -> DataFrame:
    """Access-log lines; some of the urls are stylesheets and scripts."""
    tail = F.when(F.col("k") % 10 == 0, ".css").when(F.col("k") % 10 == 1, ".js").when(
        F.col("k") % 10 == 2, ".js?v=1").otherwise("")
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string"), tail)
    method = F.when(F.col("event_type") == "purchase", "POST").otherwise("GET")
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), F.col("k").cast("string")), F.col("user_id").cast("string"), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), method, url,
    )
    return events.select(*keep, line.alias("value"))


def broken_log_lines(events: DataFrame) -> DataFrame:
    """Access-log lines with their arrival; one in 50 ends early, one in 50 has a month 13."""
    lines = web_log_lines(events, "arrival")
    short, odd = F.col("arrival") % 50 == 7, F.col("arrival") % 50 == 8
    broken = F.when(short, F.substring_index("value", " ", 4)).when(odd, F.regexp_replace("value", r"/\d\d/", "/13/"))
    return lines.select("arrival", F.coalesce(broken, "value").alias("value"))


def delayed(events: DataFrame) -> DataFrame:
    """Rows that arrive up to three hours after their event time."""
    return events.withColumn("arrived_us", F.unix_micros("ts") + F.col("k") % 7 * F.lit(HALF_HOUR))
