"""Sources, lines and sinks."""

import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from golden_files import fixture_file
from tidewatch import schemas
from tidewatch.plans import jobs, stream_jobs
from tidewatch.sources import kafka
from tidewatch.sources.files import read_records, stream_records
from tidewatch.sources.lines import parse_csv_lines, parse_web_log, to_csv_lines
from tidewatch.streaming import sinks


def test_csv_lines_and_back(spark):
    lines = spark.createDataFrame([("17,1715,464,pv,1511658000",)], "value string")
    records = parse_csv_lines(lines, schemas.USER_BEHAVIOR)
    row = records.first()
    assert (row.user_id, row.item_id, row.category_id, row.behavior) == (17, 1715, 464, "pv")
    assert records.select(F.unix_seconds("ts")).first()[0] == 1511658000
    again = to_csv_lines(records, ["user_id", "item_id", "category_id", "behavior", "epoch_s"])
    assert again.first().value == "17,1715,464,pv,1511658000"


def test_market_lines(spark):
    lines = spark.createDataFrame([("u1,CLICK,wechat,1511658000123",)], "value string")
    row = parse_csv_lines(lines, schemas.MARKET_BEHAVIOR).select("channel", F.unix_millis("ts").alias("ms")).first()
    assert tuple(row) == ("wechat", 1511658000123)


def test_web_log(spark):
    lines = spark.createDataFrame(
        [("10.1.2.3 u7 - 17/05/2015:10:05:03 +0000 GET /docs/a.png",)], "value string")
    row = parse_web_log(lines).select("ip", "user_id", F.unix_seconds("ts").alias("s"), "method", "url").first()
    assert tuple(row) == ("10.1.2.3", "u7", 1431857103, "GET", "/docs/a.png")


def test_line_positions(spark, tmp_path):
    """``arrival`` sorts lines in file order even when a file is split over tasks."""
    path = f"{tmp_path}/clicks.csv"
    with open(path, "w") as out:
        out.writelines(f"{i},1,p,c,{1511658000 - i}\n" for i in range(5000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_records(spark, path, schemas.AD_CLICK, arrival=True)
        assert df.rdd.getNumPartitions() > 2
        assert [r.user_id for r in df.orderBy("arrival").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_kafka_options():
    options = kafka.source_options("host:9092", "behavior", group="analytics", rows_per_trigger=10)
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "behavior", "startingOffsets": "latest",
        "kafka.group.id": "analytics", "maxOffsetsPerTrigger": "10",
    }


def test_kafka_needs_its_connector(spark):
    lines = spark.createDataFrame([("a",)], "value string")
    with pytest.raises(AnalysisException, match="kafka"):
        kafka.publish_lines(lines, "host:9092", "topic")
    with pytest.raises(AnalysisException, match="kafka"):
        kafka.topic_lines(spark, "host:9092", "topic")


def fixture_stream(spark, tmp_path, column, layout, last_line):
    """A fixture file as one batch and a last line that closes the time as another."""
    folder = tmp_path / "in"
    os.makedirs(folder)
    shutil.copyfile(fixture_file(column), folder / "0.csv")
    (folder / "1.csv").write_text(last_line + "\n")
    for i in (0, 1):
        os.utime(folder / f"{i}.csv", (1_700_000_000 + i,) * 2)
    # A stream of files has no line numbers; where a second holds more rows of a key, the create comes first.
    records = stream_records(spark, str(folder), layout, files_per_trigger=1)
    return records.withColumn("line", F.struct("epoch_s", F.col("event_type").alias("kind")))


def finished(job, spark):
    sinks.run_available(job.writer, 120)
    job.finish()
    return job.read(spark)


def test_login_stream(spark, tmp_path):
    logins = fixture_stream(spark, tmp_path, "ip string", schemas.LOGIN, "0,x,success,1600000000")
    got = finished(stream_jobs.login_failures(logins, f"{tmp_path}/out", arrival="line"), spark)
    assert sorted((r.user_id, r.first_us // 10**6) for r in got.collect()) == [
        (1035, 1558430842), (1035, 1558430843), (1035, 1558430844)]


def test_order_stream(spark, tmp_path):
    orders = fixture_stream(spark, tmp_path, "order_id", schemas.ORDER_LOG, "0,none,,1600000000")
    got = finished(stream_jobs.order_sequences(orders, f"{tmp_path}/out", arrival="line"), spark)
    assert {r[0]: r[1] for r in got.groupBy("kind").count().collect()} == {"payed": 37, "timeout": 3}
    path = fixture_file("order_id")
    batch = jobs.order_sequences(read_records(spark, path, schemas.ORDER_LOG, arrival=True))
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.csv").write_text("t1,wechat,1500000000\n")
    stream = stream_records(spark, str(tmp_path / "in"), schemas.RECEIPT)
    query = sinks.run_available(sinks.to_console(stream, "receipts"), 60)
    assert query.exception() is None
