"""Every job on the driver tables. Intervals of seconds are widened to hours,
because the events of one user lie hours apart there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.event_time import DAY, MINUTE, SECOND, text_time
from ..functions.filters import has_transaction, is_behavior, is_not_behavior, is_page
from ..functions.reports import item_report, page_report
from ..operators.clicks import cap_clicks
from ..operators.late import tag_late
from ..session import SETTINGS
from ..sources.lines import parse_csv_lines, parse_web_log, rejected_csv_lines, rejected_lines
from ..streaming import incremental, sinks
from ..streaming.incremental import Incremental
from . import driver_tables as tables
from . import jobs, stream_jobs

HOUR_S, DAY_S = 3600, 86_400
LATENESS_S = 3 * HOUR_S
CLICK_LIMIT = 2
WAITS = {"pay_waits_s": 5 * HOUR_S, "receipt_waits_s": 3 * HOUR_S}
NEAR = {"receipt_before_s": 3 * HOUR_S, "receipt_after_s": 5 * HOUR_S}
SEQUENCE = {"first": tables.CREATE, "then": tables.PAY}
ORDER = {"create": tables.CREATE, "pay": tables.PAY}
IDS = {"pay_id": "arrival", "receipt_id": "arrival"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(on: Callable[[SparkSession, str], DataFrame] = tables.events):
    """Registers a function of the event table under its own name."""
    def register(plan: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return plan(on(spark, folder))

        QUERIES[plan.__name__] = run
        return plan

    return register


def prepare(spark: SparkSession) -> None:
    """Settings the results depend on, for sessions built elsewhere."""
    for name in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass",
                 "spark.sql.optimizer.windowGroupLimitThreshold"):
        spark.conf.set(name, SETTINGS[name])


def absent_as(df: DataFrame, value: int, *columns: str) -> DataFrame:
    """Keeps integer columns integers in clients that turn NULLs into floats."""
    return df.withColumns({c: F.coalesce(c, F.lit(value)) for c in columns})


MATCH_TIMES = ("pay_id", "pay_us", "receipt_id", "receipt_us")

# Records and filters

@query()
def behavior_lines(events):
    return tables.behavior_lines(events)


@query()
def csv_records(events):
    records = parse_csv_lines(tables.behavior_lines(events), schemas.USER_BEHAVIOR)
    return records.select(
        "user_id", "item_id", "category_id", "behavior", "epoch_s", F.unix_micros("ts").alias("us")
    )


@query()
def web_log_records(events):
    log = parse_web_log(tables.web_log_lines(events))
    return log.select("ip", "user_id", F.unix_millis("ts").alias("time_ms"), "method", "url")


@query()
def page_rows(events):
    log = parse_web_log(tables.web_log_lines(events)).where(is_page())
    return log.select("user_id", F.unix_millis("ts").alias("time_ms"), "url")


@query()
def view_rows(events):
    return tables.behaviors(events).where(is_behavior(tables.VIEW)).select("arrival", "user_id", "item_id")


@query()
def kept_market_rows(events):
    kept = tables.market_behaviors(events).where(is_not_behavior(tables.REMOVED))
    return kept.select("user_id", "behavior", "channel", F.unix_millis("ts").alias("time_ms"))


@query()
def paid_order_rows(events):
    return tables.order_logs(events).where(has_transaction()).select("arrival", "order_id", "tx_id")


# Windows and rankings

@query()
def item_views(events):
    return jobs.item_views(tables.behaviors(events), view=tables.VIEW)


@query()
def hot_items(events):
    return jobs.hot_items(tables.behaviors(events), view=tables.VIEW)


@query()
def hot_items_of_many(events):
    """Windows of a day, one per hour: candidates by sketches, counted exactly."""
    folder = sinks.shared_folder(events.sparkSession)
    return jobs.hot_items_of_many(tables.behaviors(events), folder, 3, DAY_S, HOUR_S, tables.VIEW)


@query()
def hot_items_report(events):
    return item_report(jobs.hot_items(tables.behaviors(events), view=tables.VIEW))


@query()
def page_views(events):
    return jobs.page_views(tables.behaviors(events), view=tables.VIEW)


@query()
def rejected_log_lines(events):
    """Some lines of the access log are cut short or carry a broken time."""
    return rejected_lines(tables.broken_log_lines(events), ("arrival",))


@query()
def unique_visitors(events):
    return jobs.unique_visitors(tables.behaviors(events), view=tables.VIEW)


@query()
def rejected_csv_records(events):
    """Some CSV lines are cut short or hold text in place of a number."""
    return rejected_csv_lines(tables.broken_behavior_lines(events), schemas.USER_BEHAVIOR, ("arrival",))


@query()
def sliding_visitors(events):
    """Windows of a day, one per hour, with whether the sketches come within 5 % of the exact count."""
    views = tables.behaviors(events)
    exact = jobs.sliding_visitors(views, DAY_S, HOUR_S, tables.VIEW)
    sketched = jobs.sliding_visitors(views, DAY_S, HOUR_S, tables.VIEW, approximate=True).withColumnRenamed("cnt", "about")
    near = F.abs(F.col("about") - F.col("cnt")) <= F.greatest(0.05 * F.col("cnt"), F.lit(1.0))
    return exact.join(sketched, "window_end", "full").select("window_end", "cnt", F.coalesce(near, F.lit(False)).alias("near"))


@query()
def hot_pages(events):
    return jobs.hot_pages(parse_web_log(tables.web_log_lines(events)))


@query()
def hot_pages_report(events):
    return page_report(jobs.hot_pages(parse_web_log(tables.web_log_lines(events))))


@query()
def channel_counts(events):
    """Over every window of one hour, one per five seconds, summed up by the hour of their ends."""
    return peaks_of(jobs.channel_windows(tables.market_behaviors(events), removed=tables.REMOVED), end_hour())


@query()
def channel_peaks(events):
    """Over every window of one hour, one per five seconds. Aggregates the times
    as numbers, which hash; only the few results become text."""
    return peaks_of(jobs.channel_windows(tables.market_behaviors(events), removed=tables.REMOVED))


def end_hour() -> Column:
    return F.expr(f"window_end div {HOUR_S * 1000}").alias("end_hour")


def peaks_of(counts: DataFrame, *parts: Column) -> DataFrame:
    peaks = counts.groupBy("channel", "behavior", *parts).agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("cnt").alias("total"),
        F.max("cnt").alias("peak"),
        F.min("window_end").alias("first_end"),
        F.max("window_end").alias("last_end"),
    )
    return peaks.select(
        "channel", "behavior", "windows", "total", "peak",
        text_time(F.col("first_end") * 1000 - HOUR_S * SECOND).alias("first_start"),
        text_time(F.col("last_end") * 1000).alias("last_end"),
    )


# Clicks

@query()
def click_cap(events):
    return cap_clicks(tables.ad_clicks(events), CLICK_LIMIT).select("arrival", "user_id", "ad_id", "kind")


@query()
def click_cap_strict(events):
    capped = cap_clicks(tables.ad_clicks(events), CLICK_LIMIT, strict=True)
    return capped.select("arrival", "user_id", "ad_id", "kind")


@query()
def click_cap_by_clock(events):
    """Days are those of the clock at which a click comes in, up to three hours after its event time."""
    capped = cap_clicks(
        tables.ad_clicks(tables.delayed(events), "arrived_us"), CLICK_LIMIT, arrival=("arrived_us", "arrival"), clock="arrived_us")
    return capped.select("arrival", "user_id", "ad_id", "kind")


@query()
def click_blacklist(events):
    return jobs.click_blacklist(tables.ad_clicks(events), CLICK_LIMIT)


@query()
def province_clicks(events):
    return jobs.province_clicks(tables.ad_clicks(events), CLICK_LIMIT)


@query()
def province_clicks_strict(events):
    return jobs.province_clicks(tables.ad_clicks(events), CLICK_LIMIT, strict=True)


# Sequences, orders, payments

@query()
def login_failures(events):
    return jobs.login_failures(tables.logins(events), DAY_S, fail=tables.FAIL)


@query()
def order_sequences(events):
    return absent_as(jobs.order_sequences(tables.order_logs(events), DAY_S, **SEQUENCE), -1, "then_us")


@query()
def order_states(events):
    return jobs.order_states(tables.order_logs(events), DAY_S, **ORDER)


@query()
def order_states_with_grace(events):
    return jobs.order_states(tables.order_logs(events), DAY_S, grace_s=DAY_S, **ORDER)


@query()
def payment_receipts(events):
    matches = jobs.payment_receipts(tables.order_logs(events), tables.receipts(events), **WAITS, **IDS)
    return absent_as(matches, -1, *MATCH_TIMES)


@query()
def payment_receipt_pairs(events):
    return jobs.payment_receipt_pairs(tables.order_logs(events), tables.receipts(events), **NEAR, **IDS)


# Late rows

@query()
def late_rows(events):
    rows = tables.delayed(events)
    tagged = tag_late(rows, F.col("arrived_us"), ["arrived_us", "arrival"], fine=MINUTE, coarse=DAY)
    return tagged.select("arrival", "user_id", "kind")


# The same on streams, in several micro-batches and to their end

@query(tables.closed_event_stream)
def stream_page_views(events):
    return sinks.table_of(stream_jobs.page_views(tables.behaviors(events), view=tables.VIEW))


def finished(job: Incremental, spark: SparkSession) -> DataFrame:
    sinks.run_available(job.writer)
    job.finish()
    return job.read(spark)


@query(tables.event_stream)
def stream_unique_visitors(events):
    spark = events.sparkSession
    return finished(stream_jobs.visitor_table(
        tables.behaviors(events), sinks.shared_folder(spark), view=tables.VIEW), spark)


@query(tables.event_stream)
def stream_hot_items(events):
    spark = events.sparkSession
    return finished(stream_jobs.hot_items(
        tables.behaviors(events), sinks.shared_folder(spark), view=tables.VIEW), spark)


@query(tables.event_stream)
def stream_hot_pages(events):
    """Windows of ten minutes, one per ten seconds, with corrections by rows up to a minute late."""
    spark = events.sparkSession
    return finished(stream_jobs.hot_pages(
        parse_web_log(tables.web_log_lines(events)), sinks.shared_folder(spark)), spark)


@query(tables.event_stream)
def stream_channel_counts(events):
    """Over every window of one hour, one per five seconds, summed up by the hour of their ends."""
    spark = events.sparkSession
    return peaks_of(finished(stream_jobs.channel_table(
        tables.market_behaviors(events), sinks.shared_folder(spark), removed=tables.REMOVED), spark), end_hour())


@query(tables.event_stream)
def stream_hot_items_report(events):
    spark = events.sparkSession
    return item_report(finished(stream_jobs.hot_items(
        tables.behaviors(events), sinks.shared_folder(spark), view=tables.VIEW), spark))


@query(tables.event_stream)
def stream_hot_pages_report(events):
    """Windows of ten minutes, one per ten seconds, with corrections by rows up to a minute late."""
    spark = events.sparkSession
    log = parse_web_log(tables.web_log_lines(events))
    return page_report(finished(stream_jobs.hot_pages(log, sinks.shared_folder(spark)), spark))


@query(tables.event_stream)
def stream_channel_peaks(events):
    """Over every window of one hour, one per five seconds."""
    spark = events.sparkSession
    return peaks_of(finished(stream_jobs.channel_table(
        tables.market_behaviors(events), sinks.shared_folder(spark), removed=tables.REMOVED), spark))


@query(tables.event_stream)
def stream_click_cap(events):
    spark = events.sparkSession
    job = stream_jobs.click_cap_table(tables.ad_clicks(events), sinks.shared_folder(spark), CLICK_LIMIT)
    return finished(job, spark).select("arrival", "user_id", "ad_id", "kind")


@query(tables.event_stream)
def stream_click_cap_strict(events):
    spark = events.sparkSession
    job = stream_jobs.click_cap_table(tables.ad_clicks(events), sinks.shared_folder(spark), CLICK_LIMIT, strict=True)
    return finished(job, spark).select("arrival", "user_id", "ad_id", "kind")


@query(tables.delayed_event_stream)
def stream_click_cap_by_clock(events):
    spark = events.sparkSession
    clicks = tables.ad_clicks(tables.delayed(events), "arrived_us").withColumn("came", F.struct("arrived_us", "arrival"))
    job = stream_jobs.click_cap_table(clicks, sinks.shared_folder(spark), CLICK_LIMIT, arrival="came", clock="arrived_us")
    return finished(job, spark).select("arrival", "user_id", "ad_id", "kind")


@query(tables.delayed_event_stream)
def stream_late_rows(events):
    spark = events.sparkSession
    job = incremental.tag_late(
        tables.delayed(events), sinks.shared_folder(spark), F.col("arrived_us"), ["arrived_us", "arrival"], MINUTE, DAY)
    return finished(job, spark).select("arrival", "user_id", "kind")


@query(tables.delayed_event_stream)
def stream_hot_pages_late(events):
    """Rows up to three hours late correct the rankings."""
    spark = events.sparkSession
    return finished(stream_jobs.hot_pages(
        parse_web_log(tables.web_log_lines(events)), sinks.shared_folder(spark), lateness_s=LATENESS_S), spark)


@query(tables.delayed_event_stream)
def stream_order_states_late(events):
    """Creates and pays up to three hours late still decide."""
    spark = events.sparkSession
    return finished(stream_jobs.order_states(
        tables.order_logs(events), sinks.shared_folder(spark), DAY_S, DAY_S, lateness_s=LATENESS_S, **ORDER), spark)


@query(tables.event_stream)
def stream_province_clicks(events):
    spark = events.sparkSession
    job = stream_jobs.province_click_table(tables.ad_clicks(events), sinks.shared_folder(spark), CLICK_LIMIT)
    return finished(job, spark)


@query(tables.event_stream)
def stream_click_cap_timers(events):
    """With keyed state and timers instead of tables."""
    capped = stream_jobs.capped_clicks(tables.ad_clicks(events), CLICK_LIMIT, seq="arrival")
    return sinks.table_of(capped).select("arrival", "user_id", "ad_id", "kind")


@query(tables.event_stream)
def stream_login_failures(events):
    spark = events.sparkSession
    return finished(stream_jobs.login_failures(
        tables.logins(events), sinks.shared_folder(spark), DAY_S, delay_s=0, fail=tables.FAIL), spark)


@query(tables.event_stream)
def stream_order_sequences(events):
    spark = events.sparkSession
    found = finished(stream_jobs.order_sequences(
        tables.order_logs(events), sinks.shared_folder(spark), DAY_S, **SEQUENCE), spark)
    return absent_as(found, -1, "then_us")


@query(tables.event_stream)
def stream_order_states(events):
    spark = events.sparkSession
    return finished(stream_jobs.order_states(
        tables.order_logs(events), sinks.shared_folder(spark), DAY_S, DAY_S, **ORDER), spark)


@query(tables.event_stream)
def stream_payment_receipts(events):
    spark = events.sparkSession
    matches = finished(stream_jobs.payment_receipts(
        tables.order_logs(events), tables.receipts(events), sinks.shared_folder(spark), **WAITS, **IDS), spark)
    return absent_as(matches, -1, *MATCH_TIMES)


@query(tables.event_stream)
def stream_payment_receipt_pairs(events):
    spark = events.sparkSession
    return finished(stream_jobs.payment_receipt_pair_table(
        tables.order_logs(events), tables.receipts(events), sinks.shared_folder(spark), **NEAR, **IDS), spark)
