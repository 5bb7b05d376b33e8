"""The analyses on streams of typed records: watermark, filter, operator. The
delays are those of the inputs: 0 for ascending times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import watermarked, where_watermarked
from ..functions.filters import has_transaction, is_behavior, is_not_behavior, is_page
from ..operators import clicks as click_cap
from ..operators.ranking import top_per_window
from ..streaming import clicks as stream_clicks
from ..streaming import detect, incremental, windows
from ..streaming.incremental import Incremental
from .jobs import FIVE_MINUTES_S, HOUR_S, REMOVED, VIEW


def item_views(
    behaviors: DataFrame, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW, delay_s: int = 0
) -> DataFrame:
    """To be ranked by ``sinks.to_top_per_window``."""
    views = where_watermarked(watermarked(behaviors, delay_s), is_behavior(view))
    return windows.sliding_counts(views, ["item_id"], size_s, slide_s)


def page_views(behaviors: DataFrame, size_s: int = HOUR_S, view: str = VIEW, delay_s: int = 0) -> DataFrame:
    views = where_watermarked(watermarked(behaviors, delay_s), is_behavior(view))
    return windows.tumbling_counts(views, [], size_s)


def unique_visitors(behaviors: DataFrame, size_s: int = HOUR_S, view: str = VIEW, delay_s: int = 0) -> DataFrame:
    views = where_watermarked(watermarked(behaviors, delay_s), is_behavior(view))
    return windows.distinct_per_window(views, "user_id", size_s)


def visitor_table(behaviors: DataFrame, path: str, size_s: int = HOUR_S, view: str = VIEW, delay_s: int = 0) -> Incremental:
    """The same as a table, without a row of Spark's state for each window and visitor."""
    return incremental.window_counts(
        behaviors, path, ["user_id"], size_s, size_s, delay_s, counted=is_behavior(view),
        change=lambda visitors: visitors.groupBy("window_end").agg(F.count(F.lit(1)).alias("cnt")))


def page_hits(
    log: DataFrame, size_s: int = 600, slide_s: int = 10, delay_s: int = 1, lateness_s: int = 60
) -> DataFrame:
    """Final counts, once rows up to ``lateness_s`` late have been counted in."""
    pages = where_watermarked(watermarked(log, delay_s + lateness_s), is_page())
    return windows.sliding_counts(pages, ["url"], size_s, slide_s)


def page_hit_updates(
    log: DataFrame, size_s: int = 600, slide_s: int = 10, delay_s: int = 1, lateness_s: int = 60
) -> DataFrame:
    """Counts as they change, for update mode; ``sinks.latest_counts`` keeps the last."""
    pages = where_watermarked(watermarked(log, delay_s + lateness_s), is_page())
    return windows.updating_counts(pages, ["url"], size_s, slide_s)


def hot_items(
    behaviors: DataFrame, path: str, k: int = 3, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW,
    delay_s: int = 0,
) -> Incremental:
    """The ranking of each window when it is over: ``window_end, rank, item_id, cnt``."""
    return incremental.window_counts(
        behaviors, path, ["item_id"], size_s, slide_s, delay_s, counted=is_behavior(view),
        change=lambda counts: top_per_window(counts, "item_id", k))


def hot_pages(
    log: DataFrame, path: str, k: int = 5, size_s: int = 600, slide_s: int = 10, delay_s: int = 1, lateness_s: int = 60
) -> Incremental:
    """The ranking of each window when it is over, and what late rows change in it."""
    return incremental.window_counts(
        log, path, ["url"], size_s, slide_s, delay_s, lateness_s, counted=is_page(),
        change=lambda counts: top_per_window(counts, "url", k))


def channel_table(
    behaviors: DataFrame, path: str, size_s: int = HOUR_S, slide_s: int = 5, removed: str = REMOVED, delay_s: int = 0
) -> Incremental:
    """Counts of every window when it is over, without copies of the rows, whatever the slide."""
    return incremental.window_counts(
        behaviors, path, ["channel", "behavior"], size_s, slide_s, delay_s, counted=is_not_behavior(removed))


def click_cap_table(
    clicks: DataFrame, path: str, limit: int = 100, strict: bool = False, delay_s: int = 0, **names
) -> Incremental:
    """The cap as a table that grows with each batch; for the clicks as a stream
    to go on with, see ``capped_clicks``."""
    return incremental.click_cap(clicks, path, limit, strict, delay_s, **names)


def province_click_table(
    clicks: DataFrame, path: str, limit: int = 100, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, **cap
) -> Incremental:
    """The cap and the counts per province; the capped clicks are in ``path`` too."""
    return incremental.capped_windows(clicks, path, "province", size_s, slide_s, limit, **cap)


def capped_clicks(clicks: DataFrame, limit: int = 100, strict: bool = False, delay_s: int = 0, **cap) -> DataFrame:
    """All clicks within the cap and the warnings, told apart by ``kind``."""
    return stream_clicks.cap_clicks(watermarked(clicks, delay_s), limit, strict, **cap)


def province_clicks(
    clicks: DataFrame, limit: int = 100, strict: bool = False, size_s: int = HOUR_S,
    slide_s: int = FIVE_MINUTES_S, delay_s: int = 0, **cap,
) -> DataFrame:
    kept = click_cap.passed(capped_clicks(clicks, limit, strict, delay_s, **cap))
    return windows.sliding_counts(kept, ["province"], size_s, slide_s)


def login_failures(logins: DataFrame, path: str, within_s: int = 5, delay_s: int = 6, **names) -> Incremental:
    return incremental.failures(logins, path, within_s, delay_s, **names)


def order_sequences(orders: DataFrame, path: str, within_s: int = 900, delay_s: int = 0, **names) -> Incremental:
    return incremental.sequences(orders, path, within_s, delay_s, **names)


def order_states(
    orders: DataFrame, path: str, within_s: int = 900, grace_s: int = 0, delay_s: int = 0, **names
) -> Incremental:
    """The state of each order as soon as it is decided; late creates and pays correct it."""
    return incremental.order_states(orders, path, within_s, grace_s, delay_s, **names)


def payment_receipts(orders: DataFrame, receipts: DataFrame, path: str, **options) -> Incremental:
    return incremental.matches(orders.where(has_transaction()), receipts, path, **options)


def payment_receipt_pairs(orders: DataFrame, receipts: DataFrame, delay_s: int = 0, **options) -> DataFrame:
    paid = where_watermarked(watermarked(orders, delay_s), has_transaction())
    return detect.interval_join(paid, watermarked(receipts, delay_s), **options)


def payment_receipt_pair_table(orders: DataFrame, receipts: DataFrame, path: str, **options) -> Incremental:
    """The pairs as a table, without the rows of both inputs in Spark's state."""
    return incremental.pairs(orders, receipts, path, counted=has_transaction(), **options)
