"""The analyses, from typed records to results. Each takes and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.filters import has_transaction, is_behavior, is_not_behavior, is_page
from ..operators import clicks as click_cap
from ..operators.orders import order_results
from ..operators.ranking import top_by_sketches, top_per_window, top_sliding
from ..operators.reconcile import interval_join, match_one_to_one
from ..operators.sequences import followed_within, repeated_failures
from ..operators.windows import distinct_per_sliding_window, distinct_per_window, sliding_counts, tumbling_counts, with_window_texts

HOUR_S, FIVE_MINUTES_S = 3600, 300
# What the inputs call a page view and a removed app.
VIEW, REMOVED = "pv", "UNINSTALL"


def item_views(
    behaviors: DataFrame, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW
) -> DataFrame:
    return sliding_counts(behaviors.where(is_behavior(view)), ["item_id"], size_s, slide_s)


def hot_items(
    behaviors: DataFrame, k: int = 3, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW
) -> DataFrame:
    return top_per_window(item_views(behaviors, size_s, slide_s, view), "item_id", k)


def hot_items_of_many(
    behaviors: DataFrame, folder: str, k: int = 3, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW
) -> DataFrame:
    """``hot_items`` for catalogues without bound; ``folder`` takes the candidates."""
    return top_by_sketches(behaviors.where(is_behavior(view)), "item_id", k, size_s, slide_s, folder)


def page_views(behaviors: DataFrame, size_s: int = HOUR_S, view: str = VIEW) -> DataFrame:
    return tumbling_counts(behaviors.where(is_behavior(view)), [], size_s)


def unique_visitors(
    behaviors: DataFrame, size_s: int = HOUR_S, view: str = VIEW, approximate: bool = False
) -> DataFrame:
    return distinct_per_window(behaviors.where(is_behavior(view)), "user_id", size_s, approximate=approximate)


def sliding_visitors(
    behaviors: DataFrame, size_s: int = HOUR_S, slide_s: int = FIVE_MINUTES_S, view: str = VIEW, approximate: bool = False
) -> DataFrame:
    views = behaviors.where(is_behavior(view))
    return distinct_per_sliding_window(views, "user_id", size_s, slide_s, approximate=approximate)


def page_hits(log: DataFrame, size_s: int = 600, slide_s: int = 10) -> DataFrame:
    return sliding_counts(log.where(is_page()), ["url"], size_s, slide_s)


def hot_pages(log: DataFrame, k: int = 5, size_s: int = 600, slide_s: int = 10) -> DataFrame:
    return top_sliding(log.where(is_page()), "url", k, size_s, slide_s)


def channel_windows(
    behaviors: DataFrame, size_s: int = HOUR_S, slide_s: int = 5, removed: str = REMOVED
) -> DataFrame:
    """``channel, behavior, window_end, cnt``"""
    kept = behaviors.where(is_not_behavior(removed))
    return sliding_counts(kept, ["channel", "behavior"], size_s, slide_s)


def channel_counts(
    behaviors: DataFrame, size_s: int = HOUR_S, slide_s: int = 5, removed: str = REMOVED
) -> DataFrame:
    """``window_start, window_end`` (texts), ``channel, behavior, cnt``"""
    return with_window_texts(channel_windows(behaviors, size_s, slide_s, removed), size_s)


def province_clicks(
    clicks: DataFrame,
    limit: int = 100,
    strict: bool = False,
    size_s: int = HOUR_S,
    slide_s: int = FIVE_MINUTES_S,
    **cap,
) -> DataFrame:
    """Clicks per province within the cap: ``province, window_end, cnt``."""
    kept = click_cap.passed(click_cap.cap_clicks(clicks, limit, strict, **cap))
    return sliding_counts(kept, ["province"], size_s, slide_s)


def click_blacklist(clicks: DataFrame, limit: int = 100, strict: bool = False, **cap) -> DataFrame:
    return click_cap.warnings(click_cap.cap_clicks(clicks, limit, strict, **cap), limit)


def login_failures(logins: DataFrame, within_s: int = 5, **names) -> DataFrame:
    return repeated_failures(logins, within_s, **names)


def order_sequences(orders: DataFrame, within_s: int = 900, **names) -> DataFrame:
    return followed_within(orders, within_s, **names)


def order_states(orders: DataFrame, within_s: int = 900, **names) -> DataFrame:
    return order_results(orders, within_s, **names)


def payment_receipts(orders: DataFrame, receipts: DataFrame, **options) -> DataFrame:
    return match_one_to_one(orders.where(has_transaction()), receipts, **options)


def payment_receipt_pairs(orders: DataFrame, receipts: DataFrame, **options) -> DataFrame:
    return interval_join(orders.where(has_transaction()), receipts, **options)
