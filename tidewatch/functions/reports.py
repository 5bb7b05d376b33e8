"""Ranked text reports, one per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .event_time import text_time

# The wording of the reports.
RULE_ITEMS = "=================================="
RULE_PAGES = "=========================="
CLOSED_AT = "窗口关闭时间："
ITEM_LABELS = ("商品ID=", "浏览量=")
PAGE_LABELS = ("URL=", "访问量=")


def ranked_report(ranked: DataFrame, subject: str, rule: str, labels: tuple[str, str]) -> DataFrame:
    """``ranked`` holds the few top rows per window (``window_end`` in ms,
    ``rank``, ``subject``, ``cnt``), so the list per window is bounded."""
    entry = F.format_string(
        f"No%d:{labels[0]}%s{labels[1]}%d\n", F.col("rank"), F.col(subject).cast("string"), F.col("cnt")
    )
    title = F.concat(
        F.lit(f"{rule}\n{CLOSED_AT}"), text_time(F.col("window_end") * 1000), F.lit("\n")
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", entry.alias("line"))))
    return ranked.groupBy("window_end").agg(ordered.alias("lines")).select(
        "window_end",
        F.concat(title, F.array_join(F.transform("lines", lambda r: r["line"]), "")).alias("report"),
    )


def item_report(ranked: DataFrame) -> DataFrame:
    return ranked_report(ranked, "item_id", RULE_ITEMS, ITEM_LABELS)


def page_report(ranked: DataFrame) -> DataFrame:
    return ranked_report(ranked, "url", RULE_PAGES, PAGE_LABELS)
