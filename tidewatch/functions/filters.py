"""Row filters of the jobs, as column predicates Catalyst can push down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_behavior(kind: str, column: str = "behavior") -> Column:
    return F.col(column) == kind


def is_not_behavior(kind: str, column: str = "behavior") -> Column:
    return F.col(column) != kind


def has_transaction(column: str = "tx_id") -> Column:
    """CSV reads an empty field as NULL; both mean that no payment was made."""
    return F.col(column) != ""


def is_page(column: str = "url") -> Column:
    """Anything but a stylesheet or a script; ``a.js?v=1`` counts as a page."""
    return ~F.col(column).rlike(r"\.(css|js)$")
