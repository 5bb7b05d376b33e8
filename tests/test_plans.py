"""What the plans must look like to hold on large and skewed tables."""

import re

import pytest

import __spark_entry__ as entry
from golden_files import SMALL
from tidewatch.operators.windows import sliding_counts
from tidewatch.plans import queries as registered
from tidewatch.plans.oracles import ORACLES

BATCH = sorted(n for n in registered.QUERIES if not n.startswith("stream_"))


def plan(spark, name):
    df = entry.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_products_and_no_python(spark, name):
    text = plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|InPandas|BatchEvalPython|ArrowEval", text)
    assert "html" not in text and "value:double" not in text


@pytest.mark.parametrize("name,kind", [
    ("hot_items", "view"), ("page_views", "view"), ("unique_visitors", "view"), ("view_rows", "view"),
])
def test_filters_reach_the_file(spark, name, kind):
    assert re.search(rf"PushedFilters: \[.*EqualTo\(event_type,{kind}\)", plan(spark, name))


@pytest.mark.parametrize("name", ["hot_items", "hot_pages", "click_cap", "province_clicks"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    """From the top: final limit, shuffle, partial limit."""
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", plan(spark, name), re.S)


@pytest.mark.parametrize("name", ["item_views", "page_views", "channel_counts", "unique_visitors"])
def test_counts_start_before_the_shuffle(spark, name):
    lowest = plan(spark, name).split("Exchange")[-1]
    assert "partial_count" in lowest or "keys=[window_end" in lowest


def test_windows_are_not_copied_rows(spark):
    """No row is expanded to its windows below the first shuffle."""
    lowest = plan(spark, "channel_peaks").split("Exchange")[-1]
    assert "Expand" not in lowest and "Generate" not in lowest


@pytest.mark.parametrize("name", ["item_views", "channel_peaks", "province_clicks"])
def test_running_sums_are_spread_over_time(spark, name):
    assert re.search(r"Exchange hashpartitioning\([^)]*slice#", plan(spark, name))


def test_windows_without_keys_are_no_single_task(spark):
    events = registered.tables.events(spark, SMALL)
    counts = sliding_counts(events, [], 3600, 5)
    assert "SinglePartition" not in counts._jdf.queryExecution().executedPlan().toString()


def test_one_large_shuffle_per_ordered_job(spark):
    assert plan(spark, "login_failures").count("Exchange") == 1
    assert plan(spark, "order_sequences").count("Exchange") == 1


def test_order_states_share_their_shuffle(spark):
    df = entry.queries()["order_states"](spark, SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text.split("== Initial Plan")[0]


def test_every_query_has_its_sql():
    assert set(registered.QUERIES) == set(ORACLES)
    assert set(registered.QUERIES) <= set(entry.queries()) and ORACLES.items() <= entry.oracle_sql().items()
