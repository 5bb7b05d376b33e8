"""The batch operators against plain loops on small random and edge inputs."""

import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.event_time import SECOND, with_event_time
from tidewatch.functions.filters import has_transaction, is_page
from tidewatch.functions.reports import item_report
from tidewatch.operators import windows
from tidewatch.operators.clicks import cap_clicks
from tidewatch.operators.late import tag_late
from tidewatch.operators.orders import order_results
from tidewatch.operators.ranking import _most_missed, top_by_sketches, top_per_window, top_sliding
from tidewatch.operators.reconcile import interval_join, match_one_to_one
from tidewatch.operators.sequences import followed_within, repeated_failures

BASE = 1_500_000_000 * SECOND


def table(spark, records, columns):
    return spark.createDataFrame(pd.DataFrame(records, columns=columns)).withColumn("ts", F.timestamp_micros("us"))


def some(n, kinds, span_s, seed, start=BASE, hot=0.5):
    """Rows ``key, kind, us, seq``; key 0 holds about ``hot`` of them."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < hot else rng.randint(1, 4), rng.choice(kinds),
         start + rng.randint(0, span_s * 2) * SECOND // 2, seq)
        for seq, _ in enumerate(range(n))
    ]


def by_key(records):
    groups = defaultdict(list)
    for r in sorted(records, key=lambda r: (r[2], r[3])):
        groups[r[0]].append(r)
    return groups


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("start", [BASE, -3000 * SECOND])
@pytest.mark.parametrize("size_s,slide_s", [(600, 60), (60, 60), (600, 10), (100, 30)])
def test_sliding_counts(spark, size_s, slide_s, start):
    records = some(300, ["a", "b"], 6000, 1, start)
    got = windows.sliding_counts(table(spark, records, ["key", "kind", "us", "seq"]), ["key", "kind"], size_s, slide_s)
    want = defaultdict(int)
    for key, kind, us, _ in records:
        end = us // (slide_s * SECOND) * slide_s * SECOND + slide_s * SECOND
        # From the first window end after the row, while the window still reaches back to it.
        while end - size_s * SECOND <= us:
            want[key, kind, end // 1000] += 1
            end += slide_s * SECOND
    # A slide that does not divide the size: ends are aligned starts plus the size.
    if size_s % slide_s:
        want = defaultdict(int)
        for key, kind, us, _ in records:
            begin = us // (slide_s * SECOND) * slide_s * SECOND
            while begin + size_s * SECOND > us:
                want[key, kind, (begin + size_s * SECOND) // 1000] += 1
                begin -= slide_s * SECOND
    assert rows(got, "key", "kind", "window_end", "cnt") == sorted(
        ((*k, n) for k, n in want.items()), key=repr)


def test_tumbling_and_distinct(spark):
    records = some(400, ["a"], 7000, 2)
    df = table(spark, records, ["key", "kind", "us", "seq"])
    count, users = defaultdict(int), defaultdict(set)
    for key, _, us, _ in records:
        end = (us // (3600 * SECOND) + 1) * 3_600_000
        count[end] += 1
        users[end].add(key)
    assert rows(windows.tumbling_counts(df, [], 3600), "window_end", "cnt") == sorted(count.items())
    want = sorted((e, len(u)) for e, u in users.items())
    assert rows(windows.distinct_per_window(df, "key", 3600), "window_end", "cnt") == want
    assert rows(windows.distinct_per_window(df, "key", 3600, approximate=True), "window_end", "cnt") == want


def test_top_and_report(spark):
    counts = spark.createDataFrame(
        [(1000, 7, 5), (1000, 3, 5), (1000, 9, 8), (1000, 1, 1), (2000, 4, 2)], "window_end long, item_id long, cnt long")
    top = top_per_window(counts, "item_id", 3)
    assert rows(top, "*") == [(1000, 1, 9, 8), (1000, 2, 3, 5), (1000, 3, 7, 5), (2000, 1, 4, 2)]
    reports = {r.window_end: r.report for r in item_report(top).collect()}
    assert reports[1000] == (
        "==================================\n窗口关闭时间：1970-01-01 00:00:01.0\n"
        "No1:商品ID=9浏览量=8\nNo2:商品ID=3浏览量=5\nNo3:商品ID=7浏览量=5\n")


def plain_top(records, k, size_s, slide_s):
    """From rows ``subject, us``."""
    counts = defaultdict(lambda: defaultdict(int))
    for subject, us in records:
        end = us // (slide_s * SECOND) * slide_s * SECOND + slide_s * SECOND
        while subject is not None and end - size_s * SECOND <= us:
            counts[end // 1000][subject] += 1
            end += slide_s * SECOND
    return sorted((end, rank, s, n) for end, of in counts.items()
                  for rank, (s, n) in enumerate(sorted(of.items(), key=lambda x: (-x[1], x[0]))[:k], 1))


@pytest.mark.parametrize("tracked,named", [(500, None), (40, 10), (12, 3)])
@pytest.mark.parametrize("text", [False, True])
def test_top_by_sketches(spark, tmp_path, tracked, named, text):
    """Many rare subjects and few frequent ones, windows of ties alone, rows without subject, few counters and many."""
    rng = random.Random(tracked)
    records = []
    for window in range(6):
        # The first windows have clear winners, the others only subjects of about one row each.
        for _ in range(1500):
            subject = rng.choice([None, 1, 1, 1, 2, 2, 2, 3, 3]) if window < 3 and rng.random() < 0.6 else rng.randint(10, 5000)
            records.append((subject, BASE + window * 1200 * SECOND + rng.randrange(600 * SECOND)))
    records = [(f"/{s:04d}" if text and s is not None else s, us) for s, us in records]
    df = spark.createDataFrame(records, f"subject {'string' if text else 'long'}, us long").withColumn("ts", F.timestamp_micros("us"))
    got = top_by_sketches(df, "subject", 3, 600, 60, str(tmp_path), tracked=tracked, candidates=named)
    want = plain_top(records, 3, 600, 60)
    assert rows(got, "window_end", "rank", "subject", "cnt") == sorted(want, key=repr)
    assert rows(got, "window_end", "rank", "subject", "cnt") == rows(
        top_sliding(df.where("subject is not null"), "subject", 3, 600, 60), "window_end", "rank", "subject", "cnt")


def test_top_by_sketches_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, 0)], "subject long, us long").withColumn("ts", F.timestamp_micros("us"))
    assert top_by_sketches(df, "subject", 3, 600, 60, f"{tmp_path}/null").count() == 0
    assert top_by_sketches(df.limit(0), "subject", 3, 600, 60, f"{tmp_path}/empty").columns == ["window_end", "rank", "subject", "cnt"]
    for wrong in ({"size_s": 100, "slide_s": 30}, {"tracked": 5000}, {"candidates": 2}):
        with pytest.raises(ValueError):
            top_by_sketches(df, "subject", 3, folder=f"{tmp_path}/wrong", **{"size_s": 600, "slide_s": 60, **wrong})


@pytest.mark.parametrize("tracked", [12, 100, 700])
def test_no_frequent_subject_is_missed(spark, tracked):
    """The bound that says which windows are sure, on 200 sketches of panes put together."""
    rng = random.Random(tracked)
    drawn = [(int(rng.paretovariate(0.7)) % 100_000, i % 200) for i in range(100_000)]
    df = spark.createDataFrame(pd.DataFrame(drawn, columns=["subject", "pane"]))
    panes = df.groupBy("pane").agg(F.expr(f"approx_top_k_accumulate(subject, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    united = panes.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    named = min(tracked, 20)
    found = united.select("n", F.expr(f"approx_top_k_estimate(sketch, {named})").alias("found"))
    row = found.select("found.item", _most_missed(tracked, named).alias("missed")).first()
    counts = defaultdict(int)
    for subject, _ in drawn:
        counts[subject] += 1
    assert max(n for s, n in counts.items() if s not in row["item"]) <= row["missed"] < len(drawn)


def test_window_texts(spark):
    counts = spark.createDataFrame([(1_511_658_300_000, "a", 4)], "window_end long, channel string, cnt long")
    assert rows(windows.with_window_texts(counts, 3600), "*") == [
        ("2017-11-26 00:05:00.0", "2017-11-26 01:05:00.0", "a", 4)]


def test_page_filter(spark):
    urls = ["/a", "/a.css", "/a.js", "/a.js?v=1", "/css", "/a.css/b", "/a.jsx", "/x.js.css", ".js", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url for r in df.where(is_page()).collect()} == {"/a", "/a.js?v=1", "/css", "/a.css/b", "/a.jsx", ""}


def test_transaction_filter(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "tx_id string")
    assert [r.tx_id for r in df.where(has_transaction()).collect()] == ["a"]


def test_event_time_units(spark):
    seconds = with_event_time(spark.createDataFrame([(5,)], "epoch_s long"))
    millis = with_event_time(spark.createDataFrame([(5001,)], "epoch_ms long"))
    assert seconds.select(F.unix_micros("ts")).first()[0] == 5_000_000
    assert millis.select(F.unix_micros("ts")).first()[0] == 5_001_000


@pytest.mark.parametrize("limit,strict", [(1, False), (3, False), (3, True), (1500, False)])
def test_click_cap(spark, limit, strict):
    records = some(800, ["x", "y"], 3 * 86_400, 3)
    df = table(spark, records, ["user_id", "ad_id", "us", "arrival"])
    want, seen = [], defaultdict(int)
    allowed = limit + strict
    for user, ad, us, seq in records:
        place = (user, ad, us // (86_400 * SECOND))
        seen[place] += 1
        if seen[place] <= allowed:
            want.append((seq, "pass"))
        elif seen[place] == allowed + 1:
            want.append((seq, "warning"))
    assert rows(cap_clicks(df, limit, strict), "arrival", "kind") == sorted(want, key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_failures(spark, seed):
    records = some(700, ["fail", "fail", "ok"], 1500, seed)
    want = []
    for key, group in by_key(records).items():
        for a, b in zip(group, group[1:]):
            if a[1] == b[1] == "fail" and b[2] - a[2] < 5 * SECOND:
                want.append((key, a[2], b[2]))
    df = table(spark, records, ["user_id", "event_type", "us", "arrival"])
    assert rows(repeated_failures(df), "user_id", "first_us", "last_us") == sorted(want, key=repr)
    assert len(want) > 50


def test_failure_limit(spark):
    records = [(1, "fail", BASE, 0), (1, "fail", BASE + 5 * SECOND, 1), (1, "fail", BASE + 10 * SECOND - 1, 2),
               (2, "fail", BASE, 3), (2, "ok", BASE + SECOND, 4), (2, "fail", BASE + 2 * SECOND, 5)]
    df = table(spark, records, ["user_id", "event_type", "us", "arrival"])
    assert rows(repeated_failures(df), "user_id", "first_us") == [(1, BASE + 5 * SECOND)]


@pytest.mark.parametrize("seed", [6, 7])
def test_followed_within(spark, seed):
    records = some(500, ["create", "pay", "other"], 30_000, seed)
    want = []
    for key, group in by_key(records).items():
        for i, (_, kind, us, _) in enumerate(group):
            if kind != "create":
                continue
            pay = next((r[2] for r in group[i + 1:] if r[1] == "pay"), None)
            if pay is not None and pay - us < 900 * SECOND:
                want.append((key, "payed", us, pay, "payed successfully"))
            else:
                want.append((key, "timeout", us, None, f"timeOut at{us // 1000 + 900_000}"))
    df = table(spark, records, ["order_id", "event_type", "us", "arrival"])
    assert rows(followed_within(df), "*") == sorted(want, key=repr)


def brute_orders(records, within, grace):
    out = []
    for key, group in by_key(records).items():
        opened = None
        for _, kind, us, _ in group:
            if opened is not None and grace is not None and us - opened >= within + grace:
                out.append((key, opened, "timeout"))
                opened = None
            if kind == "create":
                if opened is not None and us - opened >= within:
                    out.append((key, opened, "timeout"))
                opened = us
            elif kind == "pay":
                if opened is None:
                    out.append((key, us, "payed but not found create"))
                else:
                    out.append((key, us, "payed successfully" if us - opened < within else "payed but timeout"))
                opened = None
        if opened is not None:
            out.append((key, opened, "timeout"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("grace_s,slice_s", [(None, 60), (None, 10**6), (0, 600), (300, 60)])
def test_order_results(spark, grace_s, slice_s):
    records = some(600, ["create", "pay", "other"], 60_000, 8)
    want = brute_orders(records, 900 * SECOND, None if grace_s is None else grace_s * SECOND)
    df = table(spark, records, ["order_id", "event_type", "us", "arrival"])
    got = order_results(df, grace_s=grace_s, slice_s=slice_s)
    assert rows(got, "order_id", "us", "result_msg") == want
    assert {r[2] for r in want} >= {"timeout", "payed successfully", "payed but not found create"}


def test_order_limit(spark):
    at = 900 * SECOND
    records = [(1, "create", BASE, 0), (1, "pay", BASE + at - 1, 1), (2, "create", BASE, 2), (2, "pay", BASE + at, 3),
               (3, "pay", BASE, 4), (3, "create", BASE + SECOND, 5), (4, "create", BASE, 6)]
    df = table(spark, records, ["order_id", "event_type", "us", "arrival"])
    assert rows(order_results(df), "order_id", "result_msg") == [
        (1, "payed successfully"), (2, "payed but timeout"),
        (3, "payed but not found create"), (3, "timeout"), (4, "timeout")]
    assert rows(followed_within(df), "order_id", "kind") == [
        (1, "payed"), (2, "timeout"), (3, "timeout"), (4, "timeout")]


def split(spark, records):
    df = table(spark, records, ["tx_id", "kind", "us", "id"])
    return (df.where("kind = 'pay'").withColumnRenamed("id", "pay_id"),
            df.where("kind = 'receipt'").withColumnRenamed("id", "receipt_id"))


def brute_matches(records):
    out = []
    groups = defaultdict(list)
    for r in sorted(records, key=lambda r: (r[2], r[1] == "receipt", r[3])):
        groups[r[0]].append(r)
    for key, group in groups.items():
        held = None

        def alone(r):
            if r[1] == "pay":
                out.append((key, "unmatched_pay", r[3], r[2], None, None))
            else:
                out.append((key, "unmatched_receipt", None, None, r[3], r[2]))

        for r in group:
            if held and r[2] - held[2] > (5 if held[1] == "pay" else 3) * SECOND:
                alone(held)
                held = None
            if held and held[1] != r[1]:
                pay, receipt = (held, r) if r[1] == "receipt" else (r, held)
                out.append((key, "matched", pay[3], pay[2], receipt[3], receipt[2]))
                held = None
            else:
                if held:
                    alone(held)
                held = r
        if held:
            alone(held)
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,span_s,hot", [(600, 900, 0.5), (1500, 700, 0.9), (60, 5000, 0.2)])
def test_match_one_to_one(spark, n, span_s, hot):
    records = some(n, ["pay", "receipt"], span_s, n, hot=hot)
    got = match_one_to_one(*split(spark, records))
    want = brute_matches(records)
    assert rows(got, "*") == want
    assert sum(2 if r[1] == "matched" else 1 for r in want) == n


def test_match_long_alternation(spark):
    """The position counts on over many slices without a new start."""
    records = [(1, "receipt" if i % 2 else "pay", BASE + i * 4 * SECOND // 2, i) for i in range(401)]
    got = rows(match_one_to_one(*split(spark, records)), "*")
    assert got == brute_matches(records)
    assert sum(r[1] == "matched" for r in got) == 200


def test_match_limits(spark):
    records = [("a", "pay", BASE, 1), ("a", "receipt", BASE + 5 * SECOND, 2),
               ("b", "pay", BASE, 3), ("b", "receipt", BASE + 5 * SECOND + 1, 4),
               ("c", "receipt", BASE, 5), ("c", "pay", BASE + 3 * SECOND, 6),
               ("d", "receipt", BASE, 7), ("d", "pay", BASE + 3 * SECOND + 1, 8)]
    kinds = rows(match_one_to_one(*split(spark, records)), "tx_id", "kind")
    assert kinds == [("a", "matched"), ("b", "unmatched_pay"), ("b", "unmatched_receipt"), ("c", "matched"),
                     ("d", "unmatched_pay"), ("d", "unmatched_receipt")]
    assert rows(interval_join(*split(spark, records)), "tx_id") == [("a",), ("c",)]


def test_interval_join(spark):
    records = some(500, ["pay", "receipt"], 600, 9)
    want = sorted(
        ((p[0], p[3], r[3]) for p in records for r in records
         if p[1] == "pay" and r[1] == "receipt" and p[0] == r[0] and -3 * SECOND <= r[2] - p[2] <= 5 * SECOND),
        key=repr)
    got = interval_join(*split(spark, records))
    assert rows(got, "tx_id", "pay_id", "receipt_id") == want and len(want) > 200


@pytest.mark.parametrize("fine,coarse", [(1, 10), (7, 35), (50, 1000), (1000, 1000)])
def test_tag_late(spark, fine, coarse):
    rng = random.Random(10)
    records = [(i, BASE + i * 5 * SECOND - rng.choice([0, 0, 0, 400]) * SECOND - rng.randint(0, 400) * SECOND)
               for i in range(400)]
    df = table(spark, records, ["arrival", "us"])
    got = tag_late(df, F.col("arrival"), ["arrival"], fine, coarse, 60, 10, 1, 60)
    want, top = [], None
    for i, us in records:
        closes = us // (10 * SECOND) * 10 * SECOND + 60 * SECOND - 1000 + 60 * SECOND
        want.append((i, "late" if top is not None and closes <= top - SECOND else "on_time"))
        top = us if top is None else max(top, us)
    assert rows(got, "arrival", "kind") == sorted(want, key=repr)
    assert {k for _, k in want} == {"late", "on_time"}
