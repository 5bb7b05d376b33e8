"""The fixture files against the values in FIXTURES.md."""

from pyspark.sql import functions as F

from golden_files import fixture_file
from tidewatch import schemas
from tidewatch.operators.clicks import cap_clicks, passed
from tidewatch.plans import jobs
from tidewatch.sources.files import read_records


# A column only that file has.
CLICKS, LOGINS, ORDERS, RECEIPTS = "ad_id", "ip string", "order_id", "pay_channel"


def fixture(spark, column, layout):
    return read_records(spark, fixture_file(column), layout, arrival=True)


def test_row_counts(spark):
    for name, layout, rows in [
        (CLICKS, schemas.AD_CLICK, 143), (LOGINS, schemas.LOGIN, 51),
        (ORDERS, schemas.ORDER_LOG, 79), (RECEIPTS, schemas.RECEIPT, 40),
    ]:
        df = fixture(spark, name, layout)
        assert df.count() == rows
        assert df.where("ts is null").count() == 0


def test_click_cap(spark):
    clicks = fixture(spark, CLICKS, schemas.AD_CLICK)
    assert passed(cap_clicks(clicks, 100)).count() == 122
    assert passed(cap_clicks(clicks, 100, strict=True)).count() == 123
    warned = cap_clicks(clicks, 100).where("kind = 'warning'").collect()
    assert [(r.user_id, r.ad_id, r.epoch_s) for r in warned] == [(937166, 1715, 1511661701)]
    warned = cap_clicks(clicks, 100, strict=True).where("kind = 'warning'").collect()
    assert [r.epoch_s for r in warned] == [1511661702]
    assert [tuple(r) for r in jobs.click_blacklist(clicks).collect()] == [(937166, 1715, "Click over100times")]


def test_province_clicks(spark):
    out = jobs.province_clicks(fixture(spark, CLICKS, schemas.AD_CLICK))
    row = out.agg(F.count("*"), F.count_distinct("window_end"), F.sum("cnt")).first()
    assert tuple(row) == (99, 24, 1464)


def test_login_failures(spark):
    out = jobs.login_failures(fixture(spark, LOGINS, schemas.LOGIN)).orderBy("first_us").collect()
    assert [(r.user_id, r.first_us // 10**6, r.last_us // 10**6, r.msg) for r in out] == [
        (1035, 1558430842, 1558430843, "login fail"),
        (1035, 1558430843, 1558430844, "login fail"),
        (1035, 1558430844, 1558430845, "login fail"),
    ]


def test_order_states(spark):
    out = jobs.order_states(fixture(spark, ORDERS, schemas.ORDER_LOG))
    by_message = {r[0]: r[1] for r in out.groupBy("result_msg").count().collect()}
    assert by_message == {
        "payed successfully": 37, "payed but timeout": 1, "timeout": 2, "payed but not found create": 1
    }
    special = out.where("result_msg <> 'payed successfully'").select("order_id", "result_msg").collect()
    assert {tuple(r) for r in special} == {
        (34756, "payed but timeout"), (34767, "timeout"), (34768, "payed but not found create"), (34768, "timeout")
    }


def test_order_sequences(spark):
    out = jobs.order_sequences(fixture(spark, ORDERS, schemas.ORDER_LOG))
    assert {r[0]: r[1] for r in out.groupBy("kind").count().collect()} == {"payed": 37, "timeout": 3}
    late = out.where("order_id = 34767").first()
    assert late.result_msg == f"timeOut at{late.first_us // 1000 + 900_000}"


def test_payment_receipts(spark):
    orders = fixture(spark, ORDERS, schemas.ORDER_LOG)
    receipts = fixture(spark, RECEIPTS, schemas.RECEIPT)
    names = {"pay_id": "order_id", "receipt_id": "pay_channel"}
    out = jobs.payment_receipts(orders, receipts, **names)
    assert {r[0]: r[1] for r in out.groupBy("kind").count().collect()} == {
        "matched": 4, "unmatched_pay": 35, "unmatched_receipt": 36
    }
    wide = jobs.payment_receipts(orders, receipts, pay_waits_s=86400, receipt_waits_s=86400, **names)
    assert {r[0]: r[1] for r in wide.groupBy("kind").count().collect()} == {
        "matched": 37, "unmatched_pay": 2, "unmatched_receipt": 3
    }
    assert jobs.payment_receipt_pairs(orders, receipts, **names).count() == 4
