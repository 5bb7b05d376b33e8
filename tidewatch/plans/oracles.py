"""The same questions as plain SQL for DuckDB, written against the definitions
and not against the plans: rows copied into windows, whole keys in one frame."""

from __future__ import annotations

from .queries import CLICK_LIMIT, DAY_S, HOUR_S, MATCH_TIMES, NEAR, WAITS

S = 1_000_000
HOUR, DAY = HOUR_S * S, DAY_S * S

EVENTS = """ev AS (
  SELECT event_id AS arrival, ts, epoch_us(ts) AS us, user_id, event_type,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events)"""
BEHAVIORS = """beh AS (
  SELECT *, k AS item_id, CAST(k % 5 AS INTEGER) AS category_id, event_type AS behavior FROM ev)"""
MARKET = """mkt AS (
  SELECT *, event_type AS behavior, 'store' || (k % 5) AS channel FROM ev)"""
LOG = """weblog AS (
  SELECT '10.0.0.' || k AS ip, CAST(user_id AS VARCHAR) AS user_id, us // 1000000 * 1000000 AS us,
         CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' || k || CASE k % 10 WHEN 0 THEN '.css' WHEN 1 THEN '.js'
           WHEN 2 THEN '.js?v=1' ELSE '' END AS url FROM ev)"""
CLICKS = """clk AS (SELECT *, k // 50 AS ad_id, 'province' || (k % 5) AS province FROM ev)"""
ORDERS = """ord AS (
  SELECT arrival, us, user_id AS order_id, CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS kind,
         CASE event_type WHEN 'purchase' THEN 'tx' || user_id ELSE '' END AS tx_id
  FROM ev WHERE event_type IN ('signup', 'purchase'))"""
RECEIPTS = """rec AS (SELECT arrival, us, 'tx' || user_id AS tx_id FROM ev WHERE event_type = 'click')"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _ends(size_s: int, slide_s: int) -> str:
    """The ends of all windows that hold the time ``us``."""
    return f"unnest([(us // {slide_s * S} + 1 + i) * {slide_s * S} FOR i IN range({size_s // slide_s})])"


def _counts(source: str, keys: str, size_s: int, slide_s: int, where: str = "TRUE") -> str:
    return f"""cnts AS (
  SELECT {keys}, w_end, count(*) AS cnt
  FROM (SELECT {keys}, {_ends(size_s, slide_s)} AS w_end FROM {source} WHERE {where}) GROUP BY ALL)"""


def _ranked(subject: str, k: int) -> str:
    return f"""ranked AS (
  SELECT w_end // 1000 AS window_end, CAST(rank AS INTEGER) AS rank, {subject}, cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY w_end ORDER BY cnt DESC, {subject}) AS rank FROM cnts)
  WHERE rank <= {k})"""


def _text(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d %H:%M:%S') || '.0'"


def _report(subject: str, rule: str, label: str, count_label: str) -> str:
    return f"""SELECT window_end,
  '{rule}' || chr(10) || '窗口关闭时间：' || {_text('window_end * 1000')} || chr(10)
  || string_agg('No' || rank || ':{label}' || {subject} || '{count_label}' || cnt || chr(10), '' ORDER BY rank) AS report
FROM ranked GROUP BY window_end"""


PV = "behavior = 'view'"
PAGES = "NOT regexp_matches(url, '\\.(css|js)$')"
KEPT = "behavior <> 'error'"

ITEM_COUNTS = _counts("beh", "item_id", HOUR_S, 300, PV)
CHANNEL_COUNTS = _counts("mkt", "channel, behavior", HOUR_S, 5, KEPT)


def _capped(allowed: int) -> str:
    return f"""capped AS (
  SELECT *, CASE WHEN nth <= {allowed} THEN 'pass' ELSE 'warning' END AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, us // {DAY} ORDER BY arrival) AS nth FROM clk)
  WHERE nth <= {allowed} + 1)"""


def _provinces(allowed: int) -> str:
    return _with(EVENTS, CLICKS, _capped(allowed), _counts("capped", "province", HOUR_S, 300, "kind = 'pass'")) + (
        "SELECT province, w_end // 1000 AS window_end, cnt FROM cnts")


CAP_ROWS = "SELECT arrival, user_id, ad_id, kind FROM capped"
FAILURES = f"""fails AS (
  SELECT user_id, us AS first_us, next_us AS last_us, 'login fail' AS msg FROM (
    SELECT *, lead(event_type) OVER w AS next_type, lead(us) OVER w AS next_us FROM ev
    WINDOW w AS (PARTITION BY user_id ORDER BY us, arrival))
  WHERE event_type = 'error' AND next_type = 'error' AND next_us - us < {DAY})"""
SEQUENCES = f"""seqs AS (
  SELECT order_id, CASE WHEN ok THEN 'payed' ELSE 'timeout' END AS kind, us AS first_us,
         CASE WHEN ok THEN pay_us END AS then_us,
         CASE WHEN ok THEN 'payed successfully' ELSE 'timeOut at' || ((us + {DAY}) // 1000) END AS result_msg
  FROM (SELECT *, coalesce(pay_us - us < {DAY}, FALSE) AS ok FROM (
    SELECT *, min(CASE WHEN kind = 'pay' THEN us END) OVER (
      PARTITION BY order_id ORDER BY us, arrival ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us
    FROM ord) WHERE kind = 'create'))"""


def _states(kept: str) -> str:
    """``kept``: how long an order stays open for a late pay, as a condition on {gap}."""
    back, ahead = kept.format(gap="us - p_us"), kept.format(gap="n_us - us")
    return f"""states AS (
  SELECT order_id, us, n_us, n_kind, result_msg FROM (
    SELECT *, CASE
      WHEN kind = 'pay' AND coalesce(p_kind = 'create' AND {back}, FALSE)
        THEN CASE WHEN us - p_us < {DAY} THEN 'payed successfully' ELSE 'payed but timeout' END
      WHEN kind = 'pay' THEN 'payed but not found create'
      WHEN coalesce(n_kind = 'pay' AND {ahead}, FALSE) THEN NULL
      WHEN coalesce(n_kind = 'create' AND n_us - us < {DAY}, FALSE) THEN NULL
      ELSE 'timeout' END AS result_msg
    FROM (SELECT *, lag(kind) OVER w AS p_kind, lag(us) OVER w AS p_us,
                 lead(kind) OVER w AS n_kind, lead(us) OVER w AS n_us
          FROM ord WINDOW w AS (PARTITION BY order_id ORDER BY us, arrival)))
  WHERE result_msg IS NOT NULL)"""


STATES = _states("TRUE")
STATES_GRACE = _states(f"{{gap}} < {2 * DAY}")
PAY_WAIT, RECEIPT_WAIT = WAITS["pay_waits_s"] * S, WAITS["receipt_waits_s"] * S
# One row waits per transaction: count from the latest row that cannot match its predecessor.
MATCHES = f"""both_sides AS (
  SELECT tx_id, us, FALSE AS is_rec, arrival AS id FROM ord WHERE tx_id <> ''
  UNION ALL SELECT tx_id, us, TRUE, arrival FROM rec),
nb AS (
  SELECT *, lag(us) OVER w AS p_us, lag(is_rec) OVER w AS p_rec, lag(id) OVER w AS p_id,
         lead(us) OVER w AS n_us, lead(is_rec) OVER w AS n_rec,
         CASE WHEN is_rec THEN {RECEIPT_WAIT} ELSE {PAY_WAIT} END AS wait,
         row_number() OVER w AS n
  FROM both_sides WINDOW w AS (PARTITION BY tx_id ORDER BY us, is_rec, id)),
st AS (
  SELECT *, coalesce(p_rec = is_rec OR us - p_us > CASE WHEN p_rec THEN {RECEIPT_WAIT} ELSE {PAY_WAIT} END, TRUE)
    AS starts, coalesce(n_rec = is_rec OR n_us - us > wait, TRUE) AS next_starts FROM nb),
pos AS (
  SELECT *, n - max(CASE WHEN starts THEN n END) OVER (PARTITION BY tx_id ORDER BY n) AS place FROM st),
matches AS (
  SELECT *, CASE WHEN place % 2 = 1 THEN 'matched' WHEN is_rec THEN 'unmatched_receipt' ELSE 'unmatched_pay' END AS kind,
    CASE WHEN NOT is_rec THEN id WHEN place % 2 = 1 THEN p_id END AS pay_id,
    CASE WHEN NOT is_rec THEN us WHEN place % 2 = 1 THEN p_us END AS pay_us,
    CASE WHEN is_rec THEN id WHEN place % 2 = 1 THEN p_id END AS receipt_id,
    CASE WHEN is_rec THEN us WHEN place % 2 = 1 THEN p_us END AS receipt_us
  FROM pos WHERE place % 2 = 1 OR next_starts)"""
MATCH_COLUMNS = "tx_id, kind, " + ", ".join(f"coalesce({c}, -1) AS {c}" for c in MATCH_TIMES)
SEQUENCE_COLUMNS = "order_id, kind, first_us, coalesce(then_us, -1) AS then_us, result_msg"
PAIRS = _with(EVENTS, ORDERS, RECEIPTS) + f"""SELECT o.tx_id, o.arrival AS pay_id, o.us AS pay_us,
  r.arrival AS receipt_id, r.us AS receipt_us
FROM ord o JOIN rec r ON o.tx_id = r.tx_id AND o.tx_id <> ''
  AND r.us - o.us BETWEEN -{NEAR['receipt_before_s'] * S} AND {NEAR['receipt_after_s'] * S}"""
CHANNEL_SUMS = f"""SELECT channel, behavior, count(*) AS windows, CAST(sum(cnt) AS BIGINT) AS total, max(cnt) AS peak,
  {_text(f'min(w_end) - {HOUR}')} AS first_start, {_text('max(w_end)')} AS last_end
FROM cnts GROUP BY channel, behavior"""


ORACLES: dict[str, str] = {
    "behavior_lines": _with(EVENTS, BEHAVIORS) + """SELECT user_id || ',' || item_id || ',' || category_id || ','
  || behavior || ',' || (us // 1000000) AS value FROM beh""",
    "csv_records": _with(EVENTS, BEHAVIORS) + """SELECT user_id, item_id, category_id, behavior,
  us // 1000000 AS epoch_s, us // 1000000 * 1000000 AS us FROM beh""",
    "web_log_records": _with(EVENTS, LOG) + "SELECT ip, user_id, us // 1000 AS time_ms, method, url FROM weblog",
    "page_rows": _with(EVENTS, LOG) + f"SELECT user_id, us // 1000 AS time_ms, url FROM weblog WHERE {PAGES}",
    "view_rows": _with(EVENTS, BEHAVIORS) + f"SELECT arrival, user_id, item_id FROM beh WHERE {PV}",
    "kept_market_rows": _with(EVENTS, MARKET) + f"""SELECT CAST(user_id AS VARCHAR) AS user_id, behavior, channel,
  us // 1000 AS time_ms FROM mkt WHERE {KEPT}""",
    "paid_order_rows": _with(EVENTS, ORDERS) + "SELECT arrival, order_id, tx_id FROM ord WHERE tx_id <> ''",
    "item_views": _with(EVENTS, BEHAVIORS, ITEM_COUNTS) + "SELECT item_id, w_end // 1000 AS window_end, cnt FROM cnts",
    "hot_items": _with(EVENTS, BEHAVIORS, ITEM_COUNTS, _ranked("item_id", 3)) + "SELECT * FROM ranked",
    "hot_items_of_many": _with(EVENTS, BEHAVIORS, _counts("beh", "item_id", DAY_S, HOUR_S, PV), _ranked("item_id", 3)) + "SELECT * FROM ranked",
    "hot_items_report": _with(EVENTS, BEHAVIORS, ITEM_COUNTS, _ranked("item_id", 3)) + _report(
        "item_id", "=" * 34, "商品ID=", "浏览量="),
    "page_views": _with(EVENTS, BEHAVIORS) + f"""SELECT (us // {HOUR} + 1) * {HOUR} // 1000 AS window_end,
  count(*) AS cnt FROM beh WHERE {PV} GROUP BY 1""",
    "unique_visitors": _with(EVENTS, BEHAVIORS) + f"""SELECT (us // {HOUR} + 1) * {HOUR} // 1000 AS window_end,
  count(DISTINCT user_id) AS cnt FROM beh WHERE {PV} GROUP BY 1""",
    "hot_pages": _with(EVENTS, LOG, _counts("weblog", "url", 600, 10, PAGES), _ranked("url", 5))
    + "SELECT * FROM ranked",
    "hot_pages_report": _with(EVENTS, LOG, _counts("weblog", "url", 600, 10, PAGES), _ranked("url", 5)) + _report(
        "url", "=" * 26, "URL=", "访问量="),
    "channel_counts": _with(EVENTS, MARKET, CHANNEL_COUNTS) + CHANNEL_SUMS + f", w_end // {HOUR}",
    "channel_peaks": _with(EVENTS, MARKET, CHANNEL_COUNTS) + CHANNEL_SUMS,
    "click_cap": _with(EVENTS, CLICKS, _capped(CLICK_LIMIT)) + CAP_ROWS,
    "click_cap_strict": _with(EVENTS, CLICKS, _capped(CLICK_LIMIT + 1)) + CAP_ROWS,
    "click_blacklist": _with(EVENTS, CLICKS, _capped(CLICK_LIMIT))
    + f"SELECT user_id, ad_id, 'Click over{CLICK_LIMIT}times' AS msg FROM capped WHERE kind = 'warning'",
    "province_clicks": _provinces(CLICK_LIMIT),
    "province_clicks_strict": _provinces(CLICK_LIMIT + 1),
    "login_failures": _with(EVENTS, FAILURES) + "SELECT * FROM fails",
    "order_sequences": _with(EVENTS, ORDERS, SEQUENCES) + f"SELECT {SEQUENCE_COLUMNS} FROM seqs",
    "order_states": _with(EVENTS, ORDERS, STATES) + "SELECT order_id, us, result_msg FROM states",
    "order_states_with_grace": _with(EVENTS, ORDERS, STATES_GRACE) + "SELECT order_id, us, result_msg FROM states",
    "payment_receipts": _with(EVENTS, ORDERS, RECEIPTS, MATCHES) + f"SELECT {MATCH_COLUMNS} FROM matches",
    "payment_receipt_pairs": PAIRS,
    "late_rows": _with(EVENTS) + f"""SELECT arrival, user_id,
  CASE WHEN coalesce((us // {10 * S} + 60) * {10 * S} - 1000 + {60 * S} <= seen - {S}, FALSE)
    THEN 'late' ELSE 'on_time' END AS kind
FROM (SELECT *, max(us) OVER (ORDER BY us + k % 7 * {1800 * S}, arrival
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM ev)""",
    "stream_payment_receipt_pairs": PAIRS,
}
ORACLES["rejected_log_lines"] = _with(EVENTS) + """SELECT arrival, '10.0.0.' || k || ' ' || user_id || ' - ' || CASE
  WHEN arrival % 50 = 7 THEN strftime(make_timestamp(us), '%d/%m/%Y:%H:%M:%S')
  ELSE strftime(make_timestamp(us), '%d/13/%Y:%H:%M:%S') || ' +0000 '
    || CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END || ' /' || event_type || '/' || k
    || CASE k % 10 WHEN 0 THEN '.css' WHEN 1 THEN '.js' WHEN 2 THEN '.js?v=1' ELSE '' END END AS value
FROM ev WHERE arrival % 50 IN (7, 8)"""
ORACLES["rejected_csv_records"] = _with(EVENTS, BEHAVIORS) + """SELECT arrival, CASE
  WHEN arrival % 50 = 7 THEN user_id || ',' || item_id || ',' || category_id || ',' || behavior
  ELSE user_id || ',item,' || category_id || ',' || behavior || ',' || (us // 1000000) END AS value
FROM beh WHERE arrival % 50 IN (7, 8)"""
ORACLES["sliding_visitors"] = _with(EVENTS, BEHAVIORS) + f"""SELECT w_end // 1000 AS window_end, count(DISTINCT user_id) AS cnt, TRUE AS near
FROM (SELECT user_id, {_ends(DAY_S, HOUR_S)} AS w_end FROM beh WHERE {PV}) GROUP BY 1"""
ORACLES["click_cap_by_clock"] = _with(EVENTS, CLICKS) + f"""SELECT arrival, user_id, ad_id,
  CASE WHEN nth <= {CLICK_LIMIT} THEN 'pass' ELSE 'warning' END AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, arrived // {DAY} ORDER BY arrived, arrival) AS nth
    FROM (SELECT *, us + k % 7 * {1800 * S} AS arrived FROM clk))
  WHERE nth <= {CLICK_LIMIT} + 1"""
ORACLES["stream_click_cap_by_clock"] = ORACLES["click_cap_by_clock"]
# Streams come to the same results as tables.
ORACLES |= {f"stream_{name}": ORACLES[name] for name in (
    "page_views", "unique_visitors", "hot_items", "province_clicks", "channel_counts", "click_cap",
    "login_failures", "order_sequences", "payment_receipts", "hot_items_report", "hot_pages_report", "channel_peaks",
    "hot_pages", "click_cap_strict",
)}
ORACLES["stream_click_cap_timers"] = ORACLES["click_cap"]
ORACLES["stream_order_states"] = ORACLES["order_states_with_grace"]
ORACLES["stream_late_rows"] = ORACLES["late_rows"]
ORACLES["stream_hot_pages_late"] = ORACLES["hot_pages"]
ORACLES["stream_order_states_late"] = ORACLES["order_states_with_grace"]
