"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1). BENCH_CPUS: local threads.
BENCH_QUERIES: comma separated names instead of the default set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans.queries import QUERIES  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

HEADLINE = [
    "hot_items", "page_views", "unique_visitors", "hot_pages", "channel_peaks", "click_cap", "province_clicks",
    "login_failures", "order_sequences", "order_states", "payment_receipts", "payment_receipt_pairs", "late_rows",
    "stream_hot_items", "stream_login_failures", "stream_payment_receipts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["page_views"](spark, folder).write.format("noop").mode("overwrite").save()
    taken = {}
    for name in names:
        start = time.perf_counter()
        # Every row and column is computed; nothing goes through the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(taken.values()), 3), "unit": "sec",
        "queries": taken, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
