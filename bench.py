"""Time the headline queries: one warm-up, then the median of three runs each.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1), runs on local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.plans.queries import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = (
    "profile_table_metrics",
    "profile_column_metrics",
    "profile_lineitem_columns",
    "dedup_latest_lineitem",
    "dedup_latest_payments",
    "dedup_whole_row",
    "mask_customer",
    "mask_documents",
    "hash_sha256",
    "join_customers_orders",
    "join_orders_with_payments",
    "integrate_wide",
    "dq_checks_raw",
    "check_orphans",
    "repair_wide",
    "route_pass",
    "chain_published_orders",
    "publish_verify_counts",
    "chain_run_log_pass",
    "land_changes_daily",
    "stream_latest_events",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
