"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_RUNS
(default 3, median is reported, one warm-up run before), BENCH_ALL=1 for every query.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from check import session  # noqa: E402
from growthloom.registry import QUERIES  # noqa: E402

HEADLINE = [
    "daily_metrics_rollup", "funnel_stage_counts", "revenue_by_type", "funnel_conversion", "automation_health",
    "utm_performance", "time_to_convert", "ordered_funnel", "session_build", "cookie_window_join",
    "abandoned_checkout", "content_to_conversion", "lifecycle_transitions", "membership_sync", "upsert",
    "affiliate_run", "affiliate_balances", "product_sales", "mrr", "churn_alerts", "lead_capture", "purchase_intake",
    "production_packages", "production_order", "brand_voice_lint", "weekly_report", "check_fk", "check_unique",
    "rls_two_hop", "grant_access",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    out: dict[str, float] = {}
    for name in list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE:
        took = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            if i:
                took.append(time.perf_counter() - start)
        out[name] = round(statistics.median(took), 4)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
