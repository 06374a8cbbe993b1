"""Benchmark of the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times into a noop sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricelake.plans.catalog import QUERIES
from pricelake.session import local_session

HEADLINE = [
    "a1_daily_summary", "a2_weekly_summary", "a3_monthly_summary",
    "v1_price_trends", "v2_volatility", "v3_source_comparison", "v4_correlation", "v5_year_over_year",
    "v6_volume_analysis", "f1_lag_features", "f2_rolling_features", "f3_momentum", "f4_rsi", "f4_macd",
    "f6_market_structure", "c1_dedup_first", "c5_forward_fill", "c7_iqr_outliers", "c8_zscore_outliers",
    "m1_currency_conversion", "m3_timestamps", "e3_price_changes", "q3_duplicates", "q6_quality_report",
    "q13_price_spikes", "n4_all_providers", "n8_offer_rows", "w6_scd2_merge", "w8_fact_rows",
    "o4_alert_suppression", "t4_stream_suppression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, max(int(cpus), 1), "bench") if cpus.isdigit() else local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen:
        spent = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(spent[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
