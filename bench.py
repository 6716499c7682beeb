"""Times the headline queries: one JSON line, each the median of warm runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsflow.plans.registry import QUERIES
from obsflow.session import build_session

HEADLINE = [
    "flagship_zscore",
    "zscore_anomalies",
    "feature_engineering",
    "json_roundtrip",
    "count_by_topic_sorted",
    "window_count",
    "window_stats",
    "window_outliers_1sigma",
    "weekly_day_night",
    "sliding_week",
    "trailing_week",
    "two_hour_lists",
    "range_join_anomalies",
    "trailing_mean_range",
    "trailing_mean_window",
    "window_standardise",
    "kmeans_distance_anomaly",
    "svm_fit_predict",
    "access_log_parse",
]
RUNS = 3


def run(df):
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 4)
        print(f"{name} {seconds[name]} (first {times[0]:.2f})", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total of median warm seconds per query",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
