"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query is run to completion through the no-op sink; the best of three
runs after one warm-up counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "q1_fleet_overview",
    "r14_score_messages",
    "a1_sensor_window_avg",
    "a4_bucket_mean",
    "a6_downsample_last",
    "a7_latest_per_factory",
    "a18_latency_stats",
    "a19_max_empty_bucket_seconds",
    "a23_daily_ops_summary",
    "d1_dedup_messages",
    "e12_severity",
    "f6_gap_report",
    "j3_asof_infra",
    "j8_merge_measurement_windows",
    "q8_timeline_events",
    "r3_config_contributions",
    "s7_parse_messages",
    "w2_score_delta",
    "w5_state_runs",
    "w7_moving_mean",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plantpulse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Call sites of every column expression are for debugging only.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from plantpulse.plans import catalog

    registered = catalog.queries()
    seconds = {}
    for name in HEADLINE:
        best = None
        for run in range(runs + 1):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            if run and (best is None or took < best):
                best = took
        seconds[name] = round(best, 4)
    total = round(sum(seconds.values()), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
