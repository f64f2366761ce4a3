"""Benchmark of the headline products (Q1-Q8) on one test-data folder.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (warm runs after one cold run, default 3), ``BENCH_SHARED_DIR`` (for staged tables;
default a fresh temporary folder, as the run is local). Each query is run to completion
with a no-op sink (every row computed, nothing collected). Prints one JSON line:
per-query median of the warm runs, and their sum as the headline value. A product that
fails is reported under ``failed`` (its time is null) and the others are still timed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "q1_silver_sessions": "silver_user_sessions",
    "q2_silver_purchases": "silver_purchases_enriched",
    "q3_silver_leaderboard": "silver_leaderboard_enriched",
    "q4_daily_summary": "daily_summary_backfill",
    "q5_user_demographics": "user_demographics",
    "q6_trained_segments": "kmeans_segments",
    "q7_scored_segments": "scored_segments",
    "q8_simple_segments": "simple_segments",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_runs = int(os.environ.get("BENCH_RUNS", "3"))

    from pyspark.sql import SparkSession

    from meeple.registry import QUERIES
    from meeple.session import CORE_CONF

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("meeple-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) if cpus.isdigit() else 8)))
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="meeple-bench-"))
        .config("spark.driver.memory", os.environ.get("MEEPLE_DRIVER_MEMORY", "8g"))
    )
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    timings: dict[str, float | None] = {}
    failed: dict[str, str] = {}
    for label, name in HEADLINE.items():
        runs = []
        try:
            for _ in range(1 + warm_runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            timings[label] = round(statistics.median(runs[1:] or runs), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep timing the others
            timings[label] = None
            failed[label] = repr(exc)[:300]

    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_q1_q8_total",
                "value": round(sum(t for t in timings.values() if t is not None), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": cpus,
                "spark": spark.version,
                "warm_runs": warm_runs,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
