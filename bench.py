"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one
JSON line. Every query is planned and run once, in full, into a sink that discards
its rows; a small query runs first so that the start of the JVM is not counted."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from registry.queries import registered  # noqa: E402

HEADLINES = [
    "local_hour_rollup",
    "trailing_sums",
    "hourly_features",
    "daily_features",
    "wide_features",
    "peer_benchmark",
    "extract_hourly",
    "dedupe_sources",
    "forecast_6h",
    "guards_6h",
    "ranges_24h",
    "forecast_rows",
    "calibrated",
    "quality_monitor",
    "sample_weights",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    queries["top_ads"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
