"""Time the headline queries; prints one line of JSON.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores. Every query
runs once to warm up; the value is the median of three further runs, or of fewer
when they take long.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sievemark.catalog.queries import QUERIES  # noqa: E402

HEADLINE = [
    "all_issues",
    "exact_duplicates",
    "rule_id_unique",
    "quarantine_rows",
    "curated_projection",
    "batch_summary",
    "issue_metrics",
    "batch_fingerprint",
    "source_row_numbers",
    "key_clashes_lineitem",
    "scalar_cleaning",
    "scalar_casts",
    "publish_curated_roundtrip",
]
RUNS = 3
SECONDS_PER_QUERY = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        # Every column of every row is computed, and none is sent to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        once(name)
        times = [once(name)]
        while len(times) < RUNS and sum(times) < SECONDS_PER_QUERY:
            times.append(once(name))
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
