"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tableqa import registry

# Full numbered extract, null metrics of all columns, duplicate keys, row hash, whole-table compare, plan run,
# metric compare and the end-to-end job, plus the change extract and the plan generator.
HEADLINE = [
    "nulls_wide", "duplicate_excess", "value_distribution_many_values", "row_hash", "full_extract_numbered",
    "full_extract_ties", "change_extract", "generate_plan", "run_plan", "observed_metrics", "compare_metrics",
    "compare_tables_equal", "extract_reconcile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tableqa-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load(spark, sf_dir, "lineitem").write.format("noop").mode("overwrite").save()  # start the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
