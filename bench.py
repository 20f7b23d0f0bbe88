"""Time the registered queries end to end, from the given tables to the full result.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from usagelens.session import remove_staged

HEADLINE = [
    "standardize_events", "event_numbering", "enrich_employees", "sessions", "users",
    "quality_summary", "overview", "cost_by_model", "error_rate_by_model", "filtered_kpis",
    "ingest_flatten", "saved_overview", "saved_filtered_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", cores)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["event_type_counts"](spark, sf_dir).collect()  # start the session up

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        # Every row and column is computed, none is shipped to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    # The same once more, with the code compiled: what is left is the work itself.
    warm: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        warm[name] = round(time.perf_counter() - started, 3)
    remove_staged(spark)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total seconds for the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "second_run": warm,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
