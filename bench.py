"""Wall seconds of the headline queries: one JSON line on stdout.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import registry  # noqa: E402

HEADLINE = (
    "student_term_history",
    "fill_forward_6",
    "attempted_hours",
    "student_flags",
    "interval_join",
    "term_events",
    "degree_slots",
    "order_line_slots",
    "shipment_terms",
    "daily_fill_forward",
    "single_quarter_follow_up",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("termloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", cpus)
        # The plan has more generated classes than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(name: str, spark: SparkSession, directory: str) -> float:
    """Build and run one query; lookups cached by an earlier run are computed again."""
    spark.catalog.clearCache()
    start = time.perf_counter()
    registry.run(name, spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    best = {}
    for name in HEADLINE:
        seconds(name, spark, directory)
        best[name] = round(min(seconds(name, spark, directory) for _ in range(runs)), 3)
    spark.stop()
    line = {
        "metric": "wall time, sum of headline queries",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "sf": Path(directory).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
