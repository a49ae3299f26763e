"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times into a sink that reads every row and
column; the median counts.

The tables given are single row groups, which one task reads.  The library does not repartition its
inputs, so the tables are first laid out in one file for each core, which takes `layout_sec`
(BENCH_LAYOUT=0 reads them as they are).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimweave.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "left_lookup_kv",
    "left_lookup_hash",
    "inner_lookup_kv",
    "miss_as_blank_row",
    "delimited_lookup",
    "dedup_lookup",
    "external_lookup",
    "skewed_lookup",
    "skewed_lookup_wide",
    "skewed_left_lookup",
    "skewed_dedup_lookup",
    "ttl_lookup",
    "ttl_lookup_no_negative",
    "live_lookup",
    "kv_decode",
    "delimited_decode",
    "gen_skewed_text",
    "lookup_stats",
    "throughput_10s",
    "sample_bucketed",
    "sample_greedy",
    "sample_every_n",
    "check_all",
    "error_counts",
]


LAID_OUT = ["events", "orders", "lineitem", "documents", "part", "supplier", "customer"]
SMALL = 20_000


def layout(spark: SparkSession, sf_dir: str, folder: str, files: int) -> None:
    """The tables in `files` files each, small ones in one."""
    for name in LAID_OUT:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        parts = files if rows.count() > SMALL else 1
        rows.repartition(parts).write.parquet(f"{folder}/{name}.parquet")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    source, spent = sf_dir, 0.0
    scratch = tempfile.TemporaryDirectory(prefix="bench-")
    if os.environ.get("BENCH_LAYOUT", "1") != "0":
        start = time.perf_counter()
        layout(spark, sf_dir, scratch.name, int(cpus) if cpus.isdigit() else 8)
        source, spent = scratch.name, time.perf_counter() - start
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, source).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "layout_sec": round(spent, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
