"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

First the whole warehouse is built from the raw tables (timed as
``warehouse_build``), then each headline query runs over it.  Every query is
executed completely (written to the no-op sink, so nothing is collected); the JSON
line reports seconds per step and their sum.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from dimforge.plans.catalog import QUERIES, build_warehouse, reset_warehouses  # noqa: E402

# The workload of the original system: one warehouse build (every dimension and fact,
# from the raw tables), then the checks, read queries and write operators over it.
HEADLINE = [
    "revenue_by_category",          # flagship: star join + distinct count + top-k
    "revenue_by_category_range",    # same with a pushed-down date range
    "seller_snapshot",              # point lookup + recent-k
    "order_lifecycle_lookup",       # lifecycle with junk flags (all orders)
    "row_counts",                   # 11 global counts
    "dqc_dim_all",                  # 17 checks, fused
    "dqc_fct_all",                  # 18 checks, fused
    "upsert_customer",              # SCD-1 merge against an earlier state
    "scd2_apply_product",           # SCD-2 in one pass against an earlier history
    "replace_by_key_items",         # idempotent fact reload
    "replace_by_month",             # snapshot reload by month
    "stage_delays",                 # minute arithmetic over events
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dimforge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="dimforge-bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # warm the JVM (class loading, codegen caches) on a tiny query outside the timings
    QUERIES["dedupe_first_per_key"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    reset_warehouses(spark)
    times = {}
    t0 = time.perf_counter()
    build_warehouse(spark, sf_dir, threads=4)  # every table, from the raw tables
    times["warehouse_build"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
