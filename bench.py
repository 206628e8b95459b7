"""Time the headline queries: one warm-up, then the median of the timed runs.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES
(comma separated) change the defaults.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from merchlens.session import drop_scratch  # noqa: E402

HEADLINE = [
    "order_base", "source_monthly_v5", "ad_alloc_store_month", "ad_alloc_store_month_sorted", "ad_alloc_hybrid",
    "classify_v5", "alloc_audit", "report_quarter", "msku_month", "deal_price_long", "deal_price_wide",
    "ingest_orders", "performance_rows",
]


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("merchlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    drop_scratch(spark)
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else folder,
    }))


if __name__ == "__main__":
    main()
