"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orestack import registry  # noqa: E402

HEADLINE = (
    "agg_revenue_daily", "fact_orders", "silver_orders", "orders_rejects", "quality_orders",
    "silver_customers", "orders_after_merge", "silver_orders_current", "orders_as_of_timestamp",
    "diff_changed_status", "compare_versions", "orders_after_restore", "fact_date_range",
    "profile_duplicates", "profile_nulls", "layer_summary", "report_top_days", "report_region_avg",
    "report_status", "report_monthly_trend", "events_stream_ingest",
)
WARM_RUNS = 2


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Building a plan does not record the Python line of every expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    # Every column of every row is computed; nothing is sent to the driver.
    def run(name: str) -> None:
        registry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()

    first: dict[str, float] = {"agg_revenue_daily": timed(lambda: run("agg_revenue_daily"))}
    first["lake_run"] = timed(lambda: registry.lake(spark, folder))
    first["merge_history"] = timed(lambda: registry.merged_lake(spark, folder))
    for name in HEADLINE:
        if name not in first:
            first[name] = timed(lambda: run(name))
    warm = {name: min(timed(lambda: run(name)) for _ in range(WARM_RUNS)) for name in HEADLINE}
    times = {name: round(seconds, 3) for name, seconds in warm.items()}
    # Both write their tables once per session; a second time they are written to new folders.
    for name, build in (("lake_run", registry.lake), ("merge_history", registry.merged_lake)):
        registry.forget()
        times[name] = round(timed(lambda: build(spark, folder)), 3)

    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline queries, best of two warm runs; the lake run and the six-version merge history, one warm run each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": {name: round(seconds, 3) for name, seconds in first.items()},
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
