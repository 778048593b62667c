"""Command line.

    python -m orestack batch ORDERS.csv CUSTOMERS.csv PRODUCTS.csv LAKE
    python -m orestack events FOLDER LAKE [--every "10 seconds"] [--stop-after 60]

The session takes its master and memory from spark-submit or the Spark configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orestack.plans import checks, pipeline, reports
from orestack.streaming import events


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = pipeline.run_from_csv(spark, args.orders, args.customers, args.products, args.lake)
    daily = lake.agg_revenue_daily.current()
    lake.silver_orders.history(5).show(truncate=False)
    checks.layer_summary(
        lake.bronze_orders.current(), lake.silver_orders.current(), lake.silver_customers.current(),
        lake.fact_orders.current(), daily).show()
    reports.by_status(lake.fact_orders.current()).show()
    for report in (reports.top_days, reports.by_region, reports.by_category):
        report(daily).show()


def _events(spark: SparkSession, args: argparse.Namespace) -> None:
    out = f"{args.lake}/bronze/events"
    events.ingest_events(
        spark, args.folder, out, f"{args.lake}/checkpoints/bronze_events",
        args.files_per_trigger, args.every, args.stop_after)
    batches = events.progress(spark, out)
    batches.show(max(1, batches.count()), truncate=False)


def main() -> None:
    parser = argparse.ArgumentParser(prog="orestack")
    commands = parser.add_subparsers(required=True)
    batch = commands.add_parser("batch", help="run bronze, silver and gold over CSV files")
    for name in ("orders", "customers", "products", "lake"):
        batch.add_argument(name)
    batch.set_defaults(run=_batch)
    stream = commands.add_parser("events", help="ingest a folder of JSON-lines events")
    stream.add_argument("folder")
    stream.add_argument("lake")
    stream.add_argument("--files-per-trigger", type=int, default=1)
    stream.add_argument("--every", help="run on this interval instead of ending with the input")
    stream.add_argument("--stop-after", type=float, help="seconds an interval run lasts")
    stream.set_defaults(run=_events)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("orestack").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
