"""The end-to-end run: bronze, silver and gold as versioned tables below one folder."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orestack import settings
from orestack.functions import rules
from orestack.operators import versioned
from orestack.operators.partitioned import PartitionedTable
from orestack.operators.versioned import VersionedTable
from orestack.plans import bronze, gold, silver
from orestack.sources import files
from orestack.sources.workspace import new_folder

# A large batch of at least this part of the stored orders makes a new base of them: to lay it over them would cost every later
# read a shuffle of them all.
MOST_PARTS = 4


class Lake:
    """The tables of one lake folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.bronze_orders = VersionedTable(spark, f"{path}/bronze/orders")
        self.order_counts = VersionedTable(spark, f"{path}/quality/orders")
        self.order_rejects = VersionedTable(spark, f"{path}/quality/orders_rejected")
        self.customer_counts = VersionedTable(spark, f"{path}/quality/customers")
        self.customer_rejects = VersionedTable(spark, f"{path}/quality/customers_rejected")
        self.silver_orders = VersionedTable(spark, f"{path}/silver/orders", key=["order_id"], hidden=[silver.ARRIVAL],
                                            stored=silver.short_arrival, carried=(silver.short_orders, silver.whole_orders))
        self.silver_customers = VersionedTable(spark, f"{path}/silver/customers")
        self.fact_orders = VersionedTable(spark, f"{path}/gold/fact_orders")
        self.fact_months = PartitionedTable(spark, f"{path}/gold/fact_orders_by_month", gold.PARTITION_COLUMNS)
        self.agg_revenue_daily = VersionedTable(spark, f"{path}/gold/agg_revenue_daily")


def ingest_orders(lake: Lake, raw_orders: DataFrame, source: str = "orders.csv",
                  committed_at: str | None = None) -> int:
    """Append raw orders to bronze as they are, copies included."""
    return lake.bronze_orders.append(bronze.with_audit(raw_orders, source), committed_at)


def unmerged_orders(lake: Lake) -> DataFrame | None:
    """The bronze rows that are not merged into silver yet; None when there are none."""
    merged = lake.silver_orders.source_version()
    return lake.bronze_orders.current() if merged is None else lake.bronze_orders.appended_since(merged)


def _as_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.range(1).select(*(F.lit(value).cast("bigint").alias(name) for name, value in counts.items()))


def refresh_silver_orders(lake: Lake, bronze_orders: DataFrame | None = None,
                          committed_at: str | None = None, full: bool = False) -> int:
    """Merge the clean orders of bronze into silver; returns the version of silver.

    By default these are the rows of bronze that are not merged yet. One pass types them, writes the rejected ones
    and counts the failures of every rule, and a second one merges the valid ones as they stand in bronze; the counts and
    the rejected rows of the batch are added to the quality tables. An order of which silver has a newer copy stays as it is. Without new rows
    nothing is written. With ``full`` all of bronze is merged, and silver gets a new base. A given part of bronze is
    merged as it is. Neither of these is added to the quality tables.
    """
    if full or bronze_orders is not None:
        rows = lake.bronze_orders.current() if full else bronze_orders
        valid = rules.keep_valid(silver.type_orders(rows), silver.order_rules())
        return lake.silver_orders.merge(silver.arrived_orders(valid), silver.ORDER_UPDATE_COLUMNS, committed_at, new_base=full,
                                        source_version=lake.bronze_orders.latest_version() if full else None, covering=full)
    version, batch = lake.bronze_orders.latest_version(), unmerged_orders(lake)
    if batch is None:
        return lake.silver_orders.latest_version()
    parts = rules.set_aside(silver.type_orders(batch), silver.order_rules(), new_folder(lake.spark, "rejected-orders"))
    unique = Observation()
    arrived = silver.arrived_orders(parts.valid).observe(unique, F.count(F.lit(1)).alias("unique_rows"))
    # As in a merge, a small batch is written once and read twice, and a large one read once, as is silver: the merge itself
    # leaves its newer copies alone.
    batch_bytes = settings.scan_bytes(batch)
    small, newer, new_base = batch_bytes <= versioned.STAGED_BYTES, None, False
    if small and lake.silver_orders.latest_version() is not None:
        staged = new_folder(lake.spark, "newest-orders")
        with settings.tidy(lake.spark):
            arrived.write.parquet(staged)
        arrived = silver.not_older(lake.spark.read.schema(arrived.schema).parquet(staged), lake.silver_orders.current(hidden=True))
    elif not small:
        newer = functools.partial(silver.whole_arrival, short=True)
        new_base = batch_bytes * MOST_PARTS >= lake.silver_orders.stored_bytes()
    merged = lake.silver_orders.merge(arrived, silver.ORDER_UPDATE_COLUMNS, committed_at, new_base=new_base, source_version=version,
                                      staged=small, newer=newer, follows=True)
    counts = parts.counts | unique.get
    counts["duplicate_rows"] = counts["valid_rows"] - counts["unique_rows"]
    lake.order_counts.append(_as_row(lake.spark, counts))
    lake.order_rejects.append(parts.rejected)
    return merged


def refresh_silver_customers(lake: Lake, raw_customers: DataFrame,
                             regions: Sequence[str] = silver.REGIONS) -> int:
    """Replace the customers, and their counts and rejected rows, from one pass over the raw rows."""
    cleaned = silver.clean_customers(raw_customers)
    parts = rules.split(cleaned, silver.customer_rules(regions), new_folder(lake.spark, "customers"))
    lake.customer_counts.overwrite(_as_row(lake.spark, parts.counts))
    lake.customer_rejects.overwrite(parts.rejected)
    return lake.silver_customers.overwrite(silver.valid_customers(parts.valid))


def refresh_fact_orders(lake: Lake, raw_products: DataFrame) -> int:
    fact = gold.fact_orders_by_month(lake.silver_orders.current(), lake.silver_customers.current(), raw_products)
    with settings.widening(lake.spark):
        return lake.fact_orders.overwrite(fact, gold.PARTITION_COLUMNS, sort_by=["order_date"], gathered=True)


def refresh_fact_months(lake: Lake, raw_products: DataFrame, since: int | None = None) -> list[tuple[int, int]]:
    """Rebuild the months of the fact that silver orders were written in, or left, after the version ``since``.

    Returns the months. Their orders alone are joined and written, with dynamic partition overwrite; the files of other
    months stay. Without ``since`` all months are built. A change of customers or products reaches only the months that
    are rebuilt, so build all of them after one.
    """
    orders = lake.silver_orders.current()
    months = [F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month")]
    touched = None
    if since is not None:
        latest = lake.silver_orders.latest_version()
        if since == latest:
            return []
        before, after = lake.silver_orders.differing(since, latest)
        # There are as many rows as months, however large the batch is.
        with settings.tidy(lake.spark):
            touched = sorted(tuple(row) for row in before.select(*months).union(after.select(*months)).distinct().collect())
        if not touched:
            return []
        month = F.trunc("order_date", "month")
        orders = orders.filter(month.isin([datetime.date(y, m, 1) for y, m in touched]) & F.col("order_date").between(
            datetime.date(*touched[0], 1), F.last_day(F.lit(datetime.date(*touched[-1], 1)))))
    fact = gold.fact_orders_by_month(orders, lake.silver_customers.current(), raw_products)
    if touched is None:
        with settings.widening(lake.spark):
            lake.fact_months.replace(fact, sort_by=["order_date"], gathered=True)
        return [tuple(r) for r in lake.fact_months.current().select(*gold.PARTITION_COLUMNS).distinct().sort(*gold.PARTITION_COLUMNS).collect()]
    with settings.widening(lake.spark):
        lake.fact_months.replace_partitions(fact, touched, sort_by=["order_date"], gathered=True)
    return touched


def refresh_agg_revenue_daily(lake: Lake) -> int:
    daily = gold.agg_revenue_daily(lake.fact_orders.current(), stored=True)
    return lake.agg_revenue_daily.overwrite(
        daily, gold.PARTITION_COLUMNS, sort_by=["order_date", "region", "category"])


def run_pipeline(spark: SparkSession, raw_orders: DataFrame, raw_customers: DataFrame,
                 raw_products: DataFrame, path: str, regions: Sequence[str] = silver.REGIONS,
                 input_bytes: int | None = None) -> Lake:
    """Run every layer once, in order, and return the tables.

    ``input_bytes``, the size of the raw orders, sizes the shuffles of the run; the session has its own
    settings again afterwards.
    """
    lake = Lake(spark, path)
    with settings.applied(spark, input_bytes):
        ingest_orders(lake, raw_orders)
        refresh_silver_orders(lake)
        refresh_silver_customers(lake, raw_customers, regions)
        refresh_fact_orders(lake, raw_products)
        refresh_agg_revenue_daily(lake)
    return lake


def run_from_csv(spark: SparkSession, orders: str, customers: str, products: str, path: str,
                 regions: Sequence[str] = silver.REGIONS, input_bytes: int | None = None) -> Lake:
    """Run every layer over CSV files; bronze keeps the file name of each row."""
    raw_orders = files.read_orders(spark, orders)
    if input_bytes is None:
        input_bytes = settings.row_bytes(raw_orders, settings.TEXT_GROWTH)
    return run_pipeline(
        spark, raw_orders, files.read_customers(spark, customers),
        files.read_products(spark, products), path, regions, input_bytes)
