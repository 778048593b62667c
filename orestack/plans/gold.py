"""Gold: the order fact with its dimensions, and the daily revenue aggregate."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from orestack import schemas, settings
from orestack.functions import money
from orestack.plans import silver

# Fixed value: an order of this total or more is a high-value order.
HIGH_VALUE_FROM = Decimal(1_000_000)

PARTITION_COLUMNS = ("order_year", "order_month")
DAILY_KEYS = ("order_date", "order_year", "order_month", "region", "category")


def product_dim(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.col("name").alias("product_name"), "category")


def customer_dim(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("name").alias("customer_name"), "region")


def fact_orders(orders: DataFrame, customers: DataFrame, products: DataFrame,
                high_value_from: Decimal = HIGH_VALUE_FROM) -> DataFrame:
    """Orders with customer, product and calendar columns.

    Left joins keep orders whose customer or product is unknown. Spark picks broadcast or shuffle
    per dimension by its measured size; in a shuffle, adaptive execution splits the share of a hot
    customer or product.
    """
    return _with_calendar(_described(orders, {"customer_id": customer_dim(customers), "product_id": product_dim(products)}), high_value_from)


def fact_orders_by_month(orders: DataFrame, customers: DataFrame, products: DataFrame,
                         high_value_from: Decimal = HIGH_VALUE_FROM) -> DataFrame:
    """The same rows, those of a month brought together by a rebalance for a write by ``PARTITION_COLUMNS``.

    The rebalance takes as little of a row as it can: what follows from other columns is made after it, and so are joins
    with dimensions that Spark broadcasts. A shuffled join would part the months again, so it comes before; it too takes
    short orders.
    """
    large, small = {}, {}
    for key, dimension in (("customer_id", customer_dim(customers)), ("product_id", product_dim(products))):
        (small if settings.is_broadcast(dimension) else large)[key] = dimension
    rows = _described(silver.short_orders(orders), large)
    day = silver.unpacked()["order_date"] if silver.is_short(rows) else F.col("order_date")
    rows = rows.withColumn("_month", F.trunc(day, "month")).hint("rebalance", "_month").drop("_month")
    return _with_calendar(_described(silver.whole_orders(rows), small), high_value_from)


def _described(orders: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    for key, dimension in dimensions.items():
        orders = orders.join(dimension, key, "left")
    return orders


def _with_calendar(described: DataFrame, high_value_from: Decimal) -> DataFrame:
    return described.withColumns({
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_quarter": F.quarter("order_date"),
        "is_high_value": F.when(F.col("total_amount") >= high_value_from, True).otherwise(False),
        "_gold_created_at": F.current_timestamp(),
    }).select(*schemas.FACT_COLUMNS)


def agg_revenue_daily(fact: DataFrame, stored: bool = False) -> DataFrame:
    """Revenue per day, region and category, without cancelled orders.

    Spark first aggregates per group and customer and shuffles by both, so the distinct count of a
    group that holds a large share of the orders is spread over many tasks. A ``stored`` fact is read
    twice: customers are then counted apart from the sums, which leave a task as one row per group.
    """
    total = F.sum("total_amount")
    orders = F.count("order_id")
    measures = {
        "order_count": orders,
        "revenue": money.whole(total),
        "avg_order_value": money.mean(total, F.count("total_amount")),
        "units_sold": F.sum("quantity"),
        "customer_count": F.count_distinct("customer_id"),
        "high_value_orders": F.count_if("is_high_value"),
    }
    sold = fact.filter(F.col("status") != "cancelled").groupBy(*DAILY_KEYS)

    def of(*names: str) -> DataFrame:
        return sold.agg(*(measures[name].alias(name) for name in names))

    daily = of(*measures)
    if stored:
        parts = of(*(name for name in measures if name != "customer_count")).unionByName(of("customer_count"), allowMissingColumns=True)
        daily = parts.groupBy(*DAILY_KEYS).agg(*(F.max(name).alias(name) for name in measures))
    return daily.withColumn("_gold_created_at", F.current_timestamp())


def date_range_filter(first: datetime.date, last: datetime.date) -> Column:
    """Orders from ``first`` to ``last``, both included, written so that partitions are pruned.

    Spark cannot tell from a date range which years and months it touches, so they are stated too.
    """
    year, month = F.col("order_year"), F.col("order_month")
    from_month = (year > first.year) | ((year == first.year) & (month >= first.month))
    to_month = (year < last.year) | ((year == last.year) & (month <= last.month))
    return from_month & to_month & F.col("order_date").between(F.lit(first), F.lit(last))
