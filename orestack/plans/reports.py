"""Reports over silver orders, silver customers, the order fact and the daily aggregate.

Reports over the daily aggregate sum its rounded revenue; they do not round the grand total.
Every sort ends with the group key, so that equal measures have a fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orestack.functions import money


def _count(alias: str = "order_count") -> Column:
    return F.count(F.lit(1)).alias(alias)


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], limit: int) -> DataFrame:
    """The first rows by ``order_by``, cut to the columns a reader wants to see."""
    return df.orderBy(*order_by).limit(limit).select(*columns)


def customers_by_region(customers: DataFrame) -> DataFrame:
    return customers.groupBy("region").agg(_count("customer_count")).orderBy("region")


def by_status(orders: DataFrame) -> DataFrame:
    """Orders and revenue per status; works on silver orders and on the fact."""
    return orders.groupBy("status").agg(
        _count(), money.in_millions(F.sum("total_amount"), 2).alias("revenue_millions"),
    ).orderBy("status")


def monthly_trend(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        _count(), money.in_millions(F.sum("total_amount"), 1).alias("revenue_millions"),
    ).orderBy("month")


def high_value(fact: DataFrame) -> DataFrame:
    total = F.sum("total_amount")
    return fact.groupBy("is_high_value").agg(
        _count(),
        money.in_millions(total, 1).alias("revenue_millions"),
        money.in_thousands(total.cast("double") / F.count("total_amount")).alias("avg_thousands"),
    ).select(
        F.when(F.col("is_high_value"), "High Value").otherwise("Normal").alias("label"),
        "order_count", "revenue_millions", "avg_thousands",
    ).orderBy("label")


def top_days(daily: DataFrame, limit: int = 5) -> DataFrame:
    """The days with the most revenue; equal revenue is ordered by day."""
    return daily.groupBy("order_date").agg(F.sum("revenue").alias("revenue")).orderBy(
        F.col("revenue").desc(), "order_date",
    ).limit(limit).select(
        "order_date", money.in_millions(F.col("revenue"), 2).alias("revenue_millions"))


def by_region(daily: DataFrame) -> DataFrame:
    return daily.groupBy("region").agg(
        money.in_millions(F.sum("revenue"), 2).alias("revenue_millions"),
        F.sum("order_count").alias("order_count"),
    ).orderBy(F.col("revenue_millions").desc(), "region")


def by_category(daily: DataFrame) -> DataFrame:
    revenue = F.sum("revenue")
    return daily.groupBy("category").agg(
        revenue.cast("decimal(28,2)").alias("revenue"),
        money.in_millions(revenue, 2).alias("revenue_millions"),
    ).orderBy(F.col("revenue_millions").desc(), "category")


def region_averages(daily: DataFrame) -> DataFrame:
    """Per region: orders, revenue, the plain average of the daily averages, and the true average."""
    return daily.groupBy("region").agg(
        F.sum("order_count").alias("order_count"),
        money.in_millions(F.sum("revenue"), 1).alias("revenue_millions"),
        money.in_thousands(F.avg("avg_order_value")).alias("avg_of_daily_avg_thousands"),
        money.in_thousands(F.sum("revenue").cast("double") / F.sum("order_count")).alias("avg_order_thousands"),
    ).orderBy(F.col("revenue_millions").desc(), "region")


def category_units(daily: DataFrame) -> DataFrame:
    return daily.groupBy("category").agg(
        F.sum("order_count").alias("order_count"),
        money.in_millions(F.sum("revenue"), 1).alias("revenue_millions"),
        F.sum("units_sold").alias("units_sold"),
    ).orderBy(F.col("revenue_millions").desc(), "category")


def region_share(daily: DataFrame) -> DataFrame:
    """Share of the orders per region."""
    counts = daily.groupBy("region").agg(F.sum("order_count").alias("order_count"))
    everything = counts.agg(F.sum("order_count")).scalar()
    return counts.select(
        "region", "order_count",
        money.percent(F.col("order_count"), everything).alias("share_percent"),
    ).orderBy("region")


def subtotals(daily: DataFrame) -> DataFrame:
    """Orders and revenue per month, region and category, with the subtotals of every combination of them.

    ``level`` tells which of the three are summed over (4 for the month, 2 for the region, 1 for the category), so a
    subtotal is told from the rows of orders without a region or a category.
    """
    months = daily.withColumn("month", F.date_format("order_date", "yyyy-MM"))
    return months.cube("month", "region", "category").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("order_count").alias("order_count"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
    ).orderBy("level", "month", "region", "category")


def moving_revenue(daily: DataFrame, days: int = 7) -> DataFrame:
    """Per region and day with orders: revenue, that of the last ``days`` days, and the change to the day before with orders.

    Days without orders have no row, and count as such in the frame, which is one over dates and not over rows. The
    rows are summed per region and day first, so a window holds a row per day.
    """
    by_day = daily.groupBy("region", "order_date").agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue"))
    by_date = Window.partitionBy("region").orderBy(F.unix_date("order_date"))
    before = F.lag("revenue").over(by_date)
    return by_day.select(
        "region", "order_date", "revenue",
        F.sum("revenue").over(by_date.rangeBetween(1 - days, 0)).cast("decimal(28,2)").alias("moving_revenue"),
        F.count(F.lit(1)).over(by_date.rangeBetween(1 - days, 0)).alias("days_with_orders"),
        (F.col("revenue") - before).cast("decimal(28,2)").alias("change"),
        F.datediff("order_date", F.lag("order_date").over(by_date)).alias("days_since"),
    ).orderBy("region", "order_date")


def customer_sketches(fact: DataFrame, precision: int = 16) -> DataFrame:
    """Per day and region the customers with an order that is not cancelled: their exact count, and a sketch that adds up."""
    return fact.filter(F.col("status") != "cancelled").groupBy("order_date", "region").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.hll_sketch_agg("customer_id", F.lit(precision)).alias("customers"))


def monthly_customers(sketches: DataFrame) -> DataFrame:
    """Customers per month, estimated from the sketches of its days: counts of days do not add up, their sketches do."""
    return sketches.groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"),
        F.sum("customer_count").alias("summed_counts")).orderBy("month")


def total_revenue(daily: DataFrame) -> DataFrame:
    total = F.sum("revenue")
    return daily.agg(
        total.cast("decimal(28,2)").alias("revenue"),
        money.in_millions(total, 2).alias("revenue_millions"),
    )
