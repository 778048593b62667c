"""Comparisons of versions and layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orestack.functions import money
from orestack.operators.profile import row_counts


def compare_versions(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, rows after and their difference."""
    counts = row_counts({"before": before, "after": after})
    return counts.agg(*(
        F.max(F.when(F.col("table_name") == name, F.col("row_count"))).alias(f"rows_{name}")
        for name in ("before", "after")
    )).withColumn("row_difference", F.col("rows_after") - F.col("rows_before"))


def rerun_check(before: DataFrame, after: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row: rows before and after a re-run, keys whose ``columns`` differ, and the verdict.

    Audit columns change with every run and are left out of ``columns``.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, F.struct(*columns).alias(name))

    pairs = side(before, "old").join(side(after, "new"), list(key), "full")
    return pairs.agg(
        F.count("old").alias("rows_before"),
        F.count("new").alias("rows_after"),
        F.count_if(~F.col("old").eqNullSafe(F.col("new"))).alias("changed_rows"),
    ).withColumn("passed", F.col("changed_rows") == 0)


def layer_summary(bronze_orders: DataFrame, silver_orders: DataFrame, silver_customers: DataFrame,
                  fact_orders: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: rows of every layer, orders removed on the way to silver, and the total revenue."""
    tables = {
        "bronze_orders": bronze_orders.select(F.lit(0).alias("revenue")),
        "silver_orders": silver_orders.select(F.lit(0).alias("revenue")),
        "silver_customers": silver_customers.select(F.lit(0).alias("revenue")),
        "fact_orders": fact_orders.select(F.lit(0).alias("revenue")),
        "agg_revenue_daily": daily.select("revenue"),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("revenue").cast("decimal(28,2)").alias("revenue"))
        .withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    every = counts[0]
    for other in counts[1:]:
        every = every.unionByName(other)
    return every.agg(
        *(F.max(F.when(F.col("table_name") == name, F.col("row_count"))).alias(name) for name in tables),
        money.in_millions(F.sum("revenue"), 2).alias("revenue_millions"),
    ).withColumn("orders_removed", F.col("bronze_orders") - F.col("silver_orders"))
