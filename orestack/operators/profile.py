"""Quality profiles of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from orestack.functions import money


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL cells per column as rows of (column_name, null_count), from one pass."""
    wide = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return wide.unpivot([], list(columns), "column_name", "null_count")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Total rows, distinct keys (NULL counts as one key), surplus rows and their share."""
    has_null = F.max(F.col(key).isNull().cast("int")).cast("bigint")
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count_distinct(F.col(key)) + F.coalesce(has_null, F.lit(0))).alias("unique_keys"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_keys"))
    return counts.withColumn(
        "duplicate_percent", money.percent(F.col("duplicate_rows"), F.col("total_rows")))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def most_repeated(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The ``limit`` most repeated keys; equal counts are ordered by key."""
    return repeated_keys(df, key).orderBy(F.col("copies").desc(), F.col(key).asc_nulls_first()).limit(limit)


def unique_key_check(df: DataFrame, key: str) -> DataFrame:
    """One row: number of repeated keys and whether there is none."""
    return repeated_keys(df, key).agg(F.count(F.lit(1)).alias("repeated_keys")).withColumn(
        "passed", F.col("repeated_keys") == 0)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named table as (table_name, row_count)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def compare_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, rows removed and their share."""
    counts = row_counts({"before": before, "after": after})
    wide = counts.agg(*(
        F.max(F.when(F.col("table_name") == name, F.col("row_count"))).alias(f"rows_{name}")
        for name in ("before", "after")
    )).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    return wide.withColumn("removed_percent", money.percent(F.col("rows_removed"), F.col("rows_before")))
