"""As-of joins: for every row the latest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, columns: Sequence[str], chunk: str = "day") -> DataFrame:
    """The rows of ``left`` with ``columns`` of the row of ``right`` that has the same key and the latest time not after its own.

    Both sides are put together and sorted, and the last row of ``right`` is carried on, so no pairs are made. The scan
    runs per key and ``chunk`` of time, and what a chunk starts with comes from a second scan over one row per key and
    chunk, so the rows of a hot key are spread over many tasks. Of rows of ``right`` with equal key and time the one with
    the greatest ``columns`` counts. Rows of ``left`` without a key or a time, or without an earlier row, get NULL; rows of
    ``right`` without one are left out.
    """
    found = F.struct(F.col(time).alias("_time"), *columns)
    known = right.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = known.select(F.col(key).alias("_key"), F.col(time).alias("_at"), found.alias("_found"),
                        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    asked = left.select(F.col(key).alias("_key"), F.col(time).alias("_at"), F.lit(None).cast(rows.schema["_found"].dataType).alias("_found"),
                        F.struct("*").alias("_row"))
    both = rows.unionByName(asked).withColumn("_chunk", F.date_trunc(chunk, "_at"))

    def carried(value: Column, window: Window) -> Column:
        return F.last(value, ignorenulls=True).over(window)

    # At equal times the rows of ``right`` come first, in the order of their columns.
    inside = Window.partitionBy("_key", "_chunk").orderBy("_at", F.col("_row").isNotNull(), "_found").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = both.groupBy("_key", "_chunk").agg(F.max("_found").alias("_end"))
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_start", carried(F.col("_end"), before)).filter(F.col("_start").isNotNull()).select("_key", "_chunk", "_start")
    scanned = both.withColumn("_last", carried(F.col("_found"), inside)).filter(F.col("_row").isNotNull())
    joined = scanned.join(starts, ["_key", "_chunk"], "left").withColumn("_last", F.coalesce("_last", "_start"))
    timed = F.col("_at").isNotNull() & F.col("_key").isNotNull()
    return joined.select("_row.*", *(F.when(timed, F.col(f"_last.{c}")).alias(c) for c in columns))
