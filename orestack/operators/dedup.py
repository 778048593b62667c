"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``newest`` per key; NULL counts as oldest.

    ``tiebreak`` columns, taken in descending order, make the choice repeatable. Filtering the row
    number to 1 lets Spark keep one row per key and task before the shuffle, so a key that holds a
    large share of all rows sends one row per map task and not its whole group.
    """
    order = [F.col(name).desc_nulls_last() for name in (newest, *tiebreak)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
