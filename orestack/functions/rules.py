"""Quality rules: named conditions a row must meet, with accounting of the rows that do not.

A condition that evaluates to NULL counts as not met, which is what a filter does with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from orestack import schemas, settings


class Rule(NamedTuple):
    name: str
    condition: Column


def _met(rule: Rule) -> Column:
    return F.coalesce(rule.condition, F.lit(False))


def all_met(rules: Sequence[Rule]) -> Column:
    """True when every rule is met; never NULL."""
    return reduce(lambda left, right: left & right, (_met(rule) for rule in rules))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule. The plain conditions are kept so that they push down."""
    return df.filter(reduce(lambda left, right: left & right, (rule.condition for rule in rules)))


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail a rule, with the name of the first rule they fail in ``rejected_by``."""
    first = F.coalesce(*(F.when(~_met(rule), F.lit(rule.name)) for rule in rules))
    return df.withColumn("rejected_by", first).filter(F.col("rejected_by").isNotNull())


def counts(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates: input, valid and rejected rows, and failures of every rule."""
    valid = all_met(rules)
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("rejected_rows"),
        *(F.count_if(~_met(rule)).alias(f"failed_{rule.name}") for rule in rules),
    ]


def account(df: DataFrame, rules: Sequence[Rule], key: str | None = None) -> DataFrame:
    """One row of counts: input, valid, rejected, and failures of every rule.

    With ``key``, also the valid rows left after keeping one row per key. Everything is counted in one pass: rows
    are first aggregated per valid key, and those of a hot key, or without one, before the shuffle.
    """
    if key is None:
        return df.agg(*counts(rules))
    result = df.agg(*counts(rules), F.count_distinct(F.when(all_met(rules), F.col(key))).alias("unique_rows"))
    return result.withColumn("duplicate_rows", F.col("valid_rows") - F.col("unique_rows"))


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def set_aside(df: DataFrame, rules: Sequence[Rule], path: str) -> Split:
    """As ``split``, for rows of stored files: only the rejected rows are written to ``path``.

    The valid ones are the input under the rules. So stored rows are read and typed twice, and not written a second time.
    """
    observed = Observation()
    rejected = rejects(df.observe(observed, *counts(rules)), rules)
    with settings.tidy(df.sparkSession):
        rejected.write.option("compression", schemas.COMPRESSION).parquet(path)
    return Split(keep_valid(df, rules), df.sparkSession.read.schema(rejected.schema).parquet(path), observed.get)


def split(df: DataFrame, rules: Sequence[Rule], path: str) -> Split:
    """The rows, written once to ``path``, as valid ones and rejected ones with ``rejected_by``, and all counts.

    The counts are observed on the write, so the input is read and typed a single time whatever is done
    with the parts. A task has the files of both parts open: to sort its rows by part would spill those of a large file.
    """
    first = F.coalesce(*(F.when(~_met(rule), F.lit(rule.name)) for rule in rules))
    observed = Observation()
    marked = df.observe(observed, *counts(rules)).withColumns({"rejected_by": first, "_rejected": first.isNotNull()})
    with settings.tidy(df.sparkSession), settings.open_files(df.sparkSession, 3):  # one more than the parts: at the limit Spark sorts again
        marked.write.option("compression", schemas.COMPRESSION).partitionBy("_rejected").parquet(path)
    rows = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Split(rows.filter(~F.col("_rejected")).drop("_rejected", "rejected_by"), rows.filter("_rejected").drop("_rejected"),
                 observed.get)
