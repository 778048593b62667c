"""Merges of sources too large to be written and read twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import samples
from orestack import settings
from orestack.functions import rules
from orestack.operators import versioned
from orestack.operators.versioned import VersionedTable
from orestack.plans import silver

COLUMNS = "order_id string, customer_id string, quantity int"


def _history(spark, path, new_base):
    table = VersionedTable(spark, path, key=["order_id"], hidden=["customer_id"])
    table.merge(spark.createDataFrame([("A", "C1", 1), ("B", None, 2), ("U", "C9", None)], COLUMNS))
    batch = spark.createDataFrame([("A", "C2", 5), ("B", "C3", None), ("N", "C4", 7), ("Z", None, 8)], COLUMNS)
    flagged = batch.withColumns({"gone": F.col("order_id").isin("B", "Z"), "channel": F.lit("web")})
    table.merge(flagged, ["quantity"], new_base=new_base, deleted="gone")
    table.merge(batch.filter("order_id != 'A'"), new_base=new_base)
    found = [samples.rows(table._contents(table._commit_of(version), hidden=True)) for version in range(3)]
    return found, [samples.rows(table.changes(version), "order_id", "_op") for version in range(3)]


@pytest.mark.parametrize("new_base", [False, True])
def test_a_large_source_is_read_once_and_gives_the_same_versions(spark, folder, monkeypatch, new_base):
    staged = _history(spark, f"{folder}/staged", new_base)
    monkeypatch.setattr(versioned, "STAGED_BYTES", -1)
    monkeypatch.setattr(versioned, "new_folder", lambda *_: pytest.fail("a large source was written"))
    assert _history(spark, f"{folder}/joined", new_base) == staged
    assert [row[0] for row in staged[0][1]] == ["A", "N", "U"]


def test_arrived_orders_are_shuffled_once_for_a_merge(spark):
    valid = rules.keep_valid(silver.type_orders(samples.raw_orders(spark)), silver.order_rules())
    unique = versioned.one_row_per_key(silver.arrived_orders(valid), ["order_id"])
    assert unique._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_shuffles_are_sized_by_rows_and_not_by_files(spark, folder):
    spark.range(1000).write.parquet(f"{folder}/rows")
    scan = spark.read.parquet(f"{folder}/rows")
    assert settings.row_bytes(scan, settings.PARQUET_GROWTH) == 16 * settings.scan_bytes(scan)


def test_a_covering_source_gives_the_same_versions(spark, folder, monkeypatch):
    """Also where it does not name every key: the rows of the others are added by a second write."""
    monkeypatch.setattr(versioned, "STAGED_BYTES", -1)
    first = spark.createDataFrame([("A", "C1", 1), ("B", None, 2), ("D", "C5", 5), ("U", "C9", None)], COLUMNS)
    batch = spark.createDataFrame([("A", "C2", 5), ("B", "C3", None), ("D", "C5", 6), ("N", "C4", 7), ("Z", None, 8)], COLUMNS)
    batch = batch.withColumns({"gone": F.col("order_id").isin("D", "Z"), "channel": F.lit("web")})
    named = batch.union(spark.createDataFrame([("U", "C8", 3, False, "web")], batch.schema))
    for source in (batch, named):
        found = []
        for covering in (False, True):
            table = VersionedTable(spark, f"{folder}/{len(source.collect())}-{covering}", key=["order_id"], hidden=["customer_id"])
            table.merge(first)
            table.merge(source, ["quantity"], new_base=True, deleted="gone", covering=covering)
            found.append([samples.rows(table._contents(table._newest(), hidden=True)), samples.rows(table.changes(1)),
                          samples.rows(table.history().drop("committed_at"))])
        assert found[0] == found[1]
        assert [row[0] for row in found[1][0]] == ["A", "B", "N", "U"]


def test_a_covering_merge_reads_only_what_current_rows_keep(spark, folder):
    spark.createDataFrame([("A", "C1", 1)], COLUMNS).write.parquet(f"{folder}/current")
    current = spark.read.parquet(f"{folder}/current")
    rows = versioned.merge_changes(current, current, ["order_id"], ["quantity"], cut=False, whole=True, covering=True)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_kept_customer_id" in plan and "_kept_quantity" not in plan


def test_totals_are_made_after_the_shuffle_of_arrived_orders(spark, folder):
    silver.type_orders(samples.raw_orders(spark)).write.parquet(f"{folder}/typed")
    valid = rules.keep_valid(spark.read.parquet(f"{folder}/typed"), silver.order_rules())
    arrived = silver.arrived_orders(valid)
    before_shuffle = arrived._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1].splitlines()
    made = [line for line in before_shuffle if "Project [" in line]
    assert made and not any("total_amount" in line for line in made)
    expected = silver.unique_orders(valid).select("order_id", "total_amount")
    assert samples.rows(arrived, "order_id", "total_amount") == samples.rows(expected)
