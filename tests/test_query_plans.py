"""The physical plans keep the properties that make them scale."""

from __future__ import annotations

from contextlib import contextmanager

import pytest

import samples
from orestack import registry, settings
from orestack.operators import versioned
from orestack.operators.dedup import latest_per_key
from orestack.plans import gold, silver

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def large_tables(spark):
    """Plan as if nothing were small enough to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_cuts_groups_before_the_shuffle(spark):
    plan = _plan(latest_per_key(samples.raw_orders(spark), ["order_id"], "ingested_at"))
    before_shuffle = plan.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_scans_read_only_the_needed_columns(spark):
    plan = _plan(registry.agg_revenue_daily(spark, DATA))
    for unused in ("l_discount", "l_tax", "l_suppkey", "o_totalprice", "c_acctbal", "p_retailprice"):
        assert unused not in plan


def test_no_plan_needs_python_or_a_nested_loop(spark):
    for name in ("fact_orders", "agg_revenue_daily", "quality_orders", "orders_after_merge", "check_merge_idempotent"):
        plan = _plan(registry.queries()[name](spark, DATA))
        for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert slow not in plan, (name, slow)


def test_a_large_merge_shuffles_each_side_once(spark, large_tables):
    first, second, _ = (silver.silver_orders(batch) for batch in registry.star.raw_order_batches(spark, DATA))
    first = first.persist()
    second = second.persist()
    plan = _plan(versioned.merge_changes(second, first, ["order_id"], silver.ORDER_UPDATE_COLUMNS))
    assert "Broadcast" not in plan
    first.unpersist()
    second.unpersist()


@contextmanager
def _settings(spark, values):
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_hot_month_is_written_by_several_tasks(spark, folder):
    settings.apply(spark)
    rows = spark.range(0, 200000, 1, 8).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS order_id", "2024 AS order_year",
        "IF(id % 3 = 0, 1, CAST(2 + id % 11 AS INT)) AS order_month")
    table = versioned.VersionedTable(spark, folder)
    with _settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}):
        table.overwrite(rows, ["order_year", "order_month"])
    assert table.current().count() == 200000
    files = table.current().filter("order_month = 1").inputFiles()
    hot = [name for name in files if name.split("order_month=")[1].startswith("1/")]
    cold = [name for name in files if name.split("order_month=")[1].startswith("2/")]
    assert len(hot) > 1 and len(cold) == 1


def test_a_hot_customer_is_split(spark, large_tables):
    """One customer holds a third of the orders; the join must not leave them in one task."""
    settings.apply(spark)
    tuned = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with _settings(spark, tuned):
        orders = spark.range(0, 60000, 1, 16).selectExpr(
            "concat('O', id) AS order_id", "IF(id % 3 = 0, 'C0', concat('C', id)) AS customer_id",
            "'P1' AS product_id", "1 AS quantity", "CAST(2 AS DECIMAL(18,2)) AS unit_price",
            "'pending' AS status", "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS order_date",
            "CAST(2 AS DECIMAL(18,2)) AS total_amount")
        customers = spark.range(60000).selectExpr(
            "concat('C', id) AS customer_id", "concat('N', id) AS name", "'North' AS region")
        daily = gold.agg_revenue_daily(gold.fact_orders(orders, customers, samples.raw_products(spark)))
        counted = daily.selectExpr("sum(order_count) AS n")
        assert counted.collect()[0]["n"] == 60000
        assert "skew=true" in _plan(counted)
