"""What a lake leaves on disk while it is written, and large refreshes of it."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as ClassicFrame

import samples
from orestack import registry, schemas, settings
from orestack.operators import versioned
from orestack.operators.partitioned import PartitionedTable
from orestack.operators.versioned import VersionedTable
from orestack.plans import gold, pipeline, silver


def _order(key, customer="C1", product="P1", quantity=1, price=2.0, status="pending", day="2024-01-05", arrived="1"):
    return (key, customer, product, quantity, price, status, day, arrived)


def _shuffles(spark) -> set[str]:
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def _left(spark, before) -> set[str]:
    """Shuffle files that stay for ten seconds."""
    for _ in range(40):
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_a_write_leaves_no_shuffle_files(spark, folder):
    rows = spark.range(200).selectExpr("id AS k", "id % 3 AS month").repartition(4, "k")
    before = _shuffles(spark)
    table = VersionedTable(spark, f"{folder}/versioned", key=["k"])
    table.merge(rows)
    table.merge(rows.filter("k < 50"))
    VersionedTable(spark, f"{folder}/months").overwrite(rows, ["month"])
    months = PartitionedTable(spark, f"{folder}/partitioned", ["month"])
    months.replace(rows)
    months.replace_partitions(rows.filter("month = 1"), [(1,)])
    registry._write_csv(rows, f"{folder}/rows.csv")
    assert not _left(spark, before)
    assert table.current().count() == months.current().count() == 200


def test_a_session_keeps_its_own_way_with_shuffle_files(spark):
    before = spark.conf.get(settings._CLEANUP)
    rows = spark.range(100).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    with settings.tidy(spark):
        assert spark.conf.get(settings._CLEANUP) == "true"
        first = samples.rows(rows)
    assert spark.conf.get(settings._CLEANUP) == before and samples.rows(rows) == first


def test_replaced_partitions_are_computed_once(spark, folder, monkeypatch):
    table = PartitionedTable(spark, folder, ["year", "month"])
    frame = lambda rows: spark.createDataFrame(rows, "year int, month int, v int")
    table.replace(frame([(1, 1, 1), (1, 2, 2), (2, 1, 3), (2, 2, 4)]))
    with monkeypatch.context() as patched:
        patched.setattr(ClassicFrame, "collect", lambda *_: pytest.fail("the rows were computed a second time"))
        table.replace_partitions(frame([(1, 2, 9)]), [(1, 1), (1, 2)])
    assert samples.rows(table.current().select("year", "month", "v")) == [(1, 2, 9), (2, 1, 3), (2, 2, 4)]
    table.replace_partitions(frame([(2, 1, 0)]).filter("v > 0"), [(2, 1)])
    assert samples.rows(table.current().select("year", "month", "v")) == [(1, 2, 9), (2, 2, 4)]


ARRIVALS = (
    [_order("A", arrived="5"), _order("B", arrived="5", status="shipped"), _order("C", arrived="5"), _order(None)],
    [_order("A", "C2", "P2", 3, arrived="6"), _order("B", quantity=9, arrived="4", day="2024-03-01"), _order("D", arrived="6", day="2024-02-01")],
    [_order("C", arrived="5", quantity=2), _order("D", arrived="5", quantity=8), _order("E", product=None, arrived="7", status="lost"),
     _order("F", product=None, arrived="7")],
)


def _refreshed(spark, folder):
    lake = pipeline.Lake(spark, folder)
    pipeline.refresh_silver_customers(lake, samples.raw_customers(spark))
    for number, rows in enumerate(ARRIVALS):
        pipeline.ingest_orders(lake, samples.raw_orders(spark, list(rows)))
        pipeline.refresh_silver_orders(lake)
        if number == 1:
            pipeline.refresh_fact_months(lake, samples.raw_products(spark))
    months = pipeline.refresh_fact_months(lake, samples.raw_products(spark), since=1)
    table = lake.silver_orders
    found = [samples.rows(table.as_of_version(version).drop("_silver_updated_at")) for version in range(3)]
    found += [samples.rows(table.changes(version).drop("_silver_updated_at")) for version in range(3)]
    found += [samples.rows(rows.select("order_id", "quantity")) for rows in table.differing(0, 2)]
    found += [samples.rows(table.current(hidden=True).select("order_id", "_arrival")), samples.rows(lake.order_counts.current()),
              samples.rows(lake.fact_months.current().drop("_gold_created_at")), samples.rows(table.history().drop("committed_at")), months]
    return lake, found


@pytest.mark.parametrize("parts, last", [(2 ** 40, [2]), (0, [0, 1, 2])])
def test_a_large_refresh_reads_silver_once(spark, folder, monkeypatch, parts, last):
    """With a batch that is large beside silver as a new base, and else over its chain: the same versions and changes."""
    _, staged = _refreshed(spark, f"{folder}/staged")
    assert [row[:4] for row in staged[2]] == [
        ("A", "C1", "P1", 3), ("B", "C1", "P1", 1), ("C", "C1", "P1", 2), ("D", "C1", "P1", 1), ("F", "C1", None, 1)]
    assert staged[-1] == [(2024, 1)]
    monkeypatch.setattr(versioned, "STAGED_BYTES", -1)
    monkeypatch.setattr(pipeline, "MOST_PARTS", parts)
    monkeypatch.setattr(silver, "not_older", lambda *_, **__: pytest.fail("silver was read twice"))
    lake, found = _refreshed(spark, f"{folder}/large")
    assert found == staged
    assert lake.silver_orders._newest()["chain"] == last and lake.silver_orders._newest()["lineage"] == [0, 1, 2]


def test_a_base_that_follows_tells_its_changes_only(spark, folder):
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    table = VersionedTable(spark, folder, key=["k"])
    table.merge(frame([("a", 1), ("b", 1)]))
    table.merge(frame([("b", 2), ("c", 2)]), new_base=True, staged=False, follows=True)
    table.merge(frame([("c", 3)]))
    before, after = table.differing(0, 2)
    assert (samples.rows(before), samples.rows(after)) == ([("b", 1)], [("b", 2), ("c", 3)])
    assert samples.rows(table.current()) == [("a", 1), ("b", 2), ("c", 3)]
    table.restore(1)
    assert samples.rows(table.differing(0, 3)[1]) == [("b", 2), ("c", 2)]
    # Commits of older tables have a chain alone.
    old = VersionedTable(spark, f"{folder}-old", key=["k"])
    table.commits().drop("lineage").write.partitionBy("_version").parquet(f"{folder}-old/commits")
    old._rows = table._rows
    assert samples.rows(old.current()) == [("a", 1), ("b", 2), ("c", 2)]
    assert [samples.rows(rows) for rows in old.differing(1, 2)] == [[("c", 2)], [("c", 3)]]


@pytest.mark.parametrize("whole", [False, True])
def test_a_merge_leaves_rows_of_a_higher_rank_alone(spark, whole):
    current = spark.createDataFrame([("a", 5, "x"), ("b", 1, "x"), ("c", 3, "x"), ("e", None, "x")], "k string, rank int, v string")
    source = spark.createDataFrame([("a", 4, "y", True), ("b", 1, "y", False), ("d", None, "y", False), ("e", 0, "y", True)],
                                   "k string, rank int, v string, gone boolean")
    rank = lambda prefix: F.struct(F.col(f"{prefix}rank"))
    rows = versioned.merge_changes(source, current, ["k"], deleted="gone", cut=False, whole=whole, newer=rank)
    kept = [("a", 5, "x", "K"), ("c", 3, "x", "K")] if whole else []
    assert samples.rows(rows) == sorted([*kept, ("b", 1, "y", "U"), ("d", None, "y", "I"), ("e", 0, "y", "D")], key=repr)
    with pytest.raises(ValueError, match="rank"):
        versioned.merge_changes(source, current, ["k"], cut=False, whole=True, covering=True, newer=rank)


def test_short_orders_become_whole_again(spark):
    orders = silver.silver_orders(samples.raw_orders(spark)).drop("_silver_updated_at")
    plain = orders.selectExpr("* EXCEPT (total_amount, status)", "total_amount", "status")
    odd = plain.selectExpr("* EXCEPT (total_amount, status)",
                           "CASE order_id WHEN 'A' THEN CAST(1.5 AS decimal(28, 6)) WHEN 'B' THEN NULL ELSE total_amount END AS total_amount",
                           "CASE order_id WHEN 'H' THEN 'lost' WHEN 'I' THEN NULL ELSE status END AS status")
    days = [f"DATE'{day}' AS order_date" for day in ("0001-01-01", "1969-12-31", "9999-12-31")]
    edges = plain.limit(0)
    for day in days:
        edges = edges.union(plain.selectExpr(*("CASE order_id WHEN 'A' THEN 2147483647 ELSE quantity END AS quantity" if name == "quantity" else
                                               day if name == "order_date" else name for name in plain.columns)))
    edges = edges.withColumn("total_amount", (F.col("quantity") * F.col("unit_price")).cast(schemas.MONEY))
    negative = plain.withColumns({"quantity": F.lit(-3), "total_amount": (F.col("unit_price") * -3).cast(schemas.MONEY)})
    nulls = plain.withColumns({name: F.lit(None).cast(plain.schema[name].dataType) for name in ("quantity", "order_date", "total_amount")})
    for rows, struct_rows in ((plain, 0), (odd, 4), (edges, 0), (negative, 4), (nulls, 4)):
        short = silver.short_orders(rows)
        assert short.filter("total_amount IS NOT NULL").count() == struct_rows
        assert short.filter("quantity IS NULL").count() == struct_rows and "status" not in short.columns
        whole = silver.whole_orders(short).select(*rows.columns)
        assert whole.dtypes == rows.dtypes and samples.rows(whole) == samples.rows(rows)
    other = orders.withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)"))
    assert silver.whole_orders(silver.short_orders(other)).dtypes == other.dtypes
    assert schemas.COMMITS.names[-1] == "lineage"


def test_sums_of_a_stored_fact_are_not_shuffled_by_customer(spark, folder):
    rows = [_order(f"O{n}", f"C{n % 3}", ("P1", "P2", None, "P9")[n % 4], n % 5 + 1, 0.5 * n + 1, ("pending", "cancelled", "shipped")[n % 3 if n % 7 else 0],
                   f"2024-01-0{n % 2 + 1}") for n in range(60)]
    customers = [("C1", "An", "a@x", "1", "Hue", "North", "2022-03-01"), ("C2", "Bo", "b@x", "1", "Hue", "South", "2022-03-01")]
    gold.fact_orders(silver.silver_orders(samples.raw_orders(spark, rows)), silver.silver_customers(samples.raw_customers(spark, customers)),
                     samples.raw_products(spark)).write.parquet(f"{folder}/fact")
    fact = spark.read.parquet(f"{folder}/fact")
    daily, stored = gold.agg_revenue_daily(fact), gold.agg_revenue_daily(fact, stored=True)
    assert stored.dtypes == daily.dtypes
    found = samples.rows(daily.drop("_gold_created_at"))
    assert samples.rows(stored.drop("_gold_created_at")) == found and any(row[3] is None and row[4] is None for row in found)
    exchanges = [line for line in stored._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert sum("customer_id" in line for line in exchanges) == 1
    assert gold.agg_revenue_daily(fact.limit(0), stored=True).count() == 0
