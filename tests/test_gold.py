from __future__ import annotations

import datetime
from decimal import Decimal

import samples
from orestack import schemas
from orestack.plans import gold, reports, silver


def _fact(spark, customers=samples.CUSTOMERS):
    return gold.fact_orders(
        silver.silver_orders(samples.raw_orders(spark)),
        silver.silver_customers(samples.raw_customers(spark, customers)),
        samples.raw_products(spark))


def test_fact_keeps_orders_without_dimension_rows(spark):
    fact = _fact(spark)
    assert tuple(fact.columns) == schemas.FACT_COLUMNS
    assert samples.rows(fact, "order_id", "customer_name", "region", "category", "is_high_value") == [
        ("A", "An", "North", "Home", False),
        ("B", "An", "North", "Sports", False),
        ("H", None, None, None, True),
        ("I", "An", "North", None, False),
    ]


def test_calendar_columns(spark):
    assert samples.rows(_fact(spark), "order_year", "order_month", "order_quarter")[0] == (2024, 1, 1)


def test_a_repeated_customer_fans_out(spark):
    twice = [samples.CUSTOMERS[0], samples.CUSTOMERS[0]]
    assert _fact(spark, twice).count() == 3 * 2 + 1


def test_threshold_is_a_parameter(spark):
    orders = silver.silver_orders(samples.raw_orders(spark))
    fact = gold.fact_orders(
        orders, silver.silver_customers(samples.raw_customers(spark)), samples.raw_products(spark), Decimal(300))
    assert samples.rows(fact.filter("is_high_value"), "order_id") == [("A",), ("H",), ("I",)]


def test_daily_aggregate_excludes_cancelled(spark):
    daily = gold.agg_revenue_daily(_fact(spark))
    assert samples.rows(daily, "order_date", "region", "category", "order_count", "revenue",
                        "avg_order_value", "units_sold", "customer_count", "high_value_orders") == [
        (datetime.date(2024, 1, 5), "North", "Home", 1, Decimal("300.00"), 300.0, 3, 1, 0),
        (datetime.date(2024, 1, 6), "North", "Sports", 1, Decimal("50.00"), 50.0, 1, 1, 0),
        (datetime.date(2024, 1, 7), None, None, 1, Decimal("1000000.00"), 1000000.0, 1, 1, 1),
    ]


def test_revenue_is_rounded_per_group(spark):
    lines = [(f"O{n}", "C1", "P1", 1, 0.50, "pending", f"2024-01-0{n}", "2024-01-05") for n in (1, 2, 3)]
    fact = gold.fact_orders(
        silver.silver_orders(samples.raw_orders(spark, lines)),
        silver.silver_customers(samples.raw_customers(spark)), samples.raw_products(spark))
    daily = gold.agg_revenue_daily(fact)
    assert reports.total_revenue(daily).first()["revenue"] == Decimal("3.00")


def test_preview_is_ordered(spark):
    first = reports.preview(_fact(spark), ["order_id", "region"], ["order_id"], 2)
    assert [tuple(row) for row in first.collect()] == [("A", "North"), ("B", "North")]


def _daily(spark):
    return spark.createDataFrame([
        (datetime.date(2024, 1, 1), "N", "X", 2, Decimal("2000000.00"), 1000000.0, 3),
        (datetime.date(2024, 1, 2), "N", "Y", 1, Decimal("4000000.00"), 4000000.0, 1),
        (datetime.date(2024, 1, 2), None, "Y", 1, Decimal("500000.00"), 500000.0, 1),
    ], "order_date date, region string, category string, order_count bigint, revenue decimal(28,2), "
       "avg_order_value double, units_sold bigint")


def test_reports_over_the_daily_aggregate(spark):
    daily = _daily(spark)
    assert [tuple(r) for r in reports.top_days(daily, 1).collect()] == [(datetime.date(2024, 1, 2), Decimal("4.50"))]
    assert [tuple(r) for r in reports.by_region(daily).collect()] == [
        ("N", Decimal("6.00"), 3), (None, Decimal("0.50"), 1)]
    assert [r["category"] for r in reports.by_category(daily).collect()] == ["Y", "X"]
    averages = reports.region_averages(daily).first()
    assert (averages["avg_of_daily_avg_thousands"], averages["avg_order_thousands"]) == (2500.0, 2000.0)
    assert samples.rows(reports.category_units(daily), "category", "units_sold") == [("X", 3), ("Y", 2)]
    assert samples.rows(reports.region_share(daily), "region", "share_percent") == [("N", 75.0), (None, 25.0)]


def test_reports_over_the_fact(spark):
    fact = _fact(spark)
    assert [tuple(r) for r in reports.high_value(fact).collect()] == [
        ("High Value", 1, Decimal("1.00"), 1000.0), ("Normal", 3, Decimal("1.00"), 333.4)]
    assert samples.rows(reports.by_status(fact), "status", "order_count") == [
        ("cancelled", 1), ("delivered", 1), ("pending", 1), ("shipped", 1)]
    assert samples.rows(reports.monthly_trend(fact), "month", "order_count") == [("2024-01", 4)]


def test_customers_by_region(spark):
    customers = silver.silver_customers(samples.raw_customers(spark))
    assert samples.rows(reports.customers_by_region(customers)) == [("North", 1), ("South", 1)]
