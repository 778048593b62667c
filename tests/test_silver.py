from __future__ import annotations

import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import samples
from orestack import schemas
from orestack.functions import rules
from orestack.plans import bronze, silver


def test_clean_orders(spark):
    clean = silver.silver_orders(bronze.with_audit(samples.raw_orders(spark), "orders.csv"))
    assert clean.columns == schemas.SILVER_ORDERS.names
    assert samples.rows(clean, "order_id", "quantity", "status", "total_amount", "order_date") == [
        ("A", 3, "shipped", Decimal("300.00"), datetime.date(2024, 1, 5)),
        ("B", 1, "pending", Decimal("50.00"), datetime.date(2024, 1, 6)),
        ("H", 1, "delivered", Decimal("1000000.00"), datetime.date(2024, 1, 7)),
        ("I", 1, "cancelled", Decimal("999999.99"), datetime.date(2024, 1, 7)),
    ]


def test_required_columns_are_not_nullable(spark):
    clean = silver.silver_orders(samples.raw_orders(spark))
    assert {field.name for field in clean.schema.fields if field.nullable} == {"product_id", "total_amount"}


def test_every_reject_names_its_first_rule(spark):
    typed = silver.type_orders(samples.raw_orders(spark))
    rejected = rules.rejects(typed, silver.order_rules())
    assert samples.rows(rejected, "order_id", "rejected_by") == [
        ("B", "quantity_positive"), ("D", "customer_id_present"), ("E", "unit_price_positive"),
        ("F", "status_known"), ("G", "order_date_valid"), ("J", "status_known"),
        (None, "order_id_present"),
    ]


def test_accounting_adds_up(spark):
    typed = silver.type_orders(samples.raw_orders(spark))
    counts = rules.account(typed, silver.order_rules(), key="order_id").first().asDict()
    assert (counts["input_rows"], counts["valid_rows"], counts["rejected_rows"]) == (12, 5, 7)
    assert (counts["unique_rows"], counts["duplicate_rows"]) == (4, 1)
    assert counts["failed_status_known"] == 2


def test_text_cells_that_do_not_parse_become_null(spark):
    raw = spark.createDataFrame(
        [("A", "x", "y", "2024-1-5")], "order_id string, quantity string, unit_price string, order_date string"
    ).withColumn("status", F.lit("pending"))
    typed = silver.type_orders(raw).first()
    assert (typed["quantity"], typed["unit_price"], typed["total_amount"], typed["order_date"]) == (None,) * 4


def test_a_total_beyond_the_money_type_is_null(spark):
    huge = [("A", "C1", "P1", 2_000_000_000, 9e15, "pending", "2024-01-05", "2024-01-05")]
    assert silver.type_orders(samples.raw_orders(spark, huge)).first()["total_amount"] is None


def test_equal_arrival_times_have_a_fixed_winner(spark):
    pair = [("A", "C1", product, 1, 1.0, "pending", "2024-01-05", "2024-01-05") for product in ("P1", "P2")]
    for ordering in (pair, pair[::-1]):
        assert samples.rows(silver.silver_orders(samples.raw_orders(spark, ordering)), "product_id") == [("P2",)]


def test_missing_arrival_time_is_oldest(spark):
    pair = [("A", "C1", "P1", 1, 1.0, "pending", "2024-01-05", None),
            ("A", "C1", "P1", 2, 1.0, "pending", "2024-01-05", "2020-01-01")]
    assert samples.rows(silver.silver_orders(samples.raw_orders(spark, pair)), "quantity") == [(2,)]


def test_clean_customers(spark):
    clean = silver.silver_customers(samples.raw_customers(spark))
    assert samples.rows(clean.drop("_silver_updated_at")) == [
        ("C1", "An", "an@x.vn", "0912", "Hue", "North", datetime.date(2022, 3, 1)),
        ("C5", "Bad date", "b@x", "1", "Hue", "South", None),
    ]


def test_customer_accounting(spark):
    cleaned = silver.clean_customers(samples.raw_customers(spark))
    counts = rules.account(cleaned, silver.customer_rules()).first().asDict()
    assert (counts["valid_rows"], counts["rejected_rows"], counts["failed_email_has_at_sign"]) == (2, 4, 2)


def test_copies_of_a_customer_are_kept(spark):
    twice = [samples.CUSTOMERS[0], samples.CUSTOMERS[0]]
    assert silver.silver_customers(samples.raw_customers(spark, twice)).count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(-1, 3), st.integers(0, 5)), max_size=15))
def test_the_newest_valid_copy_survives(spark, drawn):
    raw = [(key, "C", "P", quantity, 1.0, "pending", "2024-01-05", f"2024-01-0{arrived + 1}")
           for key, quantity, arrived in drawn]
    expected = {}
    for key, _, _, quantity, *_, arrived in raw:
        if quantity > 0:
            expected[key] = max(expected.get(key, ("", 0)), (arrived, quantity))
    clean = silver.silver_orders(samples.raw_orders(spark, raw))
    assert samples.rows(clean, "order_id", "quantity") == sorted(
        (key, quantity) for key, (_, quantity) in expected.items())


def test_no_price_is_lost(spark):
    rows = [("A", "C", "P", 100, 0.004, "pending", "2024-01-05", "1"), ("B", "C", "P", 1, 1e16, "pending", "2024-01-05", "1"),
            ("C", "C", "P", 10, 9e15, "pending", "2024-01-05", "1"), ("D", "C", "P", 10, 9e23, "pending", "2024-01-05", "1")]
    raw = samples.raw_orders(spark, rows)
    assert samples.rows(silver.silver_orders(raw), "order_id", "total_amount") == [
        ("A", Decimal("0.4")), ("B", Decimal(10 ** 16)), ("C", Decimal(9 * 10 ** 16))]
    rejected = rules.rejects(silver.type_orders(raw), silver.order_rules())
    assert samples.rows(rejected, "order_id", "rejected_by") == [("D", "total_fits")]


def test_prices_stay_as_delivered(spark):
    prices = {"A": (1_000_000, 0.00004), "B": (3, 0.12345), "C": (1, 1e24), "D": (1, 0.0), "E": (2, 1e20), "F": (1, float("nan")),
              "G": (1, float("inf")), "H": (1, 1e-9)}
    raw = samples.raw_orders(spark, [(k, "C", "P", n, p, "pending", "2024-01-05", "1") for k, (n, p) in prices.items()])
    kept = samples.rows(silver.silver_orders(raw), "order_id", "unit_price", "total_amount")
    assert kept == [("A", 0.00004, Decimal(40)), ("B", 0.12345, Decimal("0.37035")), ("E", 1e20, Decimal(2 * 10 ** 20)),
                    ("H", 1e-9, Decimal(0))]
    rejected = rules.rejects(silver.type_orders(raw), silver.order_rules())
    assert samples.rows(rejected, "order_id", "rejected_by") == [
        ("C", "total_fits"), ("D", "unit_price_positive"), ("F", "total_fits"), ("G", "total_fits")]


def test_a_split_reads_its_input_once(spark, folder):
    samples.raw_orders(spark).write.parquet(f"{folder}/raw")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    raw = spark.read.parquet(f"{folder}/raw")
    typed = silver.type_orders(raw.mapInPandas(seen, raw.schema))
    parts = rules.split(typed, silver.order_rules(), f"{folder}/parts")
    assert (parts.valid.count(), parts.rejected.count(), read.value) == (5, 7, 12)
    plain = silver.type_orders(raw)
    assert samples.rows(parts.rejected) == samples.rows(rules.rejects(plain, silver.order_rules()))
    assert samples.rows(parts.valid) == samples.rows(rules.keep_valid(plain, silver.order_rules()))
    assert parts.counts == rules.account(plain, silver.order_rules()).first().asDict()
    none = rules.split(plain.limit(0), silver.order_rules(), f"{folder}/none")
    assert none.valid.count() == none.rejected.count() == none.counts["input_rows"] == 0


def test_accounting_takes_one_scan(spark, folder):
    samples.raw_orders(spark).write.parquet(f"{folder}/raw")
    counted = rules.account(silver.type_orders(spark.read.parquet(f"{folder}/raw")), silver.order_rules(), key="order_id")
    assert counted._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_the_parts_are_written_without_a_sort(spark, folder, monkeypatch):
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(spark.conf.get(name, None))
        return write(self, *args, **kwargs)

    before = spark.conf.get(name, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    parts = rules.split(silver.type_orders(samples.raw_orders(spark)), silver.order_rules(), f"{folder}/parts")
    assert seen == ["3"] and spark.conf.get(name, None) == before
    assert (parts.valid.count(), parts.rejected.count()) == (parts.counts["valid_rows"], parts.counts["rejected_rows"])
