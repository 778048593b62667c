from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import samples
from orestack import schemas
from orestack.plans import bronze
from orestack.sources import files, star_tables, workspace

HEADER = "order_id,customer_id,product_id,quantity,unit_price,status,order_date,ingested_at\n"
DATA = "/root/testdata/sf0.001"


def test_csv_keeps_rows_with_bad_cells_and_short_lines(spark, folder):
    path = Path(folder) / "orders.csv"
    path.write_text(HEADER + "A,C1,P1,2,1.5,pending,2024-01-05,t1\nB,C1,P1,x,1.5,Đã giao,2024-01-05,t1\nC,C1\n",
                    encoding="utf-8")
    orders = files.read_orders(spark, str(path))
    assert samples.rows(orders, "order_id", "quantity", "status") == [
        ("A", 2, "pending"), ("B", None, "Đã giao"), ("C", None, None)]
    audited = bronze.with_audit(orders)
    assert samples.rows(audited, "_source_file") == [("orders.csv",)] * 3


def test_csv_binds_columns_by_position(spark, folder):
    path = Path(folder) / "products.csv"
    path.write_text("name,product_id,category,price,stock\nP1,Lamp,Home,1,2\n")
    assert samples.rows(files.read_products(spark, str(path)), "product_id", "name") == [("P1", "Lamp")]


def test_customers_are_read_as_text(spark, folder):
    path = Path(folder) / "customers.csv"
    path.write_text(",".join(schemas.RAW_CUSTOMERS.names) + "\n007,An,a@x,09,Hue,North,2022-03-01\n")
    assert files.read_customers(spark, str(path)).first()["customer_id"] == "007"


def test_batches_cover_every_order_line_once(spark):
    batches = star_tables.raw_order_batches(spark, DATA)
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert sum(batch.count() for batch in batches) == star_tables.raw_orders(spark, DATA).count() == lines


def test_the_raw_frames_fit_the_declared_schemas(spark):
    assert star_tables.raw_orders(spark, DATA).schema.names == schemas.RAW_ORDERS.names
    assert star_tables.raw_customers(spark, DATA).schema.names == schemas.RAW_CUSTOMERS.names
    assert star_tables.raw_products(spark, DATA).schema.names == schemas.RAW_PRODUCTS.names
    assert star_tables.raw_events(spark, DATA).schema.names == schemas.RAW_EVENTS.names


class _Conf:
    def __init__(self, **settings):
        self.settings = {name.replace("_", "."): value for name, value in settings.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)


class _Session:
    def __init__(self, **settings):
        self.conf = _Conf(**settings)


def test_shared_folder_follows_the_cluster_setting():
    folder = workspace.new_folder(_Session(spark_checkpoint_dir="s3://shared/", spark_master="yarn"), "lake")
    assert folder.startswith("s3://shared/orestack/lake-")
    with pytest.raises(RuntimeError):
        workspace.new_folder(_Session(spark_master="yarn"), "lake")


def test_lines_without_a_ship_date_are_in_the_last_batch(spark, folder):
    for name in ("lineitem", "orders"):
        table = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name == "lineitem":
            table = table.withColumn("l_shipdate", F.when(F.col("l_linenumber") != 2, F.col("l_shipdate")))
        table.write.parquet(f"{folder}/{name}.parquet")
    counts = [batch.count() for batch in star_tables.raw_order_batches(spark, folder)]
    missing = spark.read.parquet(f"{folder}/lineitem.parquet").filter("l_shipdate IS NULL").count()
    assert sum(counts) == star_tables.raw_orders(spark, folder).count() and counts[2] >= missing > 0
