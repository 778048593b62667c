"""The star-schema test tables, presented as raw orders, customers, products and events.

Every row of the tables becomes a raw row. The tables are clean, so the mapping makes some cells
dirty by fixed rules; it never drops a row. The rules look at the part key of a line because it
differs between the copies of an order line: the newest copy may then be the invalid one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orestack import settings

# Every n-th part or customer key gets the named defect.
PART_WITHOUT_ORDER_ID = 101
PART_WITH_ZERO_QUANTITY = 103
PART_WITH_UNKNOWN_STATUS = 107
PART_WITH_BAD_DATE = 109
CUSTOMER_WITHOUT_AT_SIGN = 13
CUSTOMER_WITHOUT_EMAIL = 17
CUSTOMER_WITH_BAD_DATE = 19

# Customers of the fifth region, MIDDLE EAST, are rejected and leave orders without a region.
VALID_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")

# The order lines arrive in three batches by ship date: before the first date, up to the second, rest.
BATCH_DATES = ("1998-01-01", "2000-01-01")


# Declared, so that planning reads no file footers.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def order_bytes(spark: SparkSession, folder: str) -> int:
    """The size of the order lines, which are the raw orders, as rows in memory."""
    return settings.row_bytes(_table(spark, folder, "lineitem"), settings.PARQUET_GROWTH)


def raw_orders(spark: SparkSession, folder: str, batch: Column | None = None) -> DataFrame:
    """Order lines as raw orders, optionally those of one arrival batch."""
    lines = _table(spark, folder, "lineitem")
    if batch is not None:
        lines = lines.filter(batch)
    # What a line says of its status, as a number: a join of large tables shuffles the lines.
    said = (
        F.when(_every("l_partkey", PART_WITH_UNKNOWN_STATUS), 1)
        .when(F.col("l_returnflag") == "R", 2)
        .when(F.col("l_linestatus") == "F", 3)
        .otherwise(4)
    )
    quantity = F.when(_every("l_partkey", PART_WITH_ZERO_QUANTITY), 0).otherwise(F.col("l_quantity").cast("int"))
    lines = lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate", quantity.alias("quantity"),
        said.cast("tinyint").alias("said"))
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    status = (
        F.when(F.col("said") == 1, "unknown")
        .when(F.col("said") == 2, " CANCELLED ")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("said") == 3, "confirmed")
        .otherwise("pending")
    )
    order_id = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    order_date = F.col("o_orderdate").cast("string")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.when(~_every("l_partkey", PART_WITHOUT_ORDER_ID), order_id).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        "quantity",
        F.col("l_extendedprice").alias("unit_price"),
        status.alias("status"),
        F.when(_every("l_partkey", PART_WITH_BAD_DATE), "2024-13-45").otherwise(order_date).alias("order_date"),
        F.col("l_shipdate").cast("string").alias("ingested_at"),
    )


def raw_order_batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """All order lines as three arrival batches that share no line; without a ship date they come last."""
    first, second = (F.coalesce(F.col("l_shipdate") < F.lit(date).cast("timestamp_ntz"), F.lit(False)) for date in BATCH_DATES)
    return [raw_orders(spark, folder, batch) for batch in (first, second & ~first, ~second)]


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with padded texts. Nation and region have 25 and 5 rows at every scale."""
    key = F.col("c_custkey").cast("string")
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    email = (
        F.when(_every("c_custkey", CUSTOMER_WITHOUT_EMAIL), None)
        .when(_every("c_custkey", CUSTOMER_WITHOUT_AT_SIGN), F.concat(F.lit(" No.At."), key))
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM ")))
    )
    created_at = F.when(_every("c_custkey", CUSTOMER_WITH_BAD_DATE), "2022-02-30").otherwise("2022-03-01")
    return _table(spark, folder, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        key.alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        email.alias("email"),
        F.concat(F.lit("09 "), key, F.lit("\t 1")).alias("phone"),
        F.concat(F.lit(" "), F.col("n_name")).alias("city"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("region"),
        created_at.alias("created_at"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products."""
    return _table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_size").cast("string").alias("stock"),
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the raw event columns; the tables know no session or product of an event."""
    return _table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit(None).cast("string").alias("session_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        "event_type",
        F.lit(None).cast("string").alias("product_id"),
        F.col("value").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
    )
