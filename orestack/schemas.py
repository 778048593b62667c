"""Declared schemas of the raw, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Totals are exact, so sums do not depend on the order of the rows: six decimals, and 22 digits before them.
# A price stays the double that was delivered.
MONEY = T.DecimalType(28, 6)

# Of the files of stored tables: smaller than those of the default codec.
COMPRESSION = "zstd"


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


def _strings(*names: str) -> T.StructType:
    return _struct(*((name, T.StringType()) for name in names))


# The columns of the raw tables.
RAW_ORDERS = _struct(
    ("order_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("product_id", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", T.DoubleType()),
    ("status", T.StringType()),
    ("order_date", T.StringType()),
    ("ingested_at", T.StringType()),
)

RAW_CUSTOMERS = _strings("customer_id", "name", "email", "phone", "city", "region", "created_at")

RAW_PRODUCTS = _strings("product_id", "name", "category", "price", "stock")

RAW_EVENTS = _struct(
    ("event_id", T.StringType()),
    ("session_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("event_type", T.StringType()),
    ("product_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("event_time", T.StringType()),
)

# product_id stays nullable: no rule rejects an order without a product.
SILVER_ORDERS = _struct(
    ("order_id", T.StringType(), False),
    ("customer_id", T.StringType(), False),
    ("product_id", T.StringType()),
    ("quantity", T.IntegerType(), False),
    ("unit_price", T.DoubleType(), False),
    ("status", T.StringType(), False),
    ("order_date", T.DateType(), False),
    ("total_amount", MONEY),
    ("_silver_updated_at", T.TimestampType(), False),
)

# What tells the newer of two copies of an order, in this order.
ARRIVAL = _struct(
    ("ingested_at", T.StringType()),
    ("product_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", T.DoubleType()),
    ("status", T.StringType()),
    ("order_date", T.DateType()),
)

# What a silver order stores of it: a merge takes the other columns from the newest copy, but keeps customer and product.
STORED_ARRIVAL = T.StructType(ARRIVAL.fields[:3])

SILVER_CUSTOMERS = _struct(
    ("customer_id", T.StringType(), False),
    ("name", T.StringType()),
    ("email", T.StringType(), False),
    ("phone", T.StringType()),
    ("city", T.StringType()),
    ("region", T.StringType(), False),
    ("created_date", T.DateType()),
    ("_silver_updated_at", T.TimestampType(), False),
)

# The columns of the fact.
FACT_COLUMNS = (
    "order_id", "order_date", "order_year", "order_month", "order_quarter",
    "customer_id", "customer_name", "region",
    "product_id", "product_name", "category",
    "quantity", "unit_price", "total_amount", "is_high_value",
    "status", "_gold_created_at",
)

# One row per report of a streaming query.
PROGRESS = _struct(
    ("run_id", T.StringType()),
    ("batch_id", T.LongType()),
    ("started_at", T.StringType()),
    ("input_rows", T.LongType()),
    ("milliseconds", T.LongType()),
)

# One row per committed version of a versioned table. ``chain`` names the versions whose rows make up
# its contents, oldest first, and ``lineage`` those whose changes led to them, also where a later one that follows them holds
# the whole table (NULL in commits of older tables, whose chain tells). ``source_version`` is the version of another table
# up to which its rows are merged here.
COMMITS = _struct(
    ("_version", T.LongType()),
    ("chain", T.ArrayType(T.LongType())),
    ("committed_at", T.TimestampType()),
    ("operation", T.StringType()),
    ("rows_inserted", T.LongType()),
    ("rows_updated", T.LongType()),
    ("table_schema", T.StringType()),
    ("source_version", T.LongType()),
    ("lineage", T.ArrayType(T.LongType())),
)
