"""Hand-written rows, one per rule of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orestack import schemas

ORDERS = [
    ("A", "C1", "P1", 2, 100.00, "pending", "2024-01-05", "2024-01-05T10:00"),
    ("A", "C1", "P1", 3, 100.00, " Shipped ", "2024-01-05", "2024-01-05T10:05"),
    ("B", "C1", "P2", 1, 50.00, "pending", "2024-01-06", "2024-01-06T09:00"),
    ("B", "C1", "P2", 0, 50.00, "pending", "2024-01-06", "2024-01-06T09:30"),
    (None, "C1", "P1", 1, 1.00, "pending", "2024-01-06", "2024-01-06T09:30"),
    ("D", None, "P1", 1, 1.00, "pending", "2024-01-06", "2024-01-06T09:30"),
    ("E", "C1", "P1", 1, -1.00, "pending", "2024-01-06", "2024-01-06T09:30"),
    ("F", "C1", "P1", 1, 1.00, "returned", "2024-01-06", "2024-01-06T09:30"),
    ("G", "C1", "P1", 1, 1.00, "pending", "2024-13-45", "2024-01-06T09:30"),
    ("H", "C9", "P9", 1, 1000000.00, "delivered", "2024-01-07", "2024-01-07T09:30"),
    ("I", "C1", None, 1, 999999.99, "cancelled", "2024-01-07", "2024-01-07T09:30"),
    ("J", "C1", "P1", 1, 1.00, None, "2024-01-07", "2024-01-07T09:30"),
]

CUSTOMERS = [
    ("C1", " An ", " AN@X.vn ", "09 1\t2", " Hue ", " North ", "2022-03-01"),
    ("C2", "No at", "no.at", "1", "Hue", "North", "2022-03-01"),
    ("C3", "No email", None, "1", "Hue", "North", "2022-03-01"),
    ("C4", "West", "w@x", "1", "Hue", "West", "2022-03-01"),
    (None, "No id", "n@x", "1", "Hue", "North", "2022-03-01"),
    ("C5", "Bad date", "b@x", "1", "Hue", "South", "2022-02-30"),
]

PRODUCTS = [("P1", "Lamp", "Home", "100", "5"), ("P2", "Ball", "Sports", "50", "5")]


def raw_orders(spark: SparkSession, rows=ORDERS) -> DataFrame:
    return spark.createDataFrame(rows, schemas.RAW_ORDERS)


def raw_customers(spark: SparkSession, rows=CUSTOMERS) -> DataFrame:
    return spark.createDataFrame(rows, schemas.RAW_CUSTOMERS)


def raw_products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTS, schemas.RAW_PRODUCTS)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows of the chosen columns in a fixed order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
