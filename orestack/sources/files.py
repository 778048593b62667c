"""CSV readers with declared schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orestack import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType, with_file_name: bool = False) -> DataFrame:
    """A CSV file with a header in UTF-8, bound to the schema by position.

    A cell that does not fit its type becomes NULL and the row stays; a short line is filled with
    NULL. ``with_file_name`` adds the name of the file each row came from as ``_source_file``.
    """
    rows = spark.read.option("header", "true").option("encoding", "UTF-8").schema(schema).csv(path)
    return rows.select("*", F.col("_metadata.file_name").alias("_source_file")) if with_file_name else rows


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_ORDERS, with_file_name=True)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_CUSTOMERS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_PRODUCTS)
