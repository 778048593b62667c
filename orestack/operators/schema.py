"""Schema enforcement, evolution and listing."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Never returned: they only tell Spark that the column cannot be NULL past the check.
_PLACEHOLDERS = {
    T.StringType: "",
    T.IntegerType: 0,
    T.LongType: 0,
    T.DoubleType: 0.0,
    T.DecimalType: Decimal(0),
    T.BooleanType: False,
    T.DateType: datetime.date(1970, 1, 1),
    T.TimestampType: datetime.datetime(1970, 1, 1),
}


class SchemaMismatch(ValueError):
    """The frame has columns that the declared schema does not know."""


def _not_null(field: T.StructField) -> Column:
    placeholder = F.lit(_PLACEHOLDERS[type(field.dataType)]).cast(field.dataType)
    fail = F.raise_error(F.lit(f"NULL in required column {field.name}")).cast(field.dataType)
    return F.coalesce(F.col(field.name), fail, placeholder).alias(field.name)


def enforce(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Fit a frame to a declared schema, or fail.

    A wrong type or a missing required column fails at once. A NULL in a required column fails the
    job that meets it. An unknown column fails when ``strict``, and is dropped otherwise. A missing
    optional column becomes NULL.
    """
    unknown = [name for name in df.columns if name not in schema.names]
    if strict and unknown:
        raise SchemaMismatch(f"columns not in the declared schema: {unknown}")
    required = {field.name: field for field in schema.fields if not field.nullable}
    checked = df.select(*(
        _not_null(T.StructField(field.name, field.dataType)) if field.name in required else F.col(field.name)
        for field in df.schema.fields
    ))
    return checked.to(schema)


def append_evolving(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both frames; a column that one of them lacks is NULL there."""
    return existing.unionByName(new, allowMissingColumns=True)


def describe(df: DataFrame) -> DataFrame:
    """Column listing in one pass over the rows: position, name, type and filled cells."""
    filled = df.agg(*(F.count(F.col(name)).alias(name) for name in df.columns))
    listing = F.array(*(
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(field.name).alias("filled_rows"),
        )
        for position, field in enumerate(df.schema.fields, start=1)
    ))
    return filled.select(F.inline(listing))
