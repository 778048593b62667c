"""Bronze: raw rows as they arrive, plus where and when they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_audit(rows: DataFrame, source: str | None = None) -> DataFrame:
    """Add the ingest time, and the source label when the rows do not carry their file name."""
    audited = rows.withColumn("_bronze_ingested_at", F.current_timestamp())
    if "_source_file" in rows.columns:
        return audited
    return audited.withColumn("_source_file", F.lit(source))
