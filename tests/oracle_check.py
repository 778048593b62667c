"""Compares registered queries with their SQL counterparts, row for row.

Usage: python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def differences(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides have the same columns, value types and rows."""
    names = sorted(actual.columns)
    expected = connection.execute(sql)
    order = [column[0] for column in expected.description]
    if sorted(order) != names:
        return f"columns {names} != {sorted(order)}"
    at = [order.index(name) for name in names]
    want = Counter(tuple(repr(row[i]) for i in at) for row in expected.fetchall())
    got = Counter(tuple(repr(row[name]) for name in names) for row in actual.collect())
    if want == got:
        return ""
    missing, extra = want - got, got - want
    return (f"{sum(got.values())} rows, expected {sum(want.values())}; missing {list(missing)[:2]}, "
            f"unexpected {list(extra)[:2]}")


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    sqls, database = entry.oracle_sql(), connect(data)
    for name in chosen:
        start = time.time()
        try:
            outcome = differences(entry.queries()[name](spark, data), database, sqls[name])
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not outcome else 'FAIL'} {name} {time.time() - start:.1f}s {outcome}", flush=True)
