"""The queries that SQL can express against it, on the small tables and on awkward documents."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import oracle_check  # noqa: E402
from orestack.llm import oracle, queries  # noqa: E402

DATA = "/root/testdata/sf0.001"
rng = random.Random(6)


def prose(n):
    return " ".join("w%d" % rng.randrange(400) for _ in range(n))


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    found = queries.queries()[name](spark, DATA)
    assert oracle_check.differences(found, oracle_check.connect(DATA), oracle.oracle_sql()[name]) == ""


def awkward(spark, folder):
    """Documents and items with shared passages that end inside a code point, short ones, nulls and repeated rows."""
    passage, item, signs = prose(120), prose(24), ("é", "è", "😀", "😁", "ह", "ऺ", "")
    long_line = prose(60)
    texts = [None, "", " \n ", "x"] + [f"{a}{passage}{b} {prose(9)}" for a in signs for b in signs] + [
        prose(50) + " " + item.upper() + "! " + prose(50), item[: len(item) // 2], "tiny item", "a tiny item here", prose(2000),
        prose(80) + item.replace("w1", "v1") + item] + ["\n".join([prose(3), long_line, "short one", "short two", prose(4)]) for _ in range(3)]
    docs = brute.documents(spark, texts + texts[-9:-6])
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "tiny item"), (2, prose(15)), (3, ""), (4, None), (None, texts[8])],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    database = duckdb.connect()
    for table in ("documents", "benchmark"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return database


def test_awkward_documents_equal_their_sql(spark, folder):
    database = awkward(spark, folder)
    for name in ("op2_decontaminate", "op3_suffix_dedup", "op5_line_dedup", "op12_fill_middle"):
        found = queries.queries()[name](spark, folder)
        assert oracle_check.differences(found, database, oracle.oracle_sql()[name]) == "", name
