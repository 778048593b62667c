"""Every registered query against its SQL counterpart, on all rows of the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import oracle_check
from orestack import oracle, registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return oracle_check.connect(DATA)


def test_every_query_has_sql():
    assert registry.queries().keys() == oracle.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, database, name):
    query = registry.queries()[name](spark, DATA)
    assert oracle_check.differences(query, database, oracle.oracle_sql()[name]) == ""
