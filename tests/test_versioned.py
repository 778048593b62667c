from __future__ import annotations

import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

import samples
from orestack import schemas
from orestack.operators import schema, versioned
from orestack.operators.versioned import VersionedTable, VersionNotFound

COLUMNS = "order_id string, customer_id string, product_id string, quantity int"


def _orders(spark, *orders):
    return spark.createDataFrame(list(orders), COLUMNS)


@pytest.fixture
def merged(spark, folder):
    """Version 0 holds A; version 1 changes A and adds K."""
    table = VersionedTable(spark, folder, key=["order_id"])
    table.merge(_orders(spark, ("A", "C1", "P1", 1)), ["quantity"], "2024-01-01 00:00:00")
    table.merge(_orders(spark, ("A", "C2", "P2", 5), ("K", "C3", "P3", 7)), ["quantity"], "2024-01-02 00:00:00")
    return table


def test_merge_updates_only_the_named_columns(merged):
    assert samples.rows(merged.current()) == [("A", "C1", "P1", 5), ("K", "C3", "P3", 7)]
    assert samples.rows(merged.changes(1), "order_id", "_op") == [("A", "U"), ("K", "I")]


def test_merge_updates_all_columns_by_default(spark, merged):
    merged.merge(_orders(spark, ("A", "C8", "P8", 8)))
    assert samples.rows(merged.current())[0] == ("A", "C8", "P8", 8)


@pytest.mark.parametrize("new_base", [False, True])
def test_deletes_last_until_the_key_comes_again(spark, merged, new_base):
    batch = _orders(spark, ("A", "C9", "P9", 9), ("K", "C3", "P3", 8), ("N", "C4", "P4", 1), ("Z", "C5", "P5", 1))
    flag = F.when(F.col("order_id") == "N", None).otherwise(F.col("order_id").isin("A", "Z"))
    merged.merge(batch.withColumn("gone", flag), deleted="gone", new_base=new_base)
    assert merged.current().columns == ["order_id", "customer_id", "product_id", "quantity"]
    assert samples.rows(merged.current()) == [("K", "C3", "P3", 8), ("N", "C4", "P4", 1)]
    assert samples.rows(merged.changes(2), "order_id", "_op") == [("A", "D"), ("K", "U"), ("N", "I")]
    before, after = merged.differing(1, 2)
    assert samples.rows(versioned.added_rows(after, before, ["order_id"]), "order_id") == [("A",)]

    merged.merge(_orders(spark, ("A", "C2", "P2", 6)), ["quantity"])
    assert samples.rows(merged.current(), "order_id", "customer_id") == [("A", "C2"), ("K", "C3"), ("N", "C4")]
    assert samples.rows(merged.changes(3), "order_id", "_op") == [("A", "I")]
    merged.restore(2)
    assert samples.rows(merged.current(), "order_id") == [("K",), ("N",)]
    merged.restore(1)
    assert samples.rows(merged.current()) == [("A", "C1", "P1", 5), ("K", "C3", "P3", 7)]


def test_a_first_load_leaves_out_deletes(spark, folder):
    table = VersionedTable(spark, folder, key=["order_id"])
    table.merge(_orders(spark, ("A", "C1", "P1", 1), ("B", "C1", "P1", 1)).withColumn("gone", F.col("order_id") == "B"), deleted="gone")
    assert samples.rows(table.current()) == [("A", "C1", "P1", 1)]


def test_merging_again_changes_nothing_but_the_version(spark, merged):
    before = samples.rows(merged.current())
    merged.merge(_orders(spark, ("A", "C2", "P2", 5), ("K", "C3", "P3", 7)), ["quantity"])
    assert samples.rows(merged.current()) == before
    assert merged.latest_version() == 2


def test_as_of_version_and_timestamp(merged):
    first, second = [("A", "C1", "P1", 1)], [("A", "C1", "P1", 5), ("K", "C3", "P3", 7)]
    assert samples.rows(merged.as_of_version(0)) == first
    assert samples.rows(merged.as_of_timestamp("2024-01-01 12:00:00")) == first
    assert samples.rows(merged.as_of_timestamp("2024-01-02 00:00:00")) == second
    with pytest.raises(VersionNotFound):
        merged.as_of_timestamp("2023-12-31 23:59:59")
    with pytest.raises(VersionNotFound):
        merged.as_of_version(7)


def test_restore_is_a_new_version(spark, merged):
    assert merged.restore(0) == 2
    assert samples.rows(merged.current()) == [("A", "C1", "P1", 1)]
    assert len(samples.rows(merged.as_of_version(1))) == 2
    merged.merge(_orders(spark, ("Z", "C1", "P1", 2)), ["quantity"])
    assert samples.rows(merged.current(), "order_id") == [("A",), ("Z",)]


def test_history(spark, merged):
    merged.restore(0)
    assert [(r["version"], r["operation"], r["rows_inserted"], r["rows_updated"])
            for r in merged.history().collect()] == [(2, "RESTORE", 0, 0), (1, "MERGE", 1, 1), (0, "WRITE", 1, 0)]
    assert [r["version"] for r in merged.history(2).collect()] == [2, 1]
    assert tuple(merged.version_count().first()) == (3, 2)
    merged.history().createOrReplaceTempView("orders_history")
    newest = spark.sql("SELECT version, committed_at, operation FROM orders_history ORDER BY version DESC LIMIT 1")
    assert newest.first()["operation"] == "RESTORE"


def test_uncommitted_rows_stay_invisible_and_a_retry_replaces_them(spark, merged, folder):
    stray = _orders(spark, ("A", "X", "X", 99)).withColumn("_op", F.lit("U"))
    stray.write.parquet(f"{folder}/rows/_version=2")
    assert samples.rows(merged.current(), "quantity") == [(5,), (7,)]
    merged.merge(_orders(spark, ("A", "C1", "P1", 6)), ["quantity"])
    assert samples.rows(merged.current(), "order_id", "quantity") == [("A", 6), ("K", 7)]


def test_a_table_without_versions(spark, folder):
    table = VersionedTable(spark, f"{folder}/none", key=["order_id"])
    assert table.latest_version() is None and table.history().count() == 0
    with pytest.raises(VersionNotFound):
        table.current()


def test_difference_between_versions(merged):
    before, after = merged.as_of_version(0), merged.current()
    assert samples.rows(versioned.added_rows(before, after, ["order_id"]), "order_id") == [("K",)]
    changed = versioned.changed_values(before, after, ["order_id"], "quantity")
    assert samples.rows(changed) == [("A", 1, 5)]


def test_differing_rows_are_those_of_the_keys_written_in_between(spark, merged):
    merged.merge(_orders(spark, ("K", "C3", "P3", 9), ("L", "C4", "P4", 1)), ["quantity"])
    merged.merge(_orders(spark, ("L", "C4", "P4", 2)), ["quantity"])
    before, after = merged.differing(1, 3)
    assert samples.rows(before) == [("K", "C3", "P3", 7)]
    assert samples.rows(after) == [("K", "C3", "P3", 9), ("L", "C4", "P4", 2)]
    for old, new in ((3, 1), (1, merged.restore(0)), (2, 2)):
        before, after = merged.differing(old, new)
        assert samples.rows(before) == samples.rows(merged.as_of_version(old))
        assert samples.rows(after) == samples.rows(merged.as_of_version(new))


def test_changes_to_null_count_only_when_null_safe(spark):
    before = spark.createDataFrame([("A", "x"), ("B", None)], "k string, v string")
    after = spark.createDataFrame([("A", None), ("B", None)], "k string, v string")
    assert versioned.changed_values(before, after, ["k"], "v").count() == 0
    assert samples.rows(versioned.changed_values(before, after, ["k"], "v", null_safe=True)) == [("A", "x", None)]


def test_a_new_source_column_is_filled_for_inserts_only(spark, merged):
    wider = _orders(spark, ("A", "C1", "P1", 6), ("N", "C1", "P1", 1)).withColumn("channel", F.lit("web"))
    merged.merge(wider, ["quantity"])
    assert samples.rows(merged.current(), "order_id", "channel") == [("A", None), ("K", None), ("N", "web")]
    assert "channel" not in merged.as_of_version(1).columns


def test_append_adds_columns(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(spark.createDataFrame([("a", 1)], "k string, n int"))
    table.append(spark.createDataFrame([("b", "web")], "k string, channel string"))
    assert samples.rows(table.current()) == [("a", 1, None), ("b", None, "web")]
    assert table.as_of_version(0).columns == ["k", "n"]
    with pytest.raises(AnalysisException):
        table.append(spark.createDataFrame([("c", "not a number")], "k string, n string"))


def test_overwrite_replaces_rows_and_schema(spark, folder):
    table = VersionedTable(spark, folder)
    table.overwrite(spark.createDataFrame([("a", 1)], "k string, n int"))
    table.overwrite(spark.createDataFrame([("b", 2.5)], "k string, price double"))
    assert samples.rows(table.current()) == [("b", 2.5)]
    assert samples.rows(table.as_of_version(0)) == [("a", 1)]
    table.restore(0)
    assert samples.rows(table.current()) == [("a", 1)]


def test_merge_after_an_overwrite_starts_from_it(spark, merged):
    merged.overwrite(_orders(spark, ("Q", "C1", "P1", 1)))
    merged.merge(_orders(spark, ("A", "C7", "P7", 7)), ["quantity"])
    assert samples.rows(merged.current()) == [("A", "C7", "P7", 7), ("Q", "C1", "P1", 1)]


def test_a_new_base_holds_the_whole_table(spark, merged, folder):
    merged.merge(_orders(spark, ("A", "C9", "P9", 9), ("M", "C1", "P1", 1)), ["quantity"], new_base=True, source_version=4)
    whole = [("A", "C1", "P1", 9), ("K", "C3", "P3", 7), ("M", "C1", "P1", 1)]
    assert samples.rows(merged.current()) == whole
    assert all("_version=2" in name for name in merged.current().inputFiles())
    assert samples.rows(merged.changes(2), "order_id", "_op") == [("A", "U"), ("M", "I")]
    newest = merged.history(1).first()
    assert (newest["operation"], newest["rows_inserted"], newest["rows_updated"]) == ("MERGE", 1, 1)
    before, after = merged.differing(1, 2)
    assert samples.rows(before) == samples.rows(merged.as_of_version(1)) and samples.rows(after) == whole
    merged.merge(_orders(spark, ("K", "C3", "P3", 8)), ["quantity"])
    assert samples.rows(merged.current(), "quantity") == [(1,), (8,), (9,)] and merged.source_version() is None
    merged.restore(2)
    assert samples.rows(merged.current()) == whole and merged.source_version() == 4


def test_a_long_chain_gets_a_new_base(spark, folder, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_CHANGES", 2)
    table = VersionedTable(spark, folder, key=["order_id"])
    for n in range(5):
        table.merge(_orders(spark, ("A", "C", "P", n), (f"N{n}", "C", "P", n)))
    used = {name.split("_version=")[1][0] for name in table.current().inputFiles()}
    assert used == {"3", "4"}
    assert samples.rows(table.current(), "order_id", "quantity") == [
        ("A", 4), ("N0", 0), ("N1", 1), ("N2", 2), ("N3", 3), ("N4", 4)]


def test_keyed_and_unkeyed_writes_do_not_mix(spark, folder):
    with pytest.raises(ValueError):
        VersionedTable(spark, folder, key=["order_id"]).append(_orders(spark))
    with pytest.raises(ValueError):
        VersionedTable(spark, folder).merge(_orders(spark))


_BATCH = st.dictionaries(st.sampled_from("ABCD"), st.tuples(st.sampled_from("xyz"), st.integers(0, 9)), min_size=1)
_STEP = st.one_of(_BATCH, st.integers(0, 10))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_BATCH, st.lists(_STEP, min_size=1, max_size=3))
def test_every_version_equals_a_replay(spark, folder, first, steps):
    table = VersionedTable(spark, f"{folder}/{uuid.uuid4().hex}", key=["k"])
    state: dict[str, tuple] = {}
    states = []
    for step in [first, *steps]:
        if isinstance(step, dict):
            table.merge(spark.createDataFrame(
                [(key, *values) for key, values in step.items()], "k string, fixed string, v int"), ["v"])
            state = state | {key: (state[key][0] if key in state else fixed, value)
                             for key, (fixed, value) in step.items()}
        else:
            back = step % len(states)
            table.restore(back)
            state = states[back]
        states.append(state)
    for version, expected in enumerate(states):
        assert samples.rows(table.as_of_version(version)) == sorted(
            (key, *values) for key, values in expected.items())


def test_enforce(spark):
    declared = schemas.T.StructType.fromDDL("k string not null, n bigint, extra string")
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    fitted = schema.enforce(rows, declared)
    assert fitted.schema == declared and samples.rows(fitted) == [("a", 1, None)]
    with pytest.raises(schema.SchemaMismatch):
        schema.enforce(rows.withColumn("unknown", F.lit(1)), declared)
    assert schema.enforce(rows.withColumn("unknown", F.lit(1)), declared, strict=False).columns == ["k", "n", "extra"]
    with pytest.raises(AnalysisException):
        schema.enforce(rows.withColumn("n", F.lit("text")), declared)
    with pytest.raises(PySparkException, match="NULL in required column k"):
        schema.enforce(rows.withColumn("k", F.lit(None).cast("string")), declared).collect()


def test_describe(spark):
    listing = schema.describe(spark.createDataFrame([("a", None), ("b", 2)], "k string, n int"))
    assert samples.rows(listing) == [(1, "k", "string", 2), (2, "n", "int", 1)]


def test_append_evolving(spark):
    both = schema.append_evolving(spark.range(1).toDF("id"), spark.createDataFrame([(5, "x")], "id bigint, c string"))
    assert samples.rows(both) == [(0, None), (5, "x")]


@pytest.mark.parametrize("rows", [[("A", "C", "P", 2), ("A", "C", "P", 3)], [(None, "C", "P", 2)]])
def test_a_merge_needs_one_row_per_key(spark, folder, merged, rows):
    fresh = VersionedTable(spark, f"{folder}/fresh", key=["order_id"])
    for write in (merged.merge, merged.overwrite, fresh.merge):
        with pytest.raises(Exception, match="cannot merge"):
            write(_orders(spark, *rows))
    assert merged.latest_version() == 1 and fresh.latest_version() is None


def test_a_committed_version_is_never_written_again(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(_orders(spark, ("A", "C", "P", 1)))
    snapshot = table._newest()
    table.append(_orders(spark, ("B", "C", "P", 1)))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(_orders(spark, ("X", "C", "P", 1)), "APPEND", snapshot, snapshot["chain"], None)
    assert samples.rows(table.current(), "order_id") == [("A",), ("B",)]


def test_a_commit_names_the_chain_of_its_contents(merged):
    merged.restore(0)
    chains = {row["_version"]: row["chain"] for row in merged.commits().collect()}
    assert chains == {0: [0], 1: [0, 1], 2: [0]}
