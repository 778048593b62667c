from __future__ import annotations

import samples
from orestack.operators import profile
from orestack.plans import checks


def _keys(spark, *keys):
    return spark.createDataFrame([(key,) for key in keys], "k string")


def test_duplicates_count_null_as_one_key(spark):
    assert tuple(profile.duplicates(_keys(spark, "a", "a", None, None), "k").first()) == (4, 2, 2, 50.0)
    assert tuple(profile.duplicates(_keys(spark, "a", "b"), "k").first()) == (2, 2, 0, 0.0)
    assert tuple(profile.duplicates(_keys(spark), "k").first()) == (0, 0, 0, None)


def test_most_repeated(spark):
    top = profile.most_repeated(_keys(spark, "b", "b", "a", "a", "c", None, None, None), "k", 2)
    assert [tuple(row) for row in top.collect()] == [(None, 3), ("a", 2)]


def test_unique_key_check(spark):
    assert tuple(profile.unique_key_check(_keys(spark, "a", "b"), "k").first()) == (0, True)
    assert tuple(profile.unique_key_check(_keys(spark, "a", "a"), "k").first()) == (1, False)


def test_null_counts(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "k string, n int")
    assert samples.rows(profile.null_counts(df, ["k", "n"])) == [("k", 1), ("n", 2)]


def test_compare_counts(spark):
    assert tuple(profile.compare_counts(spark.range(8), spark.range(6)).first()) == (8, 6, 2, 25.0)
    assert tuple(checks.compare_versions(spark.range(6), spark.range(8)).first()) == (6, 8, 2)


def test_rerun_check(spark):
    before = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    same = checks.rerun_check(before, before, ["k"], ["n"]).first()
    assert tuple(same) == (2, 2, 0, True)
    after = spark.createDataFrame([("a", 2), ("b", None), ("c", 1)], "k string, n int")
    assert tuple(checks.rerun_check(before, after, ["k"], ["n"]).first()) == (2, 3, 2, False)
