from __future__ import annotations

import random
from datetime import datetime, timedelta

import samples
from orestack.operators.asof import asof_join

START = datetime(2024, 1, 1)


def test_asof_equals_a_search(spark):
    rng = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(i, rng.choice(keys), None if i % 37 == 0 else START + timedelta(hours=rng.randint(0, 400))) for i in range(300)]
    right = [(rng.choice(keys + ["c"]), START + timedelta(hours=rng.randint(0, 400)), rng.choice([None, "x", "y"]), n) for n in range(300)]
    right.append(("hot", None, "never", 999))
    joined = asof_join(spark.createDataFrame(left, "id int, k string, t timestamp"),
                       spark.createDataFrame(right, "k string, t timestamp, state string, n int"), "k", "t", ["state", "n"])
    assert joined.columns == ["id", "k", "t", "state", "n"]
    for row in joined.collect():
        earlier = [r for r in right if row.k is not None and row.t is not None and r[0] == row.k and r[1] is not None and r[1] <= row.t]
        best = max(earlier, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3]), default=(None,) * 4)
        assert (row.state, row.n) == best[2:]
    assert joined.count() == len(left)


def test_asof_makes_no_pairs(spark):
    rows = samples.raw_orders(spark).selectExpr("order_id", "try_cast(ingested_at AS timestamp) AS at", "status")
    plan = asof_join(rows, rows.withColumnRenamed("status", "state"), "order_id", "at", ["state"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    nothing = asof_join(rows.limit(0), rows.withColumnRenamed("status", "state"), "order_id", "at", ["state"])
    assert nothing.count() == 0
