"""Pairs of fingerprints are made in one of the lists in which they meet."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from orestack.llm import simhash


def test_a_pair_is_made_in_one_list(spark):
    rng = random.Random(3)
    bases = [rng.getrandbits(64) for _ in range(20)]
    wanted = [(a, a ^ sum(1 << bit for bit in rng.sample(range(64), n))) for a in bases for n in (1, 2, 3)]
    signed = [tuple(v - (1 << 64) if v >> 63 else v for v in pair) for pair in wanted]
    pairs = spark.createDataFrame(signed, "a long, b long").withColumn(
        "mask", F.explode(F.array(*map(F.lit, simhash.byte_masks(3)))))
    met = pairs.filter("((a ^ b) & mask) = 0")
    made = met.filter(simhash._first_shared(F.col("a"), F.col("b"), F.col("mask"))).groupBy("a", "b").count()
    assert {(r.a, r.b): r["count"] for r in made.collect()} == dict.fromkeys(signed, 1)
    assert met.count() > len(signed)

    prints = spark.createDataFrame([(v,) for v in {v for pair in signed for v in pair}], "fp long")
    known = [r.fp for r in prints.collect()]
    near = {(a, b) for a in known for b in known if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert sorted(map(tuple, simhash.links(prints).collect())) == sorted(near)


def test_the_index_is_shuffled_once(spark, monkeypatch):
    """And no list of its size is kept beside the members."""
    kept, saved = [], simhash.saved
    monkeypatch.setattr(simhash, "saved", lambda df, purpose: kept.append((purpose, df)) or saved(df, purpose))
    prints = spark.createDataFrame([(5,), (6,), (5,), (1 << 40,), (None,)], "fp long")
    assert sorted(map(tuple, simhash.links(prints).collect())) == [(5, 6), (5, 1 << 40), (6, 1 << 40)]
    (purpose, members), = kept
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert purpose == "byte-list-members" and plan.count("Exchange hashpartitioning(mask") == 1 and "Join" not in plan
