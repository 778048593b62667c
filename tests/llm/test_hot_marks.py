"""Byte strings and fingerprints whose marks have more surroundings than one task compares."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from orestack.llm import simhash, suffix_dedup  # noqa: E402
from orestack.llm.graph import components  # noqa: E402


def test_many_surroundings_go_row_by_row(spark, monkeypatch):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdef ") for _ in range(420))
    texts = ["".join(rng.choice("ghijkl ") for _ in range(300)) + passage[i % 7:] + "z" * (i % 3) for i in range(12)] * 2 + [passage[:399]]
    expected = {i: r[:3] for i, r in enumerate(brute.repeated_bytes(texts))}
    for together in (1, 5, 20_000):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
        out = suffix_dedup.dedup(brute.documents(spark, texts)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in out} == expected


def test_long_lists_connect_what_pairs_do(spark):
    rng = random.Random(8)
    prints = set()
    for _ in range(4):  # chains of small steps within three bytes, and single ones around
        base, at = rng.getrandbits(64), rng.sample(range(64), 24)
        for _ in range(60):
            prints.add(base)
            for bit in rng.sample(at, rng.randint(2, 4)):
                base ^= 1 << bit
    prints |= {rng.getrandbits(64) for _ in range(20)} | {0, (1 << 64) - 1, 1, 1 << 63}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    distance = {(a, b): ((a ^ b) & (1 << 64) - 1).bit_count() for a in prints for b in prints if a < b}
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for (a, b), apart in distance.items():
        if apart <= 3 and top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
    linked = {p for pair, apart in distance.items() if apart <= 3 for p in pair}
    frame = spark.createDataFrame([(p,) for p in [*prints, *prints[:5]]], "fp long")
    for most in (1, 6, 1_000):
        found = simhash.links(frame, most=most)
        pairs = [tuple(r) for r in found.collect()]
        assert len(pairs) == len(set(pairs)) and all(distance[p] <= 3 for p in pairs)
        if most == 1_000:
            assert set(pairs) == {p for p, apart in distance.items() if apart <= 3}
        assert {r.node: r.root for r in components(found, "a", "b").collect()} == {p: top(p) for p in linked}
