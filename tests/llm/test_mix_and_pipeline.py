"""What the mix takes, piece by piece, and the whole pipeline against plain Python."""

from __future__ import annotations

import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from orestack.llm import mixing, queries  # noqa: E402

DATA = "/root/testdata/sf0.001"
rng = random.Random(8)


def prose(n):
    return "".join(rng.choice([" ", "\n", "  ", "\t"]) + "w%d" % rng.randrange(500) for _ in range(n))


def plain_targets(sizes):
    """The target of every source of ``{source: words}``."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    whole, target = 1.5 * sum(sizes.values()), {}
    while len(target) < len(sizes):
        level = (whole - sum(target.values())) / sum(weight[s] for s in sizes if s not in target)
        over = [s for s in sizes if s not in target and level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
    return target | {s: level * weight[s] for s in sizes if s not in target}


def check_mix(found, texts, sources, block):
    """Every number of ``found`` (id to row with pieces) against ``{id: text}`` and ``{id: source}``."""
    size = {i: len(brute.WORD.findall(t or "")) for i, t in texts.items()}
    words = Counter()
    for i, n in size.items():
        words[sources[i]] += n
    target, used, got = plain_targets(words), defaultdict(Counter), Counter()
    assert found.keys() == texts.keys()
    for i, r in found.items():
        assert (r.size, r.source_size) == (size[i], words[sources[i]]) and abs(r.target - target[sources[i]]) < 1e-6
        assert r.taken == sum(p.words for p in r.pieces) <= 2 * size[i] and r.pieces == sorted(r.pieces)
        covered = Counter(j for p in r.pieces for j in range(p["at"], p["at"] + p.words))
        assert all(0 <= j < size[i] for j in covered) and (not covered or max(covered.values()) <= 2)
        # A source is begun again only when all of it was taken.
        assert target[sources[i]] < words[sources[i]] or len(covered) == size[i]
        for p in r.pieces:
            used[p.slot][sources[i]] += p.words
        got[sources[i]] += r.taken
    assert all(abs(got[s] - target[s]) <= 1 for s in words)
    assert all(len(u) == 1 for u in used.values())
    blocks, seen = Counter(next(iter(u)) for u in used.values()), Counter()
    for place, slot in enumerate(sorted(used), 1):
        (source, n), = used[slot].items()
        seen[source] += 1
        assert n == block or seen[source] == blocks[source]
        assert abs(seen[source] - blocks[source] * place / len(used)) < 4


def test_pieces_of_the_mix(spark):
    texts = [prose(rng.randint(0, 90)) for _ in range(150)] + [None, "", " \t ", prose(3000)] + ["same words here"] * 40
    docs = brute.documents(spark, texts, sources=("b", "a", None, "c"))
    found = {r.doc_id: r for r in mixing.taken(docs, pieces=True, block=16).collect()}
    check_mix(found, dict(enumerate(texts)), {r.doc_id: r.source for r in docs.collect()}, 16)
    again = {r.doc_id: r for r in mixing.taken(docs.repartition(5), pieces=True, block=16).collect()}
    assert again == found


def test_texts_of_the_mix(spark):
    texts = [prose(rng.randint(0, 90)) for _ in range(60)] + [None, "", prose(2000), "\u3000é ü\u00a0x \n"] + ["same words here"] * 20
    docs = brute.documents(spark, texts, sources=("b", "a"))
    docs = docs.union(docs.filter("doc_id < 9")).withColumn("doc_id", F.when(F.col("doc_id") != 5, F.col("doc_id")))
    out = mixing.texts(docs, block=16).collect()
    wanted = Counter((r.doc_id, p.slot, p["at"], p.words) for r in mixing.taken(docs, pieces=True, block=16).collect() for p in r.pieces)
    assert Counter((r.doc_id, r.slot, r["at"], r.words) for r in out) == wanted and len(out) > 100
    for r in out:
        text = texts[5 if r.doc_id is None else r.doc_id]
        spans = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)
        assert r.text == "".join(spans[r["at"]:r["at"] + r.words])
    assert mixing.texts(docs.limit(0)).isEmpty()


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def overlaps(document, item):
    """Whether 15 tokens or more of an item, or all of a shorter one, stand in a document with 80 % of them equal."""
    places, need = defaultdict(list), min(15, len(item))
    for j, w in enumerate(item):
        places[w].append(j)
    shifts = Counter(p - j for p, w in enumerate(document) for j in places.get(w, ()))
    for shift, n in shifts.items():
        low, high = max(0, -shift), min(len(item), len(document) - shift)
        if 5 * n >= 4 * need:
            same = [document[shift + j] == item[j] for j in range(low, high)]
            if any(5 * sum(same[s:e]) >= 4 * (e - s) for s in range(len(same)) for e in range(s + need, len(same) + 1)):
                return True
    return False


def test_pipeline_equals_plain_python(spark):
    """All five stages; only the trained scores are taken from the operator, which has tests of its own."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    good = [i for i, s in sorted((r.doc_id, r.score) for r in queries.op10_quality(spark, DATA).collect()) if s >= 0.3]
    texts = dict(zip(good, brute.kept_lines([docs[i].text for i in good])))
    _, low = brute.component_ids(list(texts.values()))
    one = [i for at, i in enumerate(good) if low[at] == at]
    items = [t for t in (tokens(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()) if t]
    clean = [i for i in one if not any(overlaps(tokens(texts[i]), item) for item in items)]
    assert len(docs) > len(good) > len(one) > len(clean) > 50
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, DATA).collect()}
    check_mix(found, {i: texts[i] for i in clean}, {i: docs[i].source for i in clean}, 1024)
