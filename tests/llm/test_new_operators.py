"""Whitening, fill-in-the-middle and the n-gram join against plain Python and numpy versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from collections import defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from orestack.llm import fill_middle, ngram_join, whitening  # noqa: E402

rng = random.Random(8)


# -- whitening ------------------------------------------------------------------------------------

def faddeev(matrix):
    """Characteristic polynomial by exact traces, constant first."""
    d = len(matrix)
    a = np.array(matrix, object)
    m, c = np.zeros((d, d), object), [Fraction(1)]
    for k in range(1, d + 1):
        m = a @ m + int(c[-1]) * np.eye(d, dtype=int).astype(object)
        c.append(Fraction(-int(np.trace(a @ m)), k))
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("d", [1, 2, 7, 12])
def test_characteristic_polynomial(spark, d):
    numbers = np.random.default_rng(d)
    x = numbers.integers(-10 ** 6, 10 ** 6, (max(1, d - 2), d)).astype(object)  # of less than full rank
    matrix = (x.T @ x).tolist()
    poly = whitening.polynomial(spark, matrix)
    assert poly == faddeev(matrix)
    assert whitening.above(poly, 0, 0) == min(len(x), d)


def test_hessenberg_with_zero_pivots():
    matrix = [[0, 0, 3, 1], [0, 2, 0, 0], [1, 0, 0, 5], [0, 0, 0, 7]]
    p = whitening.primes(1)[0]
    assert whitening.characteristic(np.array(matrix, np.int64), p).tolist() == [v % p for v in faddeev(matrix)]


def test_roots_are_isolated():
    # (t - 2) (t - 3)^2 (t^2 - 10 t + 1) t
    poly = [1]
    for factor in ([-2, 1], [-3, 1], [-3, 1], [1, -10, 1], [0, 1]):
        poly = [sum(poly[i] * factor[k - i] for i in range(len(poly)) if 0 <= k - i < len(factor))
                for k in range(len(poly) + len(factor) - 1)]
    found = [Fraction(a, 1 << s) for a, s in (whitening.root(poly, k, 18) for k in range(1, 6))]
    assert [float(v) for v in found] == pytest.approx([5 + math.sqrt(24), 3, 3, 2, 5 - math.sqrt(24)], rel=1e-15)
    assert abs(found[0] * found[4] - 1) < Fraction(1, 2 ** 150)


def whole(vector):
    return [math.floor(max(-2.0 ** 53, min(2.0 ** 53, 64 * c))) + 1_000_000 for c in vector]


def check_whitening(spark, vectors, table, count=16):
    fit = sorted({tuple(whole(v)) for _, v in vectors})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    got = defaultdict(list)
    for r in whitening.whiten(table, "vec_id", "v", count).collect():
        got[r.vec_id].append(r)
    rank = sum(v > values[0] * 1e-12 for v in values)
    by_x = {}
    assert sum(map(len, got.values())) == len(vectors) * min(count, rank)
    for key, vector in vectors:
        x = whole(vector)
        rows = sorted((r for r in got[key]), key=lambda r: r.component)
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        assert all(r.n == n and r.identity_error < 1e-9 and (r.deviation is None or int(r.deviation) == deviation) for r in rows)
        by_x[tuple(x)] = [r.whitened for r in rows if int(r.deviation or -1) == deviation or r.deviation is None][:min(count, rank)]
        for r in rows:
            assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-6)
    w = np.array([by_x[x] for x in fit])
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9
    # The whitened values are projections on eigenvectors: their covariance with the entries is that of the components.
    for k in range(w.shape[1]):
        axis = centred.T @ w[:, k] / n
        assert np.linalg.norm(axis) == pytest.approx(math.sqrt(values[k]), rel=1e-6)


def test_whitening(spark):
    numbers = np.random.default_rng(5)
    vectors = [(i, (numbers.standard_normal(20) * np.linspace(1, 3, 20)).astype("f4").astype(float).tolist()) for i in range(150)]
    vectors += [(200 + i, vectors[3][1]) for i in range(60)] + [(300, [0.0] * 20)]
    unusable = [(400, None), (401, [float("nan")] * 20), (402, [float("inf")] + [0.0] * 19), (403, [None] * 20), (404, []), (405, [1.0] * 19)]
    table = spark.createDataFrame([(k, v, "a", "b") for k, v in vectors + unusable], "vec_id long, v array<double>, x string, n string")
    check_whitening(spark, vectors, table)
    check_whitening(spark, vectors, table, count=3)


def test_whitening_of_repeated_variances_and_huge_entries(spark):
    corners = [(i, [float(i >> b & 1) for b in range(4)]) for i in range(16)]  # all four variances are equal
    check_whitening(spark, corners, spark.createDataFrame(corners, "vec_id long, v array<float>"))
    huge = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.5, 3.0]), (3, [3.0, -7.0])]
    out = whitening.whiten(spark.createDataFrame(huge, "vec_id long, v array<double>"), "vec_id", "v").collect()
    assert len(out) == 8 and all(r.identity_error < 1e-6 for r in out)


def test_whitening_without_variance(spark):
    schema = "vec_id long, v array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, schema), "vec_id", "v")
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0
    none = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 1.0]), (2 ** 60 + 1, [0.0, 0.0])], schema)
    assert sorted(str(r.vec_id) for r in whitening.whiten(none, "vec_id", "v").filter("component = 1").collect()) == [
        str(2 ** 60 + 1), "None", "None"]


# -- fill in the middle ---------------------------------------------------------------------------

def middle_filled(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h, n = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)], len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(p) for p in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ALPHABET = ["a", "Z", "word", " ", "\n", "é", "🙂", "<", ">", "P", "S", "M", "<P", "S>", "0", "́", "long" * 9]
PLAIN = [None, "", "x", "<P>", "a <S> b", "<M", "P><S", "abc" * 5000, "🙂" * 9000, " " * 4096, "a b" * 4000]
TEXTS = PLAIN + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 120))) for _ in range(300)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_middles_equal_plain_python(spark, monkeypatch):
    docs = brute.documents(spark, TEXTS)
    more = docs.union(docs.filter("doc_id < 20")).withColumn("row", F.lit(1)).withColumn("part", F.lit("x"))
    for piece, at_once in ((4096, 1 << 20), (3, 7)):
        monkeypatch.setattr(fill_middle, "PIECE", piece)
        monkeypatch.setattr(fill_middle, "SLICE", at_once)
        some = more if piece > 3 else more.filter("length(text) < 1000 OR text IS NULL")
        got = [tuple(r) for r in fill_middle.digests(some).collect()]
        wanted = []
        for i in [r.doc_id for r in some.collect()]:
            n, form, prefix, middle, output = middle_filled(i, TEXTS[i])
            wanted.append((i, n, form, prefix, middle, sha(output), sha(TEXTS[i] or "")))
        assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}


def test_outputs_and_restored_texts(spark):
    docs = brute.documents(spark, TEXTS)
    out = fill_middle.transform(docs)
    assert {r.doc_id: r.output for r in out.collect()} == {i: middle_filled(i, t)[4] for i, t in enumerate(TEXTS)}
    back = out.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_middles_of_odd_keys(spark):
    rows = [(None, "one two three"), ("k", "one two three"), ("k", "four"), ("k", "four")]
    got = fill_middle.digests(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    wanted = [(k, *middle_filled(k, t)[:4], sha(middle_filled(k, t)[4]), sha(t)) for k, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert fill_middle.digests(brute.documents(spark, ["x"]).limit(0)).count() == 0
    assert fill_middle.transform(brute.documents(spark, ["x"]).limit(0)).count() == 0


# -- n-gram join ----------------------------------------------------------------------------------

def joined(rows, width=5, percent=80):
    """(key, size, component, links) of every row, all pairs compared."""
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for _, text in rows:
        words = brute.WORD.findall((text or "").translate(lower))
        sets.append({tuple(words[i: i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    linked = [[j for j, b in enumerate(sets) if i != j and a and 100 * len(a & b) >= percent * len(a | b)] for i, a in enumerate(sets)]
    out = []
    for i, a in enumerate(sets):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(a), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(linked[i])))
    return sorted(out, key=repr)


WORDS = ["w%d" % i for i in range(400)] + ["Ä", "İx", "ABC", "a\x1cb"]


def near(words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def copies():
    base, other, passage = ([rng.choice(WORDS) for _ in range(n)] for n in (120, 60, 40))
    texts = [None, "", " \n\t", "one", "One", "one two", "a b c d", "a b c d e", "A B\nc\td  e", " ".join(base), " ".join(base).upper()]
    texts += [" ".join(near(base, rng.randint(0, 5))) for _ in range(40)]
    texts += [" ".join(near(other, rng.randint(0, 3)) + [rng.choice(WORDS) for _ in range(rng.randint(0, 20))]) for _ in range(40)]
    texts += [" ".join([rng.choice(WORDS) for _ in range(rng.randint(1, 30))] + passage) for _ in range(30)]
    chain = [rng.choice(WORDS) for _ in range(300)]
    texts += [" ".join(chain[i: i + 80]) for i in range(0, 100, 5)]
    return texts


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 3, "BLOCK_GRAMS": 400, "POSTINGS": 50, "AT_ONCE": 300, "COLUMNS": 7, "FRAGMENTS": 3},
                                    {"AT_ONCE": 1, "STRETCH": 9, "BLOCK": 1}])
def test_join_equals_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    docs = brute.documents(spark, copies())
    more = docs.union(docs.filter("doc_id IN (4, 9, 30)")).withColumns({"cls": F.lit("x"), "gram": F.lit(1), "row": F.lit(2)})
    rows = [(r.doc_id, r.text) for r in more.collect()]
    wanted = joined(rows)
    assert sorted(map(tuple, ngram_join.join(more).collect()), key=repr) == wanted
    assert len({w[2] for w in wanted}) < len(wanted) - 30


@pytest.mark.parametrize("width,percent", [(1, 50), (3, 95), (5, 100)])
def test_join_with_other_thresholds(spark, width, percent):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(copies())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.join(docs, width=width, percent=percent).collect()), key=repr) == joined(rows, width, percent)


def test_join_of_a_hot_row_and_of_nothing(spark):
    rows = [(7, "the same words again and again here")] * 900 + [(i, "%d other words of its own %d" % (i, i)) for i in range(300)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("component_id", "n_links").count().collect()
    assert max((r["count"], r.component_id, r.n_links) for r in got) == (900, 7, 899)
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert ngram_join.join(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 2


def test_very_long_texts(spark):
    long = " ".join(rng.choice(WORDS) for _ in range(150_000))
    rows = [(1, long), (2, long + " more"), (3, "x" * 300_000), (4, None), (5, "x" * 299_999 + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.join(docs).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0), 5: (5, 0)}
    assert all(r.restored_sha256 == sha(rows[r.doc_id - 1][1] or "") for r in fill_middle.digests(docs).collect())
