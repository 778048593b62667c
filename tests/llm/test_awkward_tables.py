"""Clashing names, hot and repeated rows, short items, rare languages, and workers without the package."""

from __future__ import annotations

import itertools
import os
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from orestack.llm import (decontaminate, fill_middle, language, line_dedup, mixing, ngram_join, quality, simhash,  # noqa: E402
                          suffix_dedup)

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
rng = random.Random(4)
WORDS = ["w%d" % i for i in range(200)]

# Names that the operators use inside, and some of Spark's own.
INNER = ("_name _hash _lines _score _key _data _at row rows name hash key cls n short id low high gone lines lines_in lines_removed "
         "mark marks batch bucket score size source_no rank copy digest chunk fp root item seed at data text_ kept place part").split()


def prose(n, line=9):
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i: i + line]) for i in range(0, n, line))


def clashing(docs):
    return docs.select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in INNER if c not in docs.columns))


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


BASE = prose(150)
TEXTS = [None, "", BASE, BASE, BASE + "\nmore of it", prose(300), prose(20) + "\n" + BASE, "x", "\n\n"]


@pytest.mark.parametrize("apply", [
    line_dedup.dedup, simhash.groups, simhash.one_of_each, suffix_dedup.dedup, mixing.taken, fill_middle.digests, ngram_join.join,
    lambda docs: decontaminate.report(docs, items(docs.sparkSession)), lambda docs: decontaminate.clean(docs, items(docs.sparkSession))],
    ids=["lines", "groups", "one_of_each", "bytes", "mix", "middles", "join", "report", "clean"])
def test_names_of_columns_do_not_clash(spark, apply):
    docs = spark.createDataFrame([(i, t, "en", "s%d" % (i % 2), 1) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    alone, among = apply(docs), apply(clashing(docs))
    assert plain(among.select(*alone.columns)) == plain(alone)
    kept = [c for c in among.columns if c in INNER and c not in alone.columns]
    assert all(r[c] == f"{c}-{r.doc_id}" for r in among.collect() for c in kept)


def items(spark):
    return spark.createDataFrame([(1, prose(30)), (2, " ".join(BASE.split()[20:50]))], "item_id long, text string")


def test_pipeline_keeps_clashing_columns(spark):
    docs = clashing(spark.read.parquet(f"{DATA}/documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, before = stage(spark, docs, DATA).cache(), docs.columns
        assert docs.columns == before
    assert docs.count() > 50 and all(r[c] == f"{c}-{r.doc_id}" for r in docs.collect() for c in INNER if c not in ("text",))


def test_many_copies_of_a_row(spark):
    row = prose(400, 8)[:2400]
    docs = spark.createDataFrame([(7, row)] * 5000 + [(8, row[:1000]), (9, prose(200))], "doc_id long, text string")
    out = suffix_dedup.dedup(docs).groupBy("doc_id", "n_removed", "n_spans").count().collect()
    assert sorted((r.doc_id, r["count"], r.n_removed, r.n_spans) for r in out) == [
        (7, 5000, len(row), 1), (8, 1, 1000, 1), (9, 1, 0, 0)]
    lines = line_dedup.dedup(docs).groupBy("doc_id", "lines_removed").count().collect()
    assert {(r.doc_id, r["count"]) for r in lines} == {(7, 5000), (8, 1), (9, 1)}


def test_a_hot_document_id_in_a_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rows = [(5, "one two three", "a")] * 200 + [(5, "w " * (i % 7), "b") for i in range(200)] + [(i, "x y", "a") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.taken(docs, block=16)
    assert out.count() == len(rows) and out.filter("taken > 2 * size").isEmpty()
    assert plain(mixing.taken(docs.repartition(7), block=16)) == plain(out)
    for r in out.groupBy("source_size").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 1


def test_a_hot_document_id_in_quality(spark):
    docs = spark.createDataFrame([(1, "a %d" % i) for i in range(3000)] + [(i, "b\nc") for i in range(2, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    field = quality.train(docs, labels)
    assert all(0 <= r.s <= 1 for r in docs.select(quality.score(F.col("text"), field).alias("s")).collect())


def test_short_items(spark):
    wanted, texts, benchmark = set(), [], []
    for n in range(1, 15):
        words = ["i%d.%d" % (n, i) for i in range(n)]
        words = [w.replace(".", "x") for w in words]
        benchmark.append((n, " ".join(words)))
        for count in range(0, 4):
            cases = list(itertools.combinations(range(n), count))
            for places in rng.sample(cases, min(12, len(cases))):
                if 5 * (n - count) >= 4 * n:
                    wanted.add((len(texts), n))
                texts.append("before " + " ".join("zz" if i in places else w for i, w in enumerate(words)) + " after")
    docs = brute.documents(spark, texts + ["i5x0 i5x1", "", None])
    found = decontaminate.report(docs, spark.createDataFrame(benchmark, "item_id long, text string"))
    assert {(r.doc_id, r.first_item) for r in found.filter("contaminated").collect()} == wanted


def test_signs_of_numbers_are_no_letters(spark):
    docs = brute.documents(spark, ["the fox and the dog", "der fuchs und der hund"] * 10, langs=("en", "de"))
    filters = language.train(docs)
    asked = brute.documents(spark, ["½ ² ①", "Ⅷ", "٣ 42", "½ the fox", "a½"])
    got = {r.doc_id: r.p for r in asked.select("doc_id", language.predict(F.col("text"), filters).alias("p")).collect()}
    assert [got[i].lang_pred for i in range(4)] == ["und", "und", "und", "en"] and got[4].lang_pred != "und"
    assert all(got[i].score == 0 for i in range(3))


def test_a_rare_language_is_learnt(spark):
    frequent = ["e%dq" % i for i in range(400)]
    rows = [(i, " ".join(rng.choice(frequent) for _ in range(30)), "en") for i in range(990)]
    rows += [(1000 + i, "zwölf grüße über möwen %s" % rng.choice(["hör", "flöte", "käse"]), "de") for i in range(10)]
    docs = spark.createDataFrame(rows + [(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string")
    filters = language.train(docs, sample=50, capacity=60)
    got = docs.filter("doc_id >= 1000").select(language.predict(F.col("text"), filters).alias("p")).select("p.lang_pred").distinct()
    assert [r.lang_pred for r in got.collect()] == ["de"]


def decided(filters, text):
    """Language and score of a text by plain sums over its n-grams."""
    grams = [g for token in (text or "").lower().split() for g in language.grams_of(token)]
    if not grams:
        return "und", 0.0
    hits = [0] * len(filters.languages)
    for gram in grams:
        mask = filters.contained(language.code_points(gram).reshape(1, -1))[0]
        hits = [h + (int(mask[i // 64]) >> i % 64 & 1) for i, h in enumerate(hits)]
    rates = [min(float(r), 0.999) for r in filters.false_positive]
    true = [max(0.0, (h - r * len(grams)) / (1 - r)) for h, r in zip(hits, rates)]
    best = max(range(len(true)), key=lambda i: (true[i], -i))
    return (filters.languages[best], true[best] / sum(true)) if sum(true) else (filters.default, 0.0)


def test_answers_equal_plain_sums(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    filters = language.train(docs)
    more = brute.documents(spark, [None, "", "½", "ж", "the the der", "word " * 200_000]).select("doc_id", "text")
    asked = docs.select("doc_id", "text").limit(60).union(more).collect()
    table = spark.createDataFrame(asked, "doc_id long, text string")
    got = [(r.text, r.p.lang_pred, r.p.score) for r in table.select("text", language.predict(F.col("text"), filters).alias("p")).collect()]
    for text, lang, score in got:
        assert (lang, pytest.approx(score)) == decided(filters, text)


def test_neighbours_where_workers_lack_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession, functions as F
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
            "spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        spark.range(4).rdd.map(lambda x: x).count()  # workers start before the driver knows the package
        sys.path.insert(0, {str(ROOT)!r})
        from orestack.llm import ann_codes, fill_middle, whitening
        table = spark.createDataFrame([(i, [float(i), 1.0, -float(i % 3)]) for i in range(50)], "vec_id long, v array<float>")
        print("found", ann_codes.search(table, "vec_id", "v", F.col("id") % 10 == 0, k=3).count())
        print("whitened", whitening.whiten(table, "vec_id", "v").count())
    """))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "found 15" in done.stdout and "whitened 100" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("apply", [lambda d: quality.score(F.col("text"), quality.train(d, d.select("doc_id", F.lit(1).alias("quality")))),
                                   lambda d: language.predict(F.col("text"), language.train(d))], ids=["quality", "language"])
def test_learning_from_null_and_repeated_ids(spark, apply):
    rows = [(None, "a b", "en")] * 20 + [(3, "a b c", "en"), (3, "other words", "de"), (4, None, None), (5, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert docs.select(apply(docs).alias("s")).count() == len(rows)
    assert docs.limit(0).select(apply(docs.limit(0)).alias("s")).count() == 0
