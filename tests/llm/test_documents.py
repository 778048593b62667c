"""Operators on documents against plain Python versions, with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import itertools
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from orestack.llm import decontaminate, language, line_dedup, mixing, quality, simhash, suffix_dedup, token_counts  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]


def prose(n, line=12):
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    return "\n".join(" ".join(words[i: i + line]) for i in range(0, n, line))


BASE = prose(260)
TEXTS = [
    None, "", " \n ", "one", "one two", BASE, BASE, BASE.replace(" ", "  ", 1), BASE[:900] + "x" + BASE[900:], "é" * 500,
    "aaaa " * 300, prose(40) + "\n" + BASE[200:800] + "\n" + prose(30), "\n".join(["same line here"] * 9), prose(3000),
    "ABC Def\x0bghi\x1cjkl mno <|endoftext|> it's 42!!", prose(200), prose(51, 60), "\n\n" + prose(36) + "\n\n\n",
] + [BASE.replace(VOCABULARY[i], "new%d" % i) for i in range(6)]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_tokens_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = TEXTS + ["İstanbul ǅ ﬁ é ́x", "a" * 3000, "<|startoftext|><|endoftext|>x", "'S it'LL we're", "日本語 🙂🙂 ٣"]
    out = token_counts.count_tokens(brute.documents(spark, texts), path, limit=100)
    expected = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in out.collect()} == expected
    assert all(r.over_limit == (r.n_tokens > 100) and r.n_bytes == len((texts[r.doc_id] or "").encode()) for r in out.collect())


def test_merges_follow_the_order_of_their_parts():
    vocabulary = token_counts.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    made = {int(m): int(r) for m, r in zip(vocabulary.merged, vocabulary.ranks)}
    assert all(made.get(int(part), -1) < rank for key, rank in zip(vocabulary.keys, vocabulary.ranks)
               for part in (key >> 32, key & 0xFFFFFFFF))


def test_simhash_groups(spark):
    prints, low = brute.component_ids(TEXTS)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.groups(brute.documents(spark, TEXTS)).collect()}
    assert got == {i: (p, c) for i, (p, c) in enumerate(zip(prints, low))}


def test_simhash_keeps_one_of_each(spark):
    docs = brute.documents(spark, TEXTS)
    _, low = brute.component_ids(TEXTS)
    kept = simhash.one_of_each(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low))
    none = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.one_of_each(none).count() == len(set(low))


def test_masks_over_bytes_are_complete():
    masks = [m & (1 << 64) - 1 for m in simhash.byte_masks(3)]
    for bits in itertools.combinations(range(0, 64, 3), 3):
        assert any(not mask >> b & 1 for mask in masks for b in bits)
        assert any(all(not mask >> b & 1 for b in bits) for mask in masks)


@pytest.mark.parametrize("least", [130, 400])
def test_repeated_bytes(spark, least):
    out = suffix_dedup.dedup(brute.documents(spark, TEXTS), least=least)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert got == dict(enumerate(brute.repeated_bytes(TEXTS, least)))


def test_repeated_bytes_over_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    out = suffix_dedup.dedup(brute.documents(spark, TEXTS))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {i: r[1] for i, r in enumerate(brute.repeated_bytes(TEXTS))}


def test_lines(spark):
    docs = brute.documents(spark, TEXTS)
    # The hash of a text orders equal ids only; ids differ here, so the order is that of the ids.
    out = line_dedup.dedup(docs)
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(brute.kept_lines(TEXTS)))
    assert out.columns == [*docs.columns, "lines_in", "lines_removed"]
    assert line_dedup.dedup(docs.union(docs)).filter("lines_removed > 0").count() == 2 * out.filter("lines_removed > 0").count()


def test_matches_extend_from_long_lines_both_ways(spark):
    """Short lines after a line of 50 words belong to its run, whatever stands after it in the first document that has it."""
    wide = [prose(55, 60) for _ in range(3)]
    texts = ["\n".join(x) for x in (
        ["a", wide[0], "b", "c"], ["d", wide[0], "short", "other"], ["e", wide[0], "short", "other", "f"], ["g", "short", wide[0], "h"],
        [wide[1], wide[2], "i"], ["j", wide[1], wide[2], "i", "k"], ["short", wide[0], "h", "l"], ["m", "e", wide[0], "short"])]
    texts += ["\n".join(rng.choice([*wide, "x", "y", prose(30, 40), "z " * 20, ""]) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    kept = {r.doc_id: r.text for r in line_dedup.dedup(brute.documents(spark, texts)).collect()}
    assert kept == dict(enumerate(brute.kept_lines(texts)))
    assert kept[2] == "e\nf" and kept[5] == "j\nk"


def test_only_white_space_is_trimmed(spark):
    texts = ["x\nbox 0\nBf\n", "\tbo\nf\n0", "x \n\x0bbox 0\f\n\n \r\nBf", "0\nx\nB\nf", "0\f\n x\nB\nq"]
    kept = {r.doc_id: r.text for r in line_dedup.dedup(brute.documents(spark, texts)).collect()}
    assert kept == dict(enumerate(brute.kept_lines(texts))) and kept[2] == "\n \r" and kept[4] == "q" and kept[1] == texts[1]


def test_seeds_see_past_three_substitutions():
    for bad in itertools.combinations(range(15), 3):
        assert any(all(start + i not in bad for i, used in enumerate(mask) if used == "1")
                   for mask in decontaminate.MASKS for start in range(15 - len(mask) + 1)), bad


def test_decontamination(spark):
    items = [prose(20, 30), prose(45, 9), "too short", None, ""]
    words = items[1].split()
    swapped = list(words)
    for i in range(4, len(words), 9):
        swapped[i] = "other"
    half = [w if i % 2 else "other" for i, w in enumerate(words)]
    texts = [None, "", prose(100), prose(30) + " " + items[0].upper().replace(" ", " , ") + " " + prose(30), " ".join(swapped),
             " ".join(half), " ".join(words[10:26]), " ".join(words[10:20]), "too short", prose(3000) + "\n" + items[1]]
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(None, prose(20))], "item_id long, text string")
    docs = brute.documents(spark, texts)
    assert {r.doc_id for r in decontaminate.report(docs, benchmark).filter("contaminated").collect()} == {3, 4, 6, 8, 9}
    kept = decontaminate.clean(docs.union(docs), benchmark)
    assert kept.columns == docs.columns and kept.count() == 2 * (len(texts) - 5)
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(texts)


def covered(document, item, least=15):
    """Runs (at, length, matches) of stretches of ``least`` tokens or more that are equal to 80 %, tried one by one."""
    out, least = set(), min(least, len(item))
    for shift in range(-len(item), len(document)):
        lo, hi = max(0, -shift), min(len(item), len(document) - shift)
        same = {j: document[shift + j] == item[j] for j in range(lo, hi)}
        inside = sorted({j for s in range(lo, hi) for e in range(s + least, min(hi, s + 2 * least - 1) + 1)
                         if 5 * sum(same[i] for i in range(s, e)) >= 4 * (e - s) for j in range(s, e)})
        for _, run in itertools.groupby(enumerate(inside), lambda p: p[1] - p[0]):
            run = [j for _, j in run]
            out.add((shift + run[0], len(run), sum(same[j] for j in run)))
    return out


def substituted(words, places):
    return " ".join("zz%d" % i if i in places else w for i, w in enumerate(words))


def test_substitutions_anywhere_keep_an_overlap(spark):
    words = ["w%d" % i for i in range(15)]
    cases = [c for n in (1, 2, 3, 4) for c in itertools.combinations(range(15), n)]
    docs = brute.documents(spark, [substituted(words, c) for c in cases])
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    found = {r.doc_id: r.longest for r in decontaminate.report(docs, benchmark).filter("contaminated").collect()}
    assert found == {i: 15 for i, c in enumerate(cases) if len(c) <= 3}


def test_overlaps_are_those_of_brute_force(spark):
    item = ["w%d" % i for i in range(60)]
    texts = [substituted(["x"] * rng.randint(0, 9) + item[rng.randint(0, 30):rng.randint(31, 60)] + ["y"] * rng.randint(0, 9),
                         {rng.randrange(70) for _ in range(rng.randint(0, 14))}) for _ in range(150)]
    # Four in 20 and five in 25 unequal, with no 15 tokens of which 12 are equal.
    texts += [substituted(item[:20], {5, 8, 11, 14}), substituted(item[5:30], {5, 6, 10, 14, 19})]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = brute.documents(spark, texts)
    wanted = [covered(t.split(), item) for t in texts]
    out = [{} for _ in texts]
    found = decontaminate.overlaps(docs, benchmark)
    names = docs.select("doc_id", decontaminate.row_name("doc_id").alias("_name"), F.xxhash64("text").alias("_hash"))
    for r in found.join(names, ["_name", "_hash"]).collect():
        out[r.doc_id][r.at, r.length, r.matches] = r.item_id
    assert [set(o) for o in out] == wanted and sum(map(bool, wanted)) > 50


def test_mix(spark):
    texts = [prose(rng.randint(1, 400)) for _ in range(120)] + [None, "", prose(5000)]
    docs = brute.documents(spark, texts, sources=("b", "a", None, "é", "c"))
    size = {i: len((t or "").split()) for i, t in enumerate(texts)}
    sources = {r.doc_id: r.source for r in docs.collect()}
    of = {s: sum(size[i] for i in size if sources[i] == s) for s in set(sources.values())}
    order = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    whole, target = 1.5 * sum(size.values()), {}
    while True:
        left = whole - sum(target.values())
        level = left / sum(weight[s] for s in of if s not in target)
        over = [s for s in of if s not in target and level * weight[s] > 2 * of[s]]
        if not over:
            break
        target |= {s: 2.0 * of[s] for s in over}
    target |= {s: level * weight[s] for s in of if s not in target}
    out = mixing.taken(docs, block=64).collect()
    assert len(out) == len(texts) and {r.doc_id: r.size for r in out} == size
    for s in of:
        mine = [r for r in out if sources[r.doc_id] == s]
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == of[s] and r.taken <= 2 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 1
    assert sorted(rows(mixing.taken(docs.repartition(5), block=64))) == sorted(tuple(r) for r in out)


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(0, 500), (1, 300), (2, 7), (3, 0)], "source_no long, slots long")
    slots = sorted(rows(mixing.schedule(sources).select("slot", "source_no", "rank")))
    for number, n in ((0, 500), (1, 300), (2, 7)):
        assert [r for _, s, r in slots if s == number] == list(range(n))
        seen = 0
        for i, (_, s, _) in enumerate(slots, 1):
            seen += s == number
            assert abs(seen - i * n / 807) < 8


def test_languages(spark):
    texts = {"en": "the quick brown fox and the lazy dog were there with them", "de": "der schnelle braune fuchs und das ist nicht gut",
             "fr": "le renard brun et les chiens sont dans la maison avec nous"}
    docs = brute.documents(spark, [t for t in texts.values()] * 20, langs=tuple(texts))
    filters = language.train(docs, sample=30)
    asked = brute.documents(spark, [None, "", "123 !!", "the fox and the dog", "das ist der fuchs", "les chiens et la maison", "ж"])
    got = {r.doc_id: r.p for r in asked.select("doc_id", language.predict(F.col("text"), filters).alias("p")).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "de", "fr"] and got[6].lang_pred in texts
    assert all(0 <= p.score <= 1 for p in got.values())
    assert language.train(docs.limit(0)) is None
    alone = asked.select(language.predict(F.col("text"), None).alias("p")).select("p.lang_pred").distinct()
    assert rows(alone) == [("und",)]


def test_votes_count_every_gram(spark):
    tokens = ["abc", "l'eau,", "42", "ab-c" * 5, "a"]
    grams = [language.grams_of(t) for t in tokens]
    every = sorted({g for own in grams for g in own})
    filters = language.Filters.build(["x", "y"], "x", every, language.np.array([[1, i % 2] for i in range(len(every))], bool), 1 << 16)
    votes = filters.votes(tokens)
    assert votes[:, 0].tolist() == votes[:, 2].tolist() == [len(own) for own in grams]
    assert votes[:, 1].tolist() == [sum(every.index(g) % 2 for g in own) for own in grams]


def test_filters_answer_for_more_than_64_languages():
    names = ["l%02d" % i for i in range(70)]
    grams = ["g%02d" % i for i in range(70)]
    filters = language.Filters.build(names, names[0], grams, language.np.eye(70, dtype=bool), 1 << 14)
    hit = filters.bits(filters.contained(language.code_points("".join(grams)).reshape(-1, 3)))
    assert all(hit[i, i] for i in range(70)) and hit.mean() < 0.05


def test_quality(spark):
    good = [prose(80) + "." for _ in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in prose(60).split()) for _ in range(60)]
    docs = brute.documents(spark, [t for pair in zip(good, bad) for t in pair] + [None, "", "\n\n", prose(20000)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)] + [(1, 1), (None, 1), (5, None)], "doc_id long, quality int")
    field = quality.train(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality.score(F.col("text"), field).alias("s")).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 0) for i in range(120)) and all(0 <= s <= 1 for s in got.values())
    plain = quality.train(docs, labels.limit(0))
    assert all(0 <= r.s <= 1 for r in docs.select(quality.score(F.col("text"), plain).alias("s")).collect())


def test_marginals_equal_enumeration():
    np = quality.np
    random_numbers = np.random.default_rng(1)
    field = quality.Field(random_numbers.standard_normal(3), random_numbers.standard_normal((2, 2)))
    x, starts = random_numbers.standard_normal((7, 3)), np.array([0, 4, 5])
    good, pairs, _ = field.beliefs(x, starts)
    expected, both = np.zeros(7), np.zeros((2, 2))
    for a, b in ((0, 4), (4, 5), (5, 7)):
        total = 0.0
        for states in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(s * (x[a + i] @ field.weights) for i, s in enumerate(states))
                       + sum(field.transition[s, t] for s, t in zip(states, states[1:])))
            total += p
        for states in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(s * (x[a + i] @ field.weights) for i, s in enumerate(states))
                       + sum(field.transition[s, t] for s, t in zip(states, states[1:]))) / total
            expected[a:b] += p * np.array(states)
            for s, t in zip(states, states[1:]):
                both[s, t] += p
    assert np.allclose(good, expected) and np.allclose(pairs, both)


def test_empty_tables(spark):
    docs = brute.documents(spark, ["x"]).limit(0)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert simhash.groups(docs).count() == simhash.one_of_each(docs).count() == 0
    assert suffix_dedup.dedup(docs).count() == line_dedup.dedup(docs).count() == 0
    assert decontaminate.report(docs, empty).count() == mixing.taken(docs).count() == 0
    assert token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0
