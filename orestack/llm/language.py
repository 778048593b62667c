"""Language identification with bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from orestack.llm.common import saved, slices

GRAMS = (2, 3, 4)
HASHES = 4
REMEMBERED = 300_000
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def runs_of(token: str) -> list[str]:
    """The letter runs of a token. A run without a letter, only of signs that stand for numbers, is none."""
    return [run for run in LETTERS.findall(token) if run.isalpha() or any(map(str.isalpha, run))]


def grams_of(token: str) -> list[str]:
    """The n-grams of the letter runs in a token, with a blank at both ends of a run."""
    runs = [f" {run} " for run in runs_of(token)]
    return [run[i: i + n] for run in runs for n in GRAMS for i in range(len(run) - n + 1)]


def places(codes: np.ndarray, slots: int) -> np.ndarray:
    """The slots of n-grams, one row of code points each, by double hashing."""
    mixed = np.full(len(codes), codes.shape[1], np.uint64)
    for column in codes.T:
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(slots)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


@dataclass
class Filters:
    """One slot holds a bit per language: a look-up answers for all languages at once.

    ``table`` has the slots of all filters, 64 languages per column; ``false_positive`` is each
    language's rate, from the share of its bits that are set.
    """

    languages: list[str]
    default: str
    table: np.ndarray
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: list[str], default: str, grams: list[str], member: np.ndarray, slots: int) -> Filters:
        """``member`` says for each n-gram which languages it belongs to."""
        words = -(-max(1, len(languages)) // 64)
        masks = np.zeros((len(grams), words), np.uint64)
        for i in range(len(languages)):
            masks[:, i // 64] |= member[:, i].astype(np.uint64) << np.uint64(i % 64)
        table = np.zeros((slots, words), np.uint64)
        for n in {len(g) for g in grams}:
            own = np.array([i for i, g in enumerate(grams) if len(g) == n])
            at = places(code_points("".join(grams[i] for i in own)).reshape(-1, n), slots)
            for k in range(HASHES):
                np.bitwise_or.at(table, at[:, k], masks[own])
        made = cls(languages, default, table, np.zeros(len(languages)))
        made.false_positive = made.bits(table).mean(axis=0) ** HASHES if languages else made.false_positive
        return made

    def bits(self, masks: np.ndarray) -> np.ndarray:
        """Masks as a 0/1 column per language."""
        i = np.arange(len(self.languages))
        return (masks[:, i // 64] >> (i % 64).astype(np.uint64) & np.uint64(1)).astype(np.float64)

    def contained(self, codes: np.ndarray) -> np.ndarray:
        """Masks of the languages that may contain each n-gram, given as rows of code points."""
        return np.bitwise_and.reduce(self.table[places(codes, len(self.table))], axis=1)

    def votes(self, tokens: list[str]) -> np.ndarray:
        """For each token how many of its n-grams each language contains, and in the last column how many it has."""
        runs = ["".join(" " + run for run in runs_of(token)) for token in tokens]
        codes = code_points("".join(runs) + " ")
        owner = np.repeat(np.arange(len(tokens)), np.fromiter(map(len, runs), np.int64, len(runs)))
        out = np.zeros((len(tokens), len(self.languages) + 1))
        blank = codes == 32
        for n in GRAMS:
            rows = np.lib.stride_tricks.sliding_window_view(codes, n) if len(codes) >= n else np.zeros((0, n), np.uint64)
            # A blank stands at the ends of a run only.
            fits = ~np.lib.stride_tricks.sliding_window_view(blank, n)[:, 1:-1].any(axis=1) if len(rows) else np.zeros(0, bool)
            at = np.flatnonzero(fits)
            masks, own = self.contained(rows[at]), owner[at]
            for i in range(len(self.languages)):
                out[:, i] += np.bincount(own, masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1), len(tokens))
            out[:, -1] += np.bincount(own, minlength=len(tokens))
        return out

    def decide(self, hits: np.ndarray, total: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and share of the corrected popcounts for rows of per-language popcounts."""
        if not self.languages:
            return [self.default] * len(hits), np.zeros(len(hits))
        rate = np.minimum(self.false_positive, 0.999)
        true = np.maximum(0.0, (hits - rate * total[:, None]) / (1 - rate))
        whole = true.sum(axis=1)
        best = true.argmax(axis=1)
        score = np.divide(true[np.arange(len(true)), best], whole, out=np.zeros(len(true)), where=whole > 0)
        return [self.languages[b] if w > 0 else self.default for b, w in zip(best, whole)], score


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = 5_000,
          capacity: int = 50_000, slots: int = 1 << 21, at_least: int = 3, near: float = 0.5) -> Filters | None:
    """Filters learnt from about ``sample`` labelled documents of every language; None without any labelled text.

    The sample is chosen by a hash of key and text, so neither a frequent language nor a repeated key takes
    the place of others; rows that repeat count as often as they stand. Spark counts the n-grams of whole
    texts per language; an n-gram belongs to each language where it is at least ``near`` times as frequent, per
    n-gram, as where it is most frequent. Of every language the ``capacity`` most frequent n-grams, ties in their own
    order, that are seen ``at_least`` times in all, go into the filters. Only the
    three columns are read; rows without a text or a language are not learnt from.
    """
    labelled = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna(
        subset=["text", "lang"])
    totals = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    if totals.isEmpty():
        return None
    steps = 1 << 20
    share = (F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n")) * steps).cast("long")
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("")), F.xxhash64("text"), F.lit("sample")), F.lit(steps))
    chosen = labelled.join(totals, "lang").filter(drawn < share).select("key", "text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                seen.setdefault(name, Counter()).update(value.lower().split())
        for name, tokens in seen.items():
            grams: Counter = Counter()
            for token, n in tokens.items():
                for gram in grams_of(token):
                    grams[gram] += n
            items = list(grams.items())
            for i in range(0, len(items), 50_000):
                part = items[i: i + 50_000]
                yield pd.DataFrame({"lang": name, "gram": [g for g, _ in part], "n": [n for _, n in part]})

    counts = (chosen.select("lang", "text").mapInPandas(count, "lang string, gram string, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = saved(counts, "gram-counts")
    per_gram = counts.groupBy("gram").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("by")).filter(
        F.col("n") >= at_least)
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    frequent = (counts.join(per_gram.select("gram"), "gram", "left_semi").withColumn("place", F.row_number().over(best))
                .filter(F.col("place") <= capacity).select("gram").distinct())
    rows = (per_gram.join(frequent, "gram", "left_semi").orderBy("gram")
            .select("gram", F.col("by.lang").alias("langs"), F.col("by.n").alias("counts")).toArrow())
    sizes = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    languages = sorted(sizes)
    place = {name: i for i, name in enumerate(languages)}
    grams, lists, numbers = (rows.column(c).combine_chunks() for c in ("gram", "langs", "counts"))
    at = np.repeat(np.arange(len(grams)), np.diff(lists.offsets.to_numpy()))
    where = np.array([place[name] for name in lists.flatten().to_pylist()], np.int64)
    rate = np.zeros((len(grams), len(languages)))
    rate[at, where] = numbers.flatten().to_numpy() / np.maximum(1, [sizes[name] for name in languages])[where]
    member = (rate > 0) & (rate >= near * rate.max(axis=1, keepdims=True, initial=0))
    default = max(languages, key=lambda name: (sizes[name], name))
    return Filters.build(languages, default, grams.to_pylist(), member, slots)


def predict(text: Column, filters: Filters | None) -> Column:
    """Struct of ``lang_pred`` and ``score`` (0 to 1) for a whole text of any length.

    ``und`` with score 0 for null, for a text without a letter, and where nothing was learnt. A text
    whose n-grams are all unknown gets the largest learnt language, with score 0. Equal texts get equal
    answers, and of languages with equal counts the first by name wins.
    """

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = filters or Filters([], UNDETERMINED, np.zeros((1, 1), np.uint64), np.zeros(0))
        known: dict[str, int] = {}
        votes = np.zeros((0, len(model.languages) + 1))
        for batch in batches:
            texts, names, scores = ["" if t is None else t for t in batch], [], []
            for start, end in slices(texts, 1_000_000):
                tokens = [t.lower().split() for t in texts[start:end]]
                if len(known) > REMEMBERED:
                    known, votes = {}, votes[:0]
                new = list(set().union(*tokens) - known.keys())
                known.update(zip(new, range(len(known), len(known) + len(new))))
                votes = np.concatenate([votes, model.votes(new)])
                sums = np.array([votes[list(map(known.__getitem__, own))].sum(axis=0) for own in tokens])
                lettered = sums[:, -1] > 0
                langs, score = model.decide(sums[:, :-1], sums[:, -1])
                names += [name if ok else UNDETERMINED for name, ok in zip(langs, lettered)]
                scores += np.where(lettered, score, 0.0).tolist()
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return F.pandas_udf(predicted, "lang_pred string, score double")(text)
