"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import hash_fraction, slices

# Bits of the character classes.
UPPER, LETTER, DIGIT, SPACE, MARK = 1, 2, 4, 8, 16
OWN = 12
THRESHOLD = 0.3


def classes() -> np.ndarray:
    """The class bits of the first 65,536 characters; the others count as letters."""
    table = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        table[i] = (UPPER * c.isupper() | LETTER * c.isalpha() | DIGIT * c.isdigit() | SPACE * c.isspace()
                    | MARK * (not c.isalnum() and not c.isspace()))
    return table


def own_features(lines: list[str], first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Features of each line by itself, each about 0 to 1. ``first`` marks the first line of a text."""
    n = len(lines)
    sizes = np.fromiter(map(len, lines), np.int64, n)
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(codes < 1 << 16, table[np.minimum(codes, (1 << 16) - 1)], np.uint8(LETTER))
    starts = np.cumsum(sizes + 1) - sizes - 1

    def count(bit: int) -> np.ndarray:
        return np.add.reduceat((kinds & bit) > 0, starts, dtype=np.int64)

    upper, letter, digit, mark = count(UPPER), count(LETTER), count(DIGIT), count(MARK)
    long = np.maximum(1, sizes)
    words, distinct, repeats = np.zeros(n), np.zeros(n), np.zeros(n)
    seen: set[str] = set()
    for i, line in enumerate(lines):
        if first[i]:
            seen = set()
        tokens = line.split()
        words[i], distinct[i], repeats[i] = len(tokens), len(set(tokens)), line in seen
        seen.add(line)
    some = np.maximum(1, words)
    ending = np.fromiter((line.rstrip()[-1:] in (".", "!", "?", "…", "。", "\"", "»") for line in lines), float, n)
    return np.stack([
        np.log1p(sizes) / 8, np.log1p(words) / 6, np.minimum(letter / some, 20) / 20, upper / np.maximum(1, letter),
        letter / long, digit / long, mark / long, np.minimum(1, mark / some), distinct / some, repeats, ending,
        (words == 0).astype(float),
    ], axis=1)


def features(lines: list[str], starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Own features with those of the line before and after (zeros at the ends of a text), and a constant."""
    first = np.zeros(len(lines), bool)
    first[starts] = True
    own = own_features(lines, first, table)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first] = 0
    after[np.roll(first, -1)] = 0
    return np.concatenate([own, before, after, np.ones((len(lines), 1))], axis=1)


def lines_of(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All lines of the texts, and where each text starts; an empty text is one empty line."""
    split = [t.split("\n") for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    return [line for own in split for line in own], np.cumsum(sizes) - sizes


@dataclass
class Field:
    """A chain over the states bad (0) and good (1): a weight per feature, and one per transition.

    ``scale`` and ``shift`` turn a mean of marginals into the probability that the text is good: a bad
    text has good lines too, so a mean of a half is no even chance.
    """

    weights: np.ndarray
    transition: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def beliefs(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of each line, the expected transitions, and the log of the partition sums' product.

        All texts go forward and backward together, line by line, the longest first.
        """
        n = len(x)
        local = np.zeros((n, 2))
        local[:, 1] = x @ self.weights
        sizes = np.diff(np.r_[starts, n])
        order = np.argsort(-sizes, kind="stable")
        begin, size = starts[order], sizes[order]
        active = np.searchsorted(-size, -np.arange(size[0] + 1), side="left")  # texts longer than t lines
        alpha, beta, t = local.copy(), np.zeros((n, 2)), self.transition
        for i in range(1, size[0]):
            rows = begin[: active[i]] + i
            was = alpha[rows - 1]
            alpha[rows] += np.logaddexp(was[:, :1] + t[0], was[:, 1:] + t[1])
        for i in range(size[0] - 2, -1, -1):
            rows = begin[: active[i + 1]] + i
            later = local[rows + 1] + beta[rows + 1]
            beta[rows] = np.logaddexp(later[:, :1] + t[:, 0], later[:, 1:] + t[:, 1])
        ends = starts + sizes - 1
        log_z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
        each = np.repeat(log_z, sizes)
        good = np.exp(np.minimum(0, alpha[:, 1] + beta[:, 1] - each))
        inner = np.ones(n, bool)
        inner[starts] = False
        rows = np.flatnonzero(inner)
        pair = (alpha[rows - 1][:, :, None] + t + (local[rows] + beta[rows])[:, None, :] - each[rows][:, None, None])
        return good, np.exp(np.minimum(0, pair)).sum(axis=0), float(log_z.sum())

    def means(self, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The mean P(good) of the lines of each text, weighted by their length."""
        good, _, _ = self.beliefs(x, starts)
        weight = lengths + 1e-6
        return np.clip(np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts), 0, 1)

    def scores(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        lines, starts = lines_of(texts)
        lengths = np.fromiter(map(len, lines), float, len(lines))
        return logistic(self.scale * self.means(features(lines, starts, table), starts, lengths) + self.shift)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, starts: np.ndarray, lengths: np.ndarray, label: np.ndarray, steps: int = 150, rate: float = 0.15,
        ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood of chains whose lines carry the label of their text, by Adam."""
    sizes = np.diff(np.r_[starts, len(x)])
    of_line = np.repeat(label, sizes).astype(float)
    observed = x.T @ of_line
    kept = np.array([[((sizes - 1) * (label == 0)).sum(), 0], [0, ((sizes - 1) * (label == 1)).sum()]], float)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        field = Field(theta[:-4], theta[-4:].reshape(2, 2))
        good, pairs, _ = field.beliefs(x, starts)
        slope = np.r_[x.T @ good - observed, (pairs - kept).ravel()] / len(x) + ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        theta = theta - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    field = Field(theta[:-4], theta[-4:].reshape(2, 2))
    field.scale, field.shift = calibrate(field.means(x, starts, lengths), label)
    return field


def calibrate(mean: np.ndarray, label: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """Scale and shift of a logistic curve from means to labels, by Newton's method."""
    design, theta = np.stack([mean, np.ones(len(mean))], axis=1), np.zeros(2)
    for _ in range(steps):
        p = logistic(design @ theta)
        curve = design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, design.T @ (p - label) + ridge * theta), -5, 5)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = 3_000, most_lines: int = 300) -> Field:
    """A field fitted on about ``sample`` labelled documents of at most ``most_lines`` lines.

    The sample is chosen by a hash of the key, and only its features reach the driver. A document with
    contradicting labels is not used; of rows that repeat a key one text counts, chosen by its hash, so the
    features that the driver gets are bounded by ``sample`` and ``most_lines``. Documents without a key or a
    text are not learnt from, and other columns are ignored. Without any usable label every line is good
    with probability 1/2.
    """
    known = (labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter(F.col("label").isin(0, 1))
             .dropna().groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .filter(F.col("label") == F.col("other")))
    total = known.count()
    chosen = known.filter(hash_fraction(F.col("key"), sample / total)) if total > sample else known
    rows = (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).dropna()
            .filter(F.size(F.split("text", "\n")) <= most_lines).join(chosen, "key")
            .groupBy("key").agg(F.min("label").alias("label"), F.min(F.struct(F.xxhash64("text"), "text")).alias("one"))
            .select("key", "label", "one.text"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = classes()
        for batch in batches:
            texts = list(batch["text"])
            for a, b in slices(texts):
                lines, starts = lines_of(texts[a:b])
                x = features(lines, starts, table).astype("<f4")
                ends = np.r_[starts[1:], len(lines)]
                lengths = np.fromiter(map(len, lines), "<i8", len(lines))
                yield pd.DataFrame({"key": batch["key"].astype(str).iloc[a:b], "label": batch["label"].iloc[a:b],
                                    "x": [x[i:j].tobytes() for i, j in zip(starts, ends)],
                                    "length": [lengths[i:j].tobytes() for i, j in zip(starts, ends)]})

    found = rows.mapInPandas(measured, "key string, label int, x binary, length binary").toPandas().sort_values(["key", "x"])
    if found.empty:
        return Field(np.zeros(3 * OWN + 1), np.zeros((2, 2)))
    chains = [np.frombuffer(x, "<f4").reshape(-1, 3 * OWN + 1) for x in found["x"]]
    sizes = np.array([len(c) for c in chains])
    lengths = np.frombuffer(b"".join(found["length"]), "<i8").astype(float)
    return fit(np.concatenate(chains).astype(float), np.cumsum(sizes) - sizes, lengths, found["label"].to_numpy())


def score(text: Column, field: Field) -> Column:
    """P(good) of a whole text, 0 to 1; null counts as empty, and an empty text as one empty line."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = classes()
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            yield pd.Series([s for a, b in slices(texts) for s in field.scores(texts[a:b], table)], dtype="float64")

    return F.pandas_udf(scored, "double")(text)
