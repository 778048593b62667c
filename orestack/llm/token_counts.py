"""Token counts under a byte-pair vocabulary, by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import slices

# Words whose counts a task remembers before it starts afresh.
REMEMBERED = 400_000


class Vocabulary:
    """A byte-level BPE vocabulary with word ends, as arrays.

    ``frame`` is the tokenizer file without its model: the normaliser, the splitter and the special
    tokens, which the library applies as it does by default. The merges are done here.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"]:
            raise ValueError(f"{path} is not a plain BPE vocabulary")
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([ids[m[side]] for m in merges], np.int64) for side in (0, 1))
        merged = np.array([ids[a[: len(a) - len(suffix)] + b if suffix and a.endswith(suffix) else a + b]
                           for a, b in merges], np.int64)
        order = np.argsort(keys := left << 32 | right, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        letters = [c for c in ids if len(c) == 1]
        self.plain = np.full(max(map(ord, letters)) + 1, -1, np.int64)
        self.last = self.plain.copy()
        for c in letters:
            self.plain[ord(c)], self.last[ord(c)] = ids[c], ids.get(c + suffix, -1)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that look at their surroundings")
        self.frame = json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})

    def pieces(self) -> Callable[[str], tuple[int, list[str]]]:
        """A function from a text to the special tokens in it and the pre-tokens of the rest."""
        from tokenizers import Tokenizer

        frame = Tokenizer.from_str(self.frame)
        special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

        def split(text: str) -> tuple[int, list[str]]:
            parts = special.split(text)
            return len(parts) - 1, [piece for part in parts if part for piece, _ in
                                    frame.pre_tokenizer.pre_tokenize_str(frame.normalizer.normalize_str(part))]

        return split

    def count(self, pieces: list[str]) -> np.ndarray:
        """Symbols that are left of each pre-token once no pair can be merged.

        All pre-tokens lie in one array. In every round each of them merges all occurrences of its own
        lowest-ranked pair, from left to right; those without a pair leave the array.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        left_over = lengths.copy()
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        symbols, ends = self.plain[codes], np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[codes[ends]]
        if (symbols < 0).any():
            raise ValueError("a byte has no symbol in this vocabulary")
        owner = np.repeat(np.arange(len(pieces)), lengths)
        while len(symbols):
            key = symbols << 32
            key[:-1] |= symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            found[:-1] &= owner[:-1] == owner[1:]
            found[-1] = False
            rank = np.where(found, self.ranks[at], len(self.keys))
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(owner)]))
            merge = np.flatnonzero(found & (rank == best))
            if len(merge):
                # In a run of one symbol every other pair is taken: aaa becomes (aa)a.
                run = np.maximum.accumulate(np.where(np.r_[True, np.diff(merge) > 1], np.arange(len(merge)), 0))
                merge = merge[(np.arange(len(merge)) - run) % 2 == 0]
                symbols[merge] = self.merged[at[merge]]
                np.subtract.at(left_over, owner[merge], 1)
            keep = best < len(self.keys)
            keep[merge + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return left_over


def token_count(text: Column, vocabulary: Vocabulary) -> Column:
    """Tokens of a text without begin, end or added special tokens; 0 for null and empty texts.

    Whole texts of any length count. Words are cut at blanks and line ends, where no pre-token and no
    special token of such a vocabulary crosses, so equal words of a task are merged once.
    """

    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split, known = vocabulary.pieces(), {}
        for batch in batches:
            texts, out = ["" if t is None else t for t in batch], []
            for start, end in slices(texts):
                lines = [t.replace("\n", " ").split(" ") for t in texts[start:end]]
                if len(known) > REMEMBERED:
                    known = {}
                new = list(set().union(*lines) - known.keys())
                parts = [split(word) for word in new]
                sizes = vocabulary.count([piece for _, pieces in parts for piece in pieces])
                at = np.cumsum([0, *(len(pieces) for _, pieces in parts)])
                total = np.r_[0, np.cumsum(sizes)]
                known.update(zip(new, (total[at[1:]] - total[at[:-1]] + [n for n, _ in parts]).tolist()))
                out += [sum(map(known.__getitem__, words)) for words in lines]
            yield pd.Series(out, dtype="int64")

    return F.pandas_udf(counts, "long")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """The documents' columns but the text, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    One row comes back per row: repeated rows and null ids stay, an empty table gives none, and a column
    of one of the three names is replaced. ``path`` names a vocabulary file that the driver can read.
    """
    counted = docs.withColumns({"n_bytes": F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")),
                                "n_tokens": token_count(F.col(text), Vocabulary(path))})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).drop(text)
