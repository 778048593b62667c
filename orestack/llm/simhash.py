"""Near-duplicate groups by SimHash, linked through an inverted index of byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from orestack.llm.common import saved
from orestack.llm.graph import components

SEED = 42
BYTES = 8
PAIRED = 1_000  # entries of a list that are still compared in pairs


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of the word shingles of a text, as a signed long.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are joined by a blank and
    hashed with XXH64; a bit is set when over half of the hashes have it. A text of fewer words is one
    shingle, a text without words (null and empty ones too) has the fingerprint zero.
    """

    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from xxhash import xxh64_intdigest

        def of(value: str | None) -> int:
            words = value.encode().lower().split() if value else []
            if not words:
                return 0
            n = max(1, len(words) - shingle + 1)
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.r_[0, ends[:-1] + 1][:n].tolist()
            ends = ends[len(words) - n:].tolist()
            hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)), "<u8", n)
            ones = np.zeros(64, np.int64)
            for i in range(0, n, 1 << 16):
                part = hashes[i: i + (1 << 16)]
                ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, np.int64)
            return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])

        for batch in batches:
            yield pd.Series([of(t) for t in batch], dtype="int64")

    return F.pandas_udf(prints, "long")(text)


def byte_masks(distance: int) -> list[int]:
    """Masks over the fewest byte positions that two fingerprints within the distance must share."""
    share = BYTES - distance
    if share < 1:
        raise ValueError(f"a distance of {distance} bits may change every byte")
    masks = (sum(255 << 8 * i for i in chosen) for chosen in combinations(range(BYTES), share))
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _first_shared(a: Column, b: Column, mask: Column) -> Column:
    """Whether the mask is made of the first bytes that two fingerprints share, of all masks that they share."""
    differing = a.bitwiseXOR(b)
    def fits(i: int) -> Column:
        byte = F.lit((255 << 8 * i) - ((1 << 64) if i == BYTES - 1 else 0))
        return (mask.bitwiseAND(byte) != 0) | (F.shiftrightunsigned(mask, 8 * i) == 0) | (differing.bitwiseAND(byte) != 0)

    return reduce(Column.__and__, map(fits, range(BYTES)))


def _ball(radius: int) -> str:
    """The patterns of up to ``radius`` bits that change none of the bits of ``mask``."""
    bits = ", ".join(f"shiftleft(1L, {i})" for i in range(8 * BYTES))
    flips = f"concat(array(0L), filter(array({bits}), bit -> (mask & bit) = 0))"
    found = "array(0L)"
    for _ in range(radius):
        found = f"array_distinct(flatten(transform({found}, x -> transform({flips}, y -> x ^ y))))"
    return found


def links(prints: DataFrame, distance: int = 3, column: str = "fp", most: int = PAIRED) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints that differ in at most ``distance`` bits, each once.

    Two fingerprints that differ so little are always connected by these pairs, mostly by their own.

    ``distance`` differing bits touch at most so many bytes, so a pair shares at least ``8 - distance``
    positional bytes: the guaranteed count. An entry of the inverted index is the content of that many
    positions together, so only pairs that reach the count meet in a list; their bits are then verified.
    Lists of single bytes would hold 1/256 of all fingerprints each, and tallies quadratic in the input.
    Fingerprints are distinct before they are indexed, so a group of equal texts is one entry.

    A pair may meet in many lists; it is made in that of the first bytes it shares alone, before anything is shuffled.
    Within a list of over ``most`` entries no pairs are made, so its work grows with the list and not with its
    square. Any pair of the list has a point between, half of the distance from either side. Whoever is within the
    smaller half of a point is thereby linked to whoever is within the larger half of it, so the smallest of the
    first, linked to all of them, connects the same fingerprints. Few fingerprints can be as near to one point.
    """
    masks = F.array(*(F.lit(m) for m in byte_masks(distance)))
    index = (prints.select(F.col(column).alias("fp")).dropna().distinct()
             .select("fp", F.explode(masks).alias("mask"))
             .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("content")))
    # The index is many times the fingerprints: it is shuffled once, and its lists are counted where they meet.
    entries = F.count(F.lit(1)).over(Window.partitionBy("mask", "content"))
    members = saved(index.withColumn("n", entries).filter("n > 1"), "byte-list-members")

    short = members.filter(F.col("n") <= most)
    other = short.select(F.col("fp").alias("b"), "mask", "content")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    same = (F.col("l.mask") == F.col("r.mask")) & (F.col("l.content") == F.col("r.content"))
    first_list = _first_shared(F.col("a"), F.col("b"), F.col("l.mask"))
    pairs = (short.withColumnRenamed("fp", "a").alias("l")
             .join(other.alias("r"), same & (F.col("a") < F.col("b")) & near & first_list).select("a", "b"))

    def points(radius: int) -> DataFrame:
        return (members.filter(F.col("n") > most).select("fp", F.explode(F.expr(_ball(radius))).alias("pattern"))
                .select("fp", F.col("fp").bitwiseXOR(F.col("pattern")).alias("point")))

    half = distance // 2
    first = points(half).groupBy("point").agg(F.min("fp").alias("first"))
    around = points(distance - half).join(first, "point").filter("fp != first").select(
        F.least("fp", "first").alias("a"), F.greatest("fp", "first").alias("b"))
    return pairs.union(around).distinct()


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """``fp`` and ``root``, the class of each different fingerprint."""
    roots = components(links(prints, distance), "a", "b").withColumnRenamed("node", "fp")
    return saved(prints.select("fp").distinct().join(roots, "fp", "left")
                 .select("fp", F.coalesce("root", "fp").alias("root")), "classes")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, a row per row of the documents.

    The component id is the smallest key reachable over links; a null key takes part but is never the
    smallest unless its component has no other. Equal fingerprints always link, zero included. Repeated
    rows come back as often as they went in; an empty table gives no rows; other columns are ignored.
    """
    prints = saved(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    classes = _classes(prints, distance)
    low = prints.groupBy("fp").agg(F.min("key").alias("low")).join(classes, "fp")
    smallest = low.groupBy("root").agg(F.min("low").alias("component_id"))
    member = saved(classes.join(smallest, "root").select("fp", "component_id"), "members")
    return prints.join(member, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents' own columns, with one document kept of each near-duplicate group.

    The one with the smallest key stays (a null key only where there is no other); of several rows with
    that key, one text is chosen by its hash, and of rows that repeat key and text one stays. A text
    without words links to every other such text, as the fingerprint says.
    """
    # A key that is never null, and a hash of the text, tell rows apart.
    named = {"_name": F.when(F.col(key).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(key).cast("string"))),
             "_hash": F.xxhash64(text)}
    prints = saved(docs.select(F.col(key).alias("key"), named["_name"].alias("_name"), named["_hash"].alias("_hash"),
                               fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    row = F.struct(F.col("key").isNull(), "key", "_hash", "_name")
    kept = (prints.groupBy("fp").agg(F.min(row).alias("row")).join(_classes(prints, distance), "fp")
            .groupBy("root").agg(F.min("row").alias("row")).select("row._name", "row._hash"))
    rows = docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in named.items()))
    return rows.join(kept, ["_name", "_hash"], "left_semi").dropDuplicates(["_name", "_hash"]).select("row.*")
