"""Benchmark decontamination with spaced seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import saved
from orestack.llm.line_dedup import row_name

# Which of the tokens of a window count (1) and which are ignored (0). In any 15 tokens with
# up to 3 substitutions at least one window of one mask sees none of them (a test goes through all cases).
MASKS = ("100010111", "11101001")


def tokens(text: str) -> Column:
    """The lower-case runs of letters, marks and digits of a text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def whole_part(size: Column, least: int, similarity: float) -> Column:
    """For an item of fewer than ``least`` tokens, how many neighbouring tokens of it every overlap leaves whole; else 0.

    An overlap has to cover such an item, with at most so many substitutions as ``similarity`` allows. These
    split the item in one piece more than there are of them, and the longest piece is at least this long.
    """
    allowed = F.floor(size * F.lit(1 - similarity) + F.lit(1e-9))
    return F.when(size < least, F.floor(size / (allowed + 1))).otherwise(0).cast("int")


def seeds(rows: DataFrame, *columns: str, parts: Sequence[int] = (), part: Column | None = None) -> DataFrame:
    """``columns``, ``at`` and ``seed``: for every window of ``tokens`` and every mask the hash of the tokens that count.

    ``parts`` are lengths of windows that count whole. With ``part`` a row has only the windows of that
    length, or those of the masks where it is 0.
    """
    at = rows.select(*columns, "tokens", (F.lit(None) if part is None else part).alias("_part"),
                     F.posexplode("tokens").alias("at", "_token"))
    masks = [(n, mask, 0) for n, mask in enumerate(MASKS)] + [(len(MASKS) + size, "1" * size, size) for size in parts]
    hashes = [F.when((F.col("at") <= F.size("tokens") - len(mask)) & (F.lit(True) if part is None else F.col("_part") == kind), F.xxhash64(
        F.lit(n), *(F.get("tokens", F.col("at") + i) for i, used in enumerate(mask) if used == "1")))
        for n, mask, kind in masks]
    return at.select(*columns, "at", F.explode(F.array(*hashes)).alias("seed")).filter(F.col("seed").isNotNull())


def stretches(least: int, similarity: float) -> str:
    """The covered runs (s, e, matches) of a diagonal, from ``lo``, ``hi``, ``need`` and the unequal places ``bad``.

    A run is a union of stretches of at least ``need`` tokens that are equal to ``similarity``. A longer such stretch
    splits into pieces of less than twice ``need`` of which one is such a stretch, so few unequal tokens need be asked;
    with the same unequal tokens the stretch between the next ones to both sides is the best.
    """
    most = int((2 * least - 1) * (1 - similarity) + 1e-9)
    every = ("flatten(transform(sequence(0, size(edges) - 2), a -> transform(sequence(1, least("
             f"{most + 1}, size(edges) - 1 - a)), n -> struct(edges[a] + 1 AS s, edges[a + n] AS e, n - 1 AS wrong))))")
    good = f"filter({every}, x -> x.e - x.s >= need AND x.e - x.s - x.wrong >= (x.e - x.s) * {similarity}D)"
    last = "get(acc, size(acc) - 1)"
    runs = (f"aggregate({good}, cast(array() AS array<struct<s: int, e: int>>), (acc, x) -> if({last}.e >= x.s, "
            f"concat(slice(acc, 1, size(acc) - 1), array(struct({last}.s AS s, greatest({last}.e, x.e) AS e))), "
            "concat(acc, array(struct(x.s AS s, x.e AS e)))))")
    return f"transform({runs}, r -> struct(r.s, r.e, r.e - r.s - size(filter(bad, j -> j >= r.s AND j < r.e)) AS matches))"


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
             item_text: str = "text", least: int = 15, similarity: float = 0.8) -> DataFrame:
    """The verified overlaps: ``_name`` and ``_hash`` of the document, ``item_id``, ``at``, ``length``, ``matches``.

    Windows of documents and items meet when a mask sees the same tokens in both. All aligned tokens of such a
    pair and shift are compared then: it overlaps where a stretch of ``least`` tokens or more (or the whole item,
    if shorter) has ``similarity`` of them equal. A row is the union of such stretches that touch, so up to a
    fifth of unequal tokens at its ends counts in ``length``. With the values given the masks see every stretch of an
    item of 15 tokens or more (tests go through the cases). A shorter item has windows without ignored places, so
    short that an overlap always leaves one of them whole. Insertions end a stretch. An item without an id or a
    token is never found.
    """
    items = saved(benchmark.select(F.col(item).cast("long").alias("item_id"), tokens(item_text).alias("tokens"))
                  .filter((F.size("tokens") > 0) & F.col("item_id").isNotNull()).distinct()
                  .withColumn("item", F.xxhash64("tokens")), "benchmark")
    part = whole_part(F.size("tokens"), least, similarity)
    # At most as many lengths as a short item has tokens.
    parts = sorted(r["part"] for r in items.select(part.alias("part")).distinct().filter("part > 0").collect())
    item_seeds = saved(seeds(items, "item_id", "item", parts=parts, part=part), "item-seeds")
    known = saved(item_seeds.select("seed").distinct(), "known-seeds")
    rows = docs.select(row_name(key).alias("_name"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    # Only ids, places and hashes meet the benchmark; the tokens of documents that were hit are fetched after.
    hits = saved(seeds(rows.select("_name", "_hash", tokens("_text").alias("tokens")), "_name", "_hash", parts=parts)
                 .join(known, "seed", "left_semi").distinct(), "seed-hits")
    met = (hits.join(item_seeds.select("seed", "item_id", "item", F.col("at").alias("item_at")), "seed")
           .select("_name", "_hash", "item_id", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    asked = met.join(items.withColumnRenamed("tokens", "item_tokens"), ["item_id", "item"])
    texts = (rows.join(hits.select("_name", "_hash").distinct(), ["_name", "_hash"], "left_semi")
             .dropDuplicates(["_name", "_hash"]).select("_name", "_hash", tokens("_text").alias("tokens")))
    diagonals = asked.join(texts, ["_name", "_hash"]).withColumns({
        "need": F.least(F.lit(least), F.size("item_tokens")), "lo": F.expr("greatest(0, -shift)"),
        "hi": F.expr("least(size(item_tokens), size(tokens) - shift)")}).filter("hi - lo >= need")
    compared = diagonals.withColumn("bad", F.expr(
        "filter(sequence(lo, hi - 1), j -> NOT coalesce(get(tokens, shift + j) = get(item_tokens, j), false))")).drop(
        "tokens", "item_tokens").filter(F.expr("hi - lo - size(bad)") >= F.col("need") * similarity)
    runs = compared.withColumn("edges", F.expr("concat(array(lo - 1), bad, array(hi))")).select(
        "_name", "_hash", "item_id", "shift", F.explode(F.expr(stretches(least, similarity))).alias("run"))
    return runs.select("_name", "_hash", "item_id", (F.col("shift") + F.col("run.s")).alias("at"),
                       (F.col("run.e") - F.col("run.s")).alias("length"), F.col("run.matches").alias("matches"))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``key``, ``contaminated``, ``n_items``, ``first_item``, ``longest``: a row per row of the documents."""
    text = options.get("text", "text")
    per = overlaps(docs, benchmark, key, **options).groupBy("_name", "_hash").agg(
        F.count_distinct("item_id").alias("n_items"), F.min("item_id").alias("first_item"), F.max("length").alias("longest"))
    rows = docs.select(F.col(key).alias("_key"), row_name(key).alias("_name"), F.xxhash64(text).alias("_hash"))
    return rows.join(per, ["_name", "_hash"], "left").select(
        F.col("_key").alias(key), F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_item", F.coalesce("longest", F.lit(0)).cast("long").alias("longest"))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents, all their columns, that hold no verified overlap with the benchmark.

    Null and empty texts and documents shorter than a mask stay. Rows that repeat stay or go together.
    An empty benchmark removes nothing.
    """
    text = options.get("text", "text")
    bad = overlaps(docs, benchmark, key, **options).select("_name", "_hash").distinct()
    named = docs.select(F.struct("*").alias("row"), row_name(key).alias("_name"), F.xxhash64(text).alias("_hash"))
    return named.join(bad, ["_name", "_hash"], "left_anti").select("row.*")
