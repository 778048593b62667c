"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from orestack.llm.common import WORD_PATTERN, saved
from orestack.llm.line_dedup import row_name

GOLDEN = (math.sqrt(5) - 1) / 2
# Rows of one bucket of a shuffled source, and slots of one chunk of the schedule: what a window task sorts.
BUCKET_ROWS = 2_000
CHUNK_SLOTS = 16_384


def running(df: DataFrame, order: list[Column], value: Column) -> DataFrame:
    """The rows with ``before``, the sum of ``value`` over all rows earlier in a global order.

    The rows are range-sorted into partitions and numbered; only a total per partition is summed up in
    one place.
    """
    part = F.shiftright("_at", 33)
    rows = saved(df.withColumn("_value", value).orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
                 .withColumn("_part", part), "ordered")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").agg(F.sum("_value").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(offsets, "_part")
            .withColumn("before", F.col("_offset") + F.col("_inside"))
            .drop("_value", "_at", "_part", "_inside", "_offset"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_no``, ``source_size`` and ``target`` for every source of ``sizes(source, size)``.

    Sources in code point order, null last, take the weights in turn and share ``share`` times all sizes
    by weight; a target stops at ``most`` times its source's size, and what is over is shared again by
    weight until none is above. Only sums over all sources reach the driver, one row per round.
    """
    if not 0 <= share <= most:
        raise ValueError("the share must be between 0 and the most that a source may give")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(totals, [F.col("source").asc_nulls_last()], F.lit(1)).withColumnRenamed("before", "source_no")
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    ranked = saved(ranked.withColumn("weight", turn), "sources")
    bound = F.lit(float(most)) * F.col("source_size")
    whole, level, stopped = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share, 0.0, -1
    above = F.lit(False)
    while True:
        held, open_weight, number = ranked.agg(
            F.sum(F.when(above, bound)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if number == stopped:
            break
        # Without an open source every target is at its bound already.
        stopped, level = number, (whole - (held or 0.0)) / open_weight if open_weight else math.inf
        above = F.lit(level) * F.col("weight") > bound
    return ranked.select("source", "source_no", "source_size",
                         F.least(bound, F.lit(level) * F.col("weight")).alias("target"))


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of a mix: ``slot`` (its place), ``source_no`` and ``rank`` (the n-th of its source).

    ``sources`` has ``source_no`` and ``slots``, the number that each source gets. Slot n looks at the
    golden-ratio point n * 0.618... mod 1 in the cumulative slots of the sources, so every stretch of the
    schedule has each source close to its share. A source meets its number exactly: a point beyond it is
    left out, and one that is missing at the end is appended.
    """
    ends = saved(running(sources, [F.col("source_no")], F.col("slots")), "cumulative")
    count, number = ends.agg(F.sum("slots"), F.count("*")).first()
    total = count or 0
    width = max(1, -(-total // (4 * number + 1024)))
    ranges = ends.filter("slots > 0").select(
        "source_no", "slots", F.col("before").alias("low"), (F.col("before") + F.col("slots")).alias("high"))
    bins = ranges.withColumn("bin", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))))
    spark = sources.sparkSession
    turn = F.col("id") * F.lit(GOLDEN)
    point = F.least(((turn - F.floor(turn)) * total).cast("long"), F.lit(max(0, total - 1)))
    points = spark.range(total).select(F.col("id").alias("slot"), point.alias("point"))
    hits = (points.withColumn("bin", F.expr(f"point div {width}")).join(bins, "bin")
            .filter("point >= low AND point < high")
            .select("slot", "source_no", "slots", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk")))
    hits = saved(hits, "slots")
    # Ranks of a hot source: inside chunks first, then over the counts of the chunks.
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = hits.groupBy("source_no", "chunk").agg(F.count("*").alias("_n"))
    offsets = counts.select("source_no", "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = (hits.withColumn("_inside", F.row_number().over(inside) - 1).join(offsets, ["source_no", "chunk"])
              .withColumn("rank", F.col("_offset") + F.col("_inside")).filter("rank < slots"))
    found = counts.groupBy("source_no").agg(F.sum("_n").alias("_found"))
    missing = (ranges.join(found, "source_no", "left").withColumn("_found", F.coalesce("_found", F.lit(0)))
               .filter("_found < slots")
               .select((F.lit(total) + F.col("low")).alias("_late"), "source_no",
                       F.explode(F.sequence(F.col("_found"), F.col("slots") - 1)).alias("rank")))
    return ranked.select("slot", "source_no", "rank").unionByName(
        missing.select((F.col("_late") + F.col("rank")).alias("slot"), "source_no", "rank"))


def shuffled(sizes: DataFrame, seed: int = 42) -> DataFrame:
    """``sizes(key, digest, copy, source_no, size)`` with ``start``, the words before a document in its shuffled source.

    The order is that of a hash of key, text and number of the copy, so neither a source nor a key with a third
    of all rows gathers in one task. Sums run inside buckets of the hash, then over the totals of the buckets
    of a stretch, and then over the totals of the stretches.
    """
    buckets = max(1, -(-sizes.count() // BUCKET_ROWS))
    hashed = (sizes.withColumn("_hash", F.xxhash64("key", "digest", "copy", F.lit(seed)))
              .withColumn("_bucket", F.pmod("_hash", F.lit(buckets))).drop("copy"))
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("source_no", "_bucket").orderBy("_hash", "key", "size").rowsBetween(*before)
    stretch = F.floor(F.col("_bucket") / BUCKET_ROWS)
    totals = hashed.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_sum")).withColumn("_stretch", stretch)
    over = Window.partitionBy("source_no", "_stretch").orderBy("_bucket").rowsBetween(*before)
    above = Window.partitionBy("source_no").orderBy("_stretch").rowsBetween(*before)
    stretches = totals.groupBy("source_no", "_stretch").agg(F.sum("_sum").alias("_sum")).select(
        "source_no", "_stretch", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_above"))
    offsets = totals.join(stretches, ["source_no", "_stretch"]).select(
        "source_no", "_bucket", (F.col("_above") + F.coalesce(F.sum("_sum").over(over), F.lit(0))).alias("_offset"))
    return (hashed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, ["source_no", "_bucket"])
            .withColumn("start", F.col("_offset") + F.col("_inside")).drop("_hash", "_bucket", "_inside", "_offset"))


def numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``copy``, the numbers from 0 on among the rows that repeat key, text and source, instead of ``chunk``.

    These rows are alike, so it does not matter which gets which number. They are counted inside chunks, and
    then over the chunks.
    """
    same = ["key", "digest", "source"]
    inside = Window.partitionBy(*same, "chunk").orderBy("size")
    before = Window.partitionBy(*same).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = sizes.groupBy(*same, "chunk").agg(F.count("*").alias("_n"))
    earlier = counts.select(*same, "chunk", F.sum("_n").over(before).alias("_earlier")).filter("_earlier > 0")
    joined = sizes.withColumn("_inside", F.row_number().over(inside) - 1).alias("s").join(
        earlier.alias("e"), F.expr("s.key <=> e.key AND s.source <=> e.source AND s.digest = e.digest AND s.chunk = e.chunk"), "left")
    return joined.select("s.*", (F.col("_inside") + F.coalesce("_earlier", F.lit(0))).alias("copy")).drop("chunk", "_inside")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        block: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The documents with their targets, and the pieces of documents that the mix takes.

    First frame, a row per row of the documents: ``key``, ``source_no``, ``size`` (words), ``source_size``,
    ``target``, ``digest`` (a hash of the text), ``start`` (its place in the shuffled source). Second frame:
    ``slot`` (the order of the mix; numbers may be missing), ``source_no``, ``start``, ``at`` and ``words``: the words
    taken there, and how many of the document stand before them. Each source is a shuffled stream of words, cut
    into blocks of ``block`` words and begun again at its end; a slot takes the next block of its source,
    and the last one only what is left to the target. So a source takes its target rounded to a word, and
    a document at most ``most`` times its size.

    A null text has no words, a null source is a source of its own, and a null key is a key like any
    other. Rows that repeat are documents of their own. An empty table gives empty frames. Only the key,
    source and text columns are read.
    """
    words = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sizes = saved(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words.alias("size"),
                              F.xxhash64(text).alias("digest"), F.spark_partition_id().alias("chunk")), "sizes")
    sources = saved(targets(sizes, weights, share, most).withColumn("quota", F.round("target").cast("long")), "targets")
    copies = numbered(sizes)
    named = copies.join(sources.select("source", "source_no"), copies["source"].eqNullSafe(sources["source"])).select(
        "key", "digest", "copy", "source_no", "size")
    placed = shuffled(named).join(sources.drop("source"), "source_no")
    placed = saved(placed, "placed")
    passes = math.ceil(most)
    runs = (placed.filter("size > 0").withColumn("_pass", F.explode(F.array(*(F.lit(i) for i in range(passes)))))
            .withColumn("low", F.col("start") + F.col("_pass") * F.col("source_size"))
            .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("quota"))).filter("low < high"))
    cut = (runs.withColumn("rank", F.explode(F.sequence(F.expr(f"low div {block}"), F.expr(f"(high - 1) div {block}"))))
           .withColumn("from", F.greatest("low", F.col("rank") * block))
           .withColumn("words", F.least("high", (F.col("rank") + 1) * block) - F.col("from"))
           .withColumn("at", F.col("from") - F.col("low")))
    slots = schedule(sources.select("source_no", F.expr(f"(quota + {block - 1}) div {block}").alias("slots")))
    pieces = cut.select("source_no", "rank", "start", "at", "words").join(slots, ["source_no", "rank"])
    return placed, pieces.select("slot", "source_no", "start", "at", "words")


def taken(docs: DataFrame, key: str = "doc_id", pieces: bool = False, **options) -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target`` and ``taken``, the words that ``mix`` takes of each row.

    With ``pieces`` also these, in the order of the mix: an array of ``slot``, ``at`` and ``words``, empty where
    nothing is taken. A document of n words has at most ``most`` times n / ``block`` + 2 pieces.
    """
    placed, cut = mix(docs, key, **options)
    # A row with words is the only one of its source that starts where it does.
    found = [F.sum("words").alias("taken")]
    if pieces:
        found.append(F.sort_array(F.collect_list(F.struct("slot", "at", "words"))).alias("pieces"))
    sums = cut.groupBy("source_no", "start").agg(*found).withColumn("some", F.lit(True))
    joined = placed.withColumn("some", F.col("size") > 0).join(sums, ["source_no", "start", "some"], "left")
    none = F.array().cast("array<struct<slot: bigint, at: bigint, words: bigint>>")
    return joined.select(F.col("key").alias(key), "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                         *([F.coalesce("pieces", none).alias("pieces")] if pieces else []))


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: ``slot``, ``key``, ``at``, ``words`` and ``text``, a row per piece; its order is that of the slots.

    A text is cut between words, and the white space before a word goes with it, so the pieces of a document
    that is taken once join to the whole of it, but for white space at its end. A slot has one block of a source, so the pieces
    of several documents may share it. Repeated rows are taken like any others. Only rows with words are in the mix.
    """
    placed, cut = mix(docs, key, text, **options)
    lists = cut.groupBy("source_no", "start").agg(F.collect_list(F.struct("slot", "at", "words")).alias("pieces"))
    chosen = placed.filter("size > 0").join(lists, ["source_no", "start"]).select(
        row_name("key").alias("name"), "digest", F.col("key").alias("key"), "pieces")
    known = docs.select(row_name(key).alias("name"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    spans = F.regexp_extract_all("text", F.lit(rf"([\x20\x09-\x0D]*{WORD_PATTERN})"), F.lit(1))
    named = known.dropDuplicates(["name", "digest"]).join(chosen, ["name", "digest"]).select("key", "pieces", spans.alias("spans"))
    cuts = F.transform("pieces", lambda p: F.struct(
        p["slot"].alias("slot"), p["at"].alias("at"), p["words"].alias("words"),
        F.array_join(F.slice("spans", (p["at"] + 1).cast("int"), p["words"].cast("int")), "").alias("text")))
    return named.select("key", F.explode(cuts).alias("piece")).select(
        "piece.slot", F.col("key").alias(key), "piece.at", "piece.words", F.col("piece.text").alias(text))
