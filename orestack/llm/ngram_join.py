"""Jaccard join of n-gram sets by vertical partitioning: overlaps are counted per fragment of a global order and summed."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import saved
from orestack.llm.graph import components
from orestack.llm.line_dedup import row_name

POSTINGS = 1 << 21  # of one bucket of the hash space, about
AT_ONCE = 1 << 21  # postings that a map task sorts together
BLOCK = 1024  # sets of one block
BLOCK_GRAMS = 1 << 22  # grams of one block, unless a single set has more
FRAGMENTS = 8  # of the global order
COLUMNS = 1024  # grams that are multiplied together
STRETCH = 1 << 22  # bytes of a text that are looked at together
MARK_BITS = 28  # of a gram's hash below its bucket
FILTER_BITS = 1 << 25  # of the filter that spares other texts the shuffle
MANY = 0xFFFF  # the owner of a gram that several sets of a batch have


# -- sets -----------------------------------------------------------------------------------------

class Grams:
    """The n-grams of texts as sorted arrays of different 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        random = np.random.default_rng(13)
        self.letters = random.integers(0, 1 << 64, (64, 256), np.uint64)  # by place in the word
        codes = np.arange(256, dtype=np.uint8)
        self.lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)
        self.blank = (codes == 32) | ((codes >= 9) & (codes <= 13))

    def words(self, data: np.ndarray) -> np.ndarray:
        """A hash per word, in order: the sum of a random number for every letter and place."""
        inside = ~self.blank[data]
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if not len(starts):
            return np.zeros(0, np.uint64)
        sizes = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - starts
        first = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(first, sizes)
        values = self.letters[place & 63, self.lower[data[inside]]]
        if sizes.max() > 64:
            values *= np.power(np.uint64(0xA0761D6478BD642F), (place >> 6).astype(np.uint64))
        found = np.add.reduceat(values, first) * np.uint64(0xE7037ED1A0B428DB)
        return found ^ found >> np.uint64(32)

    def of(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode(), np.uint8)
        parts, start = [], 0
        while start < len(data):
            # Long texts are cut after a blank.
            end = len(data)
            if end - start > STRETCH:
                later = np.flatnonzero(self.blank[data[start + STRETCH:]][:STRETCH])
                end = start + STRETCH + int(later[0]) + 1 if len(later) else end
            parts.append(self.words(data[start:end]))
            start = end
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(words):
            return words
        size = min(self.width, len(words))
        h = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            h = (h ^ words[i: i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h.sort()
        return h[np.r_[True, h[1:] != h[:-1]]]


def digest_of(grams: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(grams.tobytes())


def planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte of each, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def numbers_of(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def steps(marks: np.ndarray) -> bytes:
    return planes(np.diff(marks, prepend=np.uint32(0)))


def marks_of(data: bytes) -> np.ndarray:
    return np.cumsum(numbers_of(data, np.uint32), dtype=np.uint32)


def bucket_bits(grams: int) -> int:
    """The number of buckets, as a power of two, into which so many grams are dealt."""
    return max(0, math.ceil(math.log2(max(1, grams) / POSTINGS)))


def dealt_out(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bucket and mark of sorted grams, and where the buckets start and end."""
    bucket = (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
    marks = (grams >> np.uint64(64 - bits - MARK_BITS) & np.uint64((1 << MARK_BITS) - 1)).astype(np.uint32)
    return bucket, marks, np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist() + [len(grams)]


def run_starts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])


def sets(text: Column, width: int) -> Column:
    """The size of a text's set, a digest that equal sets share, and the start of it as a number."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = Grams(width)
        for batch in batches:
            out = []
            for value in batch:
                found = grams.of(value)
                digest = digest_of(found)
                out.append((len(found), digest, int.from_bytes(digest[:8], "little", signed=True)))
            yield pd.DataFrame(out, columns=["n", "cls", "short"])

    return F.pandas_udf(of, "n long, cls binary, short long")(text)


# -- which sets can link at all -------------------------------------------------------------------

def shared_grams(docs: DataFrame, text: str, width: int, total: int) -> DataFrame:
    """``short`` and ``shared``: how many grams of a set stand in another set too, or a few more.

    Grams meet by bucket of the hash space; the number of buckets follows the input, so that the bits
    below the bucket tell nearly all grams of one apart, and equal bits of different grams only let a set through
    that is dropped later. A map task settles the grams that several of its own sets have, and sends every gram
    once, so the share of a hot gram is a row per batch.
    """
    bits = bucket_bits(total)
    schema = "bucket long, batch long, marks binary, owners binary, shorts binary, settled binary"
    names = [field.split()[0] for field in schema.split(", ")]
    credit = "batch long, shorts binary, shared binary"

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        def flush() -> pd.DataFrame:
            owner = np.repeat(np.arange(len(own), dtype=np.uint16), [len(g) for g in own.values()])
            every = np.concatenate(list(own.values()))
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            first = run_starts(every)
            times = np.diff(np.r_[first, len(every)])
            settled = np.bincount(owner[np.repeat(times > 1, times)], minlength=len(own)).astype(np.uint32)
            every, owner = every[first], np.where(times > 1, np.uint16(MANY), owner[first])
            bucket, marks, edges = dealt_out(every, bits)
            shorts, out = np.array(list(own), np.int64), []
            for a, b in zip(edges, edges[1:]):
                several = owner[a:b] == MANY
                used, at = np.unique(np.where(several, 0, owner[a:b]), return_inverse=True)
                place = np.where(several, MANY, at).astype(np.uint16)
                out.append((int(bucket[a]), batch_no, steps(marks[a:b]), planes(place), shorts[used].tobytes(), None))
            out.append((int(bucket[0]), batch_no, None, None, shorts.tobytes(), settled.tobytes()))
            return pd.DataFrame(out, columns=names)

        grams, own, held = Grams(width), {}, 0
        batch_no = TaskContext.get().partitionId() << 32
        for batch in batches:
            for value in batch["text"]:
                found = grams.of(value)
                if not len(found):
                    continue
                short = int.from_bytes(digest_of(found)[:8], "little", signed=True)
                held += len(found) if short not in own else 0
                own[short] = found
                if held > AT_ONCE or len(own) > MANY - 2:
                    yield flush()
                    own, held, batch_no = {}, 0, batch_no + 1
        if own:
            yield flush()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        local = group[group["settled"].notna()]
        out = [local[["batch", "shorts"]].assign(shared=local["settled"])]
        sent = group[group["settled"].isna()]
        if len(sent):
            marks = np.concatenate([marks_of(m) for m in sent["marks"]])
            owners = [numbers_of(o, np.uint16) for o in sent["owners"]]
            shorts = [np.frombuffer(s, np.int64) for s in sent["shorts"]]
            starts = np.cumsum([0, *(len(s) for s in shorts)])
            many = np.concatenate(owners) == MANY
            place = np.concatenate([np.where(o == MANY, 0, o).astype(np.int32) + np.int32(s) for o, s in zip(owners, starts)])
            which = np.unique(np.concatenate(shorts), return_inverse=True)[1].astype(np.int32)
            order = np.argsort(marks, kind="stable").astype(np.uint32)
            ordered, owner = marks[order], which[place[order]]
            first = run_starts(ordered)
            several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
            several |= np.logical_or.reduceat(many[order], first)
            met = order[np.repeat(several, np.diff(np.r_[first, len(ordered)]))]
            shared = np.bincount(place[met[~many[met]]], minlength=len(which)).astype(np.uint32)
            out.append(pd.DataFrame([(n, s[shared[a:b] > 0].tobytes(), shared[a:b][shared[a:b] > 0].tobytes())
                                     for n, s, a, b in zip(sent["batch"], shorts, starts, starts[1:])], columns=["batch", "shorts", "shared"]))
        return pd.concat(out)

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        shorts, at = np.unique(np.frombuffer(b"".join(batch["shorts"]), np.int64), return_inverse=True)
        shared = np.bincount(at, np.frombuffer(b"".join(batch["shared"]), np.uint32), len(shorts))
        return pd.DataFrame({"short": shorts, "shared": shared.astype(np.int64)})

    sent = docs.select(F.col(text).alias("text")).mapInPandas(post, schema)
    met = sent.groupBy("bucket").applyInPandas(meet, credit).groupBy("batch").applyInPandas(add, "short long, shared long")
    # A batch holds a set once, so a set that several batches have is counted in full in each of them.
    return met.groupBy("short").agg(F.max("shared").alias("shared"))


def maybe_in(hash_: Column, asked: DataFrame, column: str) -> Column:
    """False only where a hash is not in the column of ``asked``.

    The filter has a fixed size, so it may be sent to every task; with very many hashes it only lets more rows through.
    """
    place = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    parts = (asked.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("at"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts:
        data = np.frombuffer(part["bits"], np.uint8)
        bits[(part["bucket"] - 1) * len(data): part["bucket"] * len(data)] = data

    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            at = batch.to_numpy() % FILTER_BITS
            yield pd.Series(bits[at >> 3] >> (at & 7) & 1 == 1)

    return F.pandas_udf(known, "boolean")(hash_)


def in_global_order(batches_: DataFrame, percent: int, total: int) -> DataFrame:
    """``id``, ``n``, ``weight``, ``grams`` and ``codes`` of the sets of which enough grams stand in another set too.

    Only those grams are kept, rare ones first: by the power of two of their number of sets, then by hash. A code
    holds that power and the first bits of the hash, and does not fall along a set. Batches of different sets send
    each gram once with its number of sets, in the buckets of ``shared_grams``, and get the powers back.
    """
    bits = bucket_bits(total)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for number, data in zip(rows["batch"], rows["grams"]):
                grams, times = np.unique(np.frombuffer(data, np.uint64), return_counts=True)
                bucket, marks, edges = dealt_out(grams, bits)
                yield pd.DataFrame([(int(bucket[a]), number, steps(marks[a:b]), planes(times[a:b].astype(np.uint32)))
                                    for a, b in zip(edges, edges[1:])], columns=["bucket", "batch", "marks", "times"])

    def rate(group: pd.DataFrame) -> pd.DataFrame:
        parts = [marks_of(m) for m in group["marks"]]
        ends = np.cumsum([len(p) for p in parts])
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        sets_with = np.bincount(at, np.concatenate([numbers_of(t, np.uint32) for t in group["times"]]))
        power = np.log2(sets_with).astype(np.uint8)[at]
        return pd.DataFrame({"bucket": group["bucket"], "batch": group["batch"],
                             "powers": [planes(p) for p in np.split(power, ends[:-1])]})

    def arrange(rows: pd.DataFrame, rated: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        ids, n, weight = (np.frombuffer(row[c], np.int64) for c in ("ids", "sizes", "weights"))
        grams = np.frombuffer(row["grams"], np.uint64)
        _, at = np.unique(grams, return_inverse=True)
        power = np.concatenate([numbers_of(p, np.uint8) for p in rated.sort_values("bucket")["powers"]])[at]
        grams, owner = grams.view(np.int64), np.repeat(np.arange(len(ids)), n)
        order = np.lexsort((grams, power, owner))
        order = order[power[order] > 0]
        grams, power, owner = grams[order], power[order].astype(np.int32), owner[order]
        codes = power * 16 + (grams >> 60).astype(np.int32) + 8
        left = np.bincount(owner, minlength=len(ids))
        cuts = np.cumsum(left)[:-1]
        enough = 100 * left >= percent * n
        keep = np.flatnonzero(enough).tolist()
        by_set, their_codes = np.split(grams, cuts), np.split(codes, cuts)
        return pd.DataFrame({"id": ids[keep], "n": n[keep], "weight": weight[keep], "grams": [by_set[i] for i in keep],
                             "codes": [their_codes[i] for i in keep]})

    marked = batches_.select("batch", "grams").mapInPandas(send, "bucket long, batch long, marks binary, times binary")
    rated = marked.groupBy("bucket").applyInPandas(rate, "bucket long, batch long, powers binary")
    return batches_.groupBy("batch").cogroup(rated.groupBy("batch")).applyInPandas(
        arrange, "id long, n long, weight long, grams array<long>, codes array<int>")


# -- overlaps ---------------------------------------------------------------------------------------

def runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows of every key, one key at a time, from batches in the order of the keys."""
    key, held = None, []
    for batch in batches:
        if not len(batch):
            continue
        codes = batch.groupby(list(keys), sort=False).ngroup().to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            part = batch.iloc[a:b]
            mine = tuple(part[k].iloc[0] for k in keys)
            if held and mine != key:
                yield key, pd.concat(held)
                held = []
            key = mine
            held.append(part)
    if held:
        yield key, pd.concat(held)


def overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many grams each of the left segments has in common with each of the right ones, or of the left without right."""
    every = left + right
    grams, owner = np.concatenate(every), np.repeat(np.arange(len(every)), [len(g) for g in every])
    which, at = np.unique(grams, return_inverse=True)
    found = np.zeros((len(left), len(right) or len(left)), np.float32)
    if right:
        of_left = owner < len(left)
        both = (np.bincount(at[of_left], minlength=len(which)) > 0) & (np.bincount(at[~of_left], minlength=len(which)) > 0)
    else:
        both = np.bincount(at, minlength=len(which)) > 1
    number = np.cumsum(both) - 1
    keep = both[at]
    at, owner = number[at[keep]], owner[keep]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for start in range(0, int(both.sum()), COLUMNS):
        a, b = np.searchsorted(at, (start, start + COLUMNS))
        has = np.zeros((len(every), COLUMNS), np.float32)
        has[owner[a:b], at[a:b] - start] = 1
        found += has[: len(left)] @ has[len(left) if right else 0:].T
    return found.astype(np.uint32)


def lowest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix of links the lowest node that it reaches."""
    low = np.arange(len(linked))
    while True:
        near = np.where(linked, low[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(low, near)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def links(ordered: DataFrame, percent: int) -> DataFrame:
    """``id``, ``linked`` and ``low``: a row per set and pair of blocks in which it has links.

    ``ordered`` holds the sets of ``in_global_order``. ``linked`` is the weight of the sets that a set is linked
    with there, ``low`` one set that it reaches there. Sets that share a gram of their prefixes
    belong to one group, large groups are split in blocks by size and hash, and every pair of blocks that
    can link is taken fragment by fragment of the global order: a task counts the overlaps of the segments of one
    fragment, the next one sums them per pair. The pairs of a group are cells of such counts and never rows.
    """
    need = F.ceil(F.col("n") * percent / 100)
    # At most 16 counts for each power of two.
    counts = ordered.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")).orderBy("code").collect()
    total, seen, cuts = sum(r["n"] for r in counts), 0, []
    for r in counts:
        seen += r["n"]
        while len(cuts) < FRAGMENTS - 1 and seen * FRAGMENTS >= total * (len(cuts) + 1):
            cuts.append(r["code"] + 1)
    bounds = [0, *cuts, *[1 << 30] * (FRAGMENTS - len(cuts))]
    prefixes = saved(ordered.select("id", F.explode(F.slice(
        "grams", F.lit(1), (F.size("grams") - need + 1).cast("int"))).alias("gram")), "prefixes")
    lists = prefixes.groupBy("gram").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low != high")
    groups = components(prefixes.join(lists, "gram").select("id", "low"), "id", "low").withColumnRenamed("node", "id")

    member = groups.join(ordered.select("id", "n", F.size("grams").alias("own")), "id")
    whole = member.groupBy("root").agg(F.count("*").alias("members"), F.sum("own").alias("own"))
    alone = (F.col("members") <= BLOCK) & (F.col("own") <= BLOCK_GRAMS)
    # Steps a little wider than the sizes of two linked sets can differ: linked sets are in the same or the next one.
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(105 / percent)).cast("int")
    placed = saved(member.select("root", "id", "n").join(whole.select("root", alone.alias("alone")), "root")
                   .withColumn("step", F.when(F.col("alone"), 0).otherwise(step)), "group-members")
    sized = placed.join(ordered.select("id", F.size("grams").alias("own")), "id").groupBy("root", "step").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("own") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = saved(placed.join(sized, ["root", "step"]).select("id", "root", "step", block.alias("block")), "group-cells")
    there = saved(cells.select("root", "step", "block").distinct(), "cells")
    a, b = there.alias("a"), there.alias("b")
    same = (F.col("a.step") == F.col("b.step")) & (F.col("a.block") <= F.col("b.block"))
    pairs = a.join(b, (F.col("a.root") == F.col("b.root")) & (same | (F.col("a.step") + 1 == F.col("b.step")))).select(
        F.col("a.root").alias("root"), *(F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("step", "block")))
    key = ["root", "step_a", "block_a", "step_b", "block_b"]
    pairs = saved(pairs, "cell-pairs")
    own_pair = (F.col("step_a") == F.col("step_b")) & (F.col("block_a") == F.col("block_b"))
    sides = (pairs.select("root", F.col("step_a").alias("step"), F.col("block_a").alias("block"), F.lit(0).alias("side"), *key[1:])
             .unionByName(pairs.filter(~own_pair).select(
                 "root", F.col("step_b").alias("step"), F.col("block_b").alias("block"), F.lit(1).alias("side"), *key[1:])))
    within = [F.transform(F.filter(F.arrays_zip("grams", "codes"), lambda x: (x["codes"] >= F.lit(low)) & (x["codes"] < F.lit(high))),
                          lambda x: x["grams"]) for low, high in zip(bounds, bounds[1:])]
    segments = ordered.join(cells, "id").select("root", "step", "block", "id", "n", "weight", F.explode(F.array(*(
        F.struct(F.lit(i).alias("fragment"), own.alias("grams")) for i, own in enumerate(within)))).alias("s"))
    work = segments.select("root", "step", "block", "id", "n", "weight", "s.*").join(sides, ["root", "step", "block"])
    dealt = (work.select(*key, "fragment", "side", "id", "n", "weight", "grams").repartition(*key, "fragment")
             .sortWithinPartitions(*key, "fragment", "side", "id"))
    of_pair = "root long, step_a int, block_a int, step_b int, block_b int, fragment int"
    facts = "id array<long>, n array<long>, weight array<long>, side array<int>"
    names = [f.split()[0] for f in f"{of_pair}, counts binary, {facts}".split(", ")]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for mine, rows in runs(batches, [*key, "fragment"]):
            side = rows["side"].to_numpy()
            own = [np.asarray(g, np.int64) for g in rows["grams"]]
            left = [g for g, s in zip(own, side) if s == 0]
            right = [g for g, s in zip(own, side) if s == 1]
            found = planes(overlap(left, right).ravel())
            # The sets of a pair of blocks are named once, with its first fragment.
            named = [rows[c].tolist() for c in ("id", "n", "weight", "side")] if mine[-1] == 0 else [None] * 4
            out.append((*mine, found, *named))
            size += len(found)
            if len(out) >= 1000 or size > 8 * BLOCK ** 2:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    def total_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in runs(batches, key):
            named = rows.iloc[0]
            sides_, ids, n, weight = (np.array(named[c], np.int64) for c in ("side", "id", "n", "weight"))
            left, right = np.flatnonzero(sides_ == 0), np.flatnonzero(sides_ == 1)
            one = not len(right)
            right = left if one else right
            both = np.zeros(len(left) * len(right), np.int64)
            for counts_ in rows["counts"]:
                both += numbers_of(counts_, np.uint32)
            both = both.reshape(len(left), len(right))
            linked = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
            if one:
                np.fill_diagonal(linked, False)
                every = linked
            else:
                every = np.zeros((len(ids), len(ids)), bool)
                every[np.ix_(left, right)] = linked
                every[np.ix_(right, left)] = linked.T
            some = every.any(axis=1)
            if some.any():
                yield pd.DataFrame({"id": ids[some], "linked": (every @ weight)[some], "low": ids[lowest(every)[some]]})

    counted = dealt.mapInPandas(count, f"{of_pair}, counts binary, {facts}")
    summed = counted.repartition(*key).sortWithinPartitions(*key, "fragment")
    return summed.mapInPandas(total_up, "id long, linked long, low long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``n_links``, a row per row of the documents.

    Two documents link when their sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more;
    A-Z are lower-cased, and words are runs without ASCII white space. ``component_id`` is the smallest key
    reachable, a null one only where there is no other; ``n_links`` counts the other rows that a row is linked with.

    Equal sets are one class with a weight. A class of which too few grams stand in any other class cannot
    link and leaves before sets are shuffled; the others meet by ``links``. Grams are known by 64-bit hashes of
    their words. A text of fewer words is one shingle; null, empty and blank texts have none and link with
    nothing. Rows that repeat link with each other. Other columns are ignored; an empty table gives no rows.
    """
    prints = saved(docs.select(F.col(key).alias("key"), row_name(key).alias("name"), F.xxhash64(text).alias("hash"),
                               sets(F.col(text), width).alias("s")).select("key", "name", "hash", "s.*"), "gram-sets")
    classes = saved(prints.filter("n > 0").groupBy("cls").agg(
        F.first("n").alias("n"), F.first("short").alias("short"), F.count("*").alias("weight"), F.min("key").alias("low_key"),
        F.min(F.struct("name", "hash")).alias("row")), "gram-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    hopeful = shared_grams(docs, text, width, total)
    # Numbers that are written stay as they are, whatever runs again.
    asked = saved(classes.join(hopeful, "short").filter(F.col("shared") * 100 >= F.col("n") * percent).select(
        F.monotonically_increasing_id().alias("id"), "cls", "n", "weight", "row.*"), "hopeful-classes")
    texts = (docs.select(row_name(key).alias("name"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
             .filter(maybe_in(F.col("hash"), asked, "hash")).join(asked.drop("cls"), ["name", "hash"]).dropDuplicates(["id"]))

    def collected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        def flush() -> pd.DataFrame:
            ids, sizes, weights = (np.array(v, np.int64).tobytes() for v in zip(*facts))
            return pd.DataFrame([(number, ids, sizes, weights, b"".join(held))], columns=["batch", "ids", "sizes", "weights", "grams"])

        grams, facts, held, size, number = Grams(width), [], [], 0, TaskContext.get().partitionId() << 32
        for rows in batches:
            for name, weight, value in zip(rows["id"], rows["weight"], rows["text"]):
                found = grams.of(value)
                facts.append((name, len(found), weight))
                held.append(found.tobytes())
                size += len(found)
                if size > AT_ONCE:
                    yield flush()
                    facts, held, size, number = [], [], 0, number + 1
        if facts:
            yield flush()

    batches_ = saved(texts.select("id", "weight", "text").mapInPandas(
        collected, "batch long, ids binary, sizes binary, weights binary, grams binary"), "hopeful-sets")
    left = asked.agg(F.sum("n")).first()[0] or 0
    sets_ = saved(in_global_order(batches_, percent, left), "ordered-sets")
    found = saved(links(sets_, percent), "gram-links")
    roots = components(found, "id", "low").withColumnRenamed("node", "id")
    linked = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    low_key = classes.select("cls", "low_key")
    known = saved(asked.select("id", "cls").join(roots, "id").join(linked, "id").join(low_key, "cls"), "gram-linked")
    lowest_key = known.groupBy("root").agg(F.min("low_key").alias("component_id"))
    linked_to = known.join(lowest_key, "root").select("cls", "component_id", "linked")
    member = saved(classes.join(linked_to, "cls", "left").select(
        "cls", F.coalesce("component_id", "low_key").alias("component_id"),
        (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "gram-members")
    return prints.join(member, "cls", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
