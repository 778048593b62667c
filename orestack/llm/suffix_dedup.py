"""Removal of long byte strings that stand at more than one place, by ranks of growing strings at sampled positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import saved, slices
from orestack.llm.line_dedup import row_name

SAMPLE = 128  # bytes of the first rank; a repeated string of the threshold has a sampled position with it
SEGMENT = 1 << 20  # string starts that a task looks at together
LOW = np.uint64(0xFFFFFFFF)
TOGETHER = 20_000  # different surroundings of one mark that a task compares; more are compared row by row
ANCHOR = "name string, hash long, mark long, low long, starts int, before int, whole long"
CONTEXT = "mark long, name string, hash long, low long, known boolean, hot boolean, data binary"


class Hashes:
    """Two 64-bit ranks of any substring from prefix sums: equal strings of a length have equal ranks."""

    def __init__(self, size: int):
        random = np.random.default_rng(20)
        self.letters = random.integers(0, 1 << 64, (2, 256), np.uint64)
        bases = random.integers(0, 1 << 62, 2, np.uint64) * np.uint64(4) + np.uint64(5)
        self.powers, self.inverse = (np.ones((2, size + 1), np.uint64) for _ in range(2))
        for i, base in enumerate(bases):
            self.powers[i, 1:] = base
            self.inverse[i, 1:] = np.uint64(pow(int(base), -1, 1 << 64))
        self.powers, self.inverse = np.cumprod(self.powers, axis=1), np.cumprod(self.inverse, axis=1)

    def of(self, data: np.ndarray) -> None:
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.letters[i][data] * self.powers[i, : len(data)])])
                     for i in range(2)]

    def rank(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        value = (sums[end] - sums[start]) * self.inverse[which][start]
        value = (value ^ value >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        return value ^ value >> np.uint64(29)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window, from minima up to and from the ends of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def segments(data: bytes, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each stretch of string starts begins, and the bytes that its strings cover."""
    whole = np.frombuffer(data, np.uint8)
    for start in range(0, len(whole) - least + 1, SEGMENT):
        yield start, whole[start: start + SEGMENT + least - 1]


def samples(hashes: Hashes, data: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """For each sampled position its rank, the string starts that chose it, and a rank of all their bytes.

    Every string of ``least`` bytes chooses the position in it whose first ``SAMPLE`` bytes rank lowest,
    the last of equals, so equal strings choose alike. Starts that choose one position are neighbours.
    """
    hashes.of(data)
    at = np.arange(len(data) - SAMPLE + 1)
    rank = hashes.rank(0, at, at + SAMPLE)
    key = (rank & ~LOW) | (LOW - at.astype(np.uint64))
    chosen = (LOW - (sliding_min(key, least - SAMPLE + 1) & LOW)).astype(np.int64)
    low = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    high = np.r_[low[1:], len(chosen)] - 1
    at = chosen[low]
    return rank[at], low, high - low + 1, at - low, hashes.rank(1, low, high + least)


def spans(data: bytes, low: np.ndarray, high: np.ndarray, least: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes kept, when strings start at low to high."""
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, np.minimum(high + least, len(data)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int((gone[1:] & ~gone[:-1]).sum() + (gone[:1].sum() if len(gone) else 0))
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def packed(text: Column) -> Column:
    """The text as Zstandard bytes: documents are shuffled twice, so they travel small."""

    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for batch in batches:
            yield batch.map(lambda t: compressor.compress(b"" if t is None else t.encode()))

    return F.pandas_udf(pack, "binary")(text)


def all_starts(hashes: Hashes, contexts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two ranks of every string of ``least`` bytes in the contexts, and how many each context has."""
    counts = np.array([len(c) - least + 1 for c in contexts], np.int64)
    ranks: tuple[list, list] = ([], [])
    for a, b in slices(contexts, SEGMENT // 2):
        for start, data in segments(contexts[a], least) if b == a + 1 else [(0, np.frombuffer(b"".join(contexts[a:b]), np.uint8))]:
            hashes.of(data)
            at = np.arange(len(data) - least + 1)
            if b > a + 1:
                sizes = counts[a:b] + least - 1
                at = np.concatenate([s + np.arange(n) for s, n in zip(np.cumsum(sizes) - sizes, counts[a:b])])
            for which in (0, 1):
                ranks[which].append(hashes.rank(which, at, at + least))
    return np.concatenate(ranks[0]), np.concatenate(ranks[1]), counts


def meet(group: pd.DataFrame, hashes: Hashes, least: int) -> pd.DataFrame:
    """Ranges of string starts that stand at more than one place among the contexts of some marks."""
    rank, check, counts = all_starts(hashes, list(group["data"]), least)
    owner = np.repeat(np.arange(len(group)), counts)
    place = group["low"].to_numpy()[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    known = group["known"].to_numpy(bool)[owner]
    order = np.lexsort((check, rank))
    new = np.r_[True, (rank[order][1:] != rank[order][:-1]) | (check[order][1:] != check[order][:-1])]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    twice = np.bincount(kind, 1 + known)[kind] > 1
    at = np.flatnonzero(twice & ~known)
    first = np.r_[True, (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])] if len(at) else np.zeros(0, bool)
    starts, ends = at[first], at[np.r_[first[1:], True]] if len(at) else at
    return pd.DataFrame({"name": group["name"].to_numpy()[owner[starts]], "hash": group["hash"].to_numpy()[owner[starts]],
                         "low": place[starts], "high": place[ends]})


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 400) -> DataFrame:
    """``name``, ``hash`` and ``at``, arrays of first and last starts of strings that start elsewhere too.

    Ranks grow in three rounds, and what has become unique leaves. First the 128 bytes at sampled
    positions; then, where those stand twice, all the bytes of the starts that chose the position: equal
    ones are past the threshold, and so are all strings in them. Only where the second round parts
    positions that the first round held together, single starts are ranked by their whole string, one
    position standing for all that are equal. These meet by the mark of their position in one task, or,
    when a mark has very many different surroundings, row by row. No pairs are made.
    """
    rows = docs.select(row_name(key).alias("name"), F.xxhash64(text).alias("hash"), F.coalesce(text, F.lit("")).alias("text"))

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes(SEGMENT + least)
        for batch in batches:
            parts, size = [], 0
            for name, digest, value in zip(batch["name"], batch["hash"], batch["text"]):
                for start, data in segments(value.encode(), least):
                    mark, low, starts, before, whole = samples(hashes, data, least)
                    parts.append(pd.DataFrame({"name": name, "hash": digest, "mark": mark.view(np.int64), "low": low + start,
                                               "starts": starts, "before": before, "whole": whole.view(np.int64)}))
                    size += len(low)
                if size > 50_000:
                    yield pd.concat(parts)
                    parts, size = [], 0
            if parts:
                yield pd.concat(parts)

    long = rows.filter(F.octet_length("text") >= least)
    samples_ = saved(long.mapInPandas(sample, ANCHOR), "suffix-samples")
    shared = saved(samples_.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark"), "suffix-shared")
    anchors = saved(samples_.join(shared, "mark", "left_semi").select(*samples_.columns), "suffix-anchors")
    same = ["mark", "before", "starts", "whole"]
    wholes = saved(anchors.groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct("name", "hash", "low")).alias("one"))
                   .select(*same, "n", "one.*"), "suffix-wholes")
    parted = saved(wholes.groupBy("mark").agg(F.count("*").alias("members"), F.min("n").alias("least"))
                   .filter("members > 1 AND least = 1").select("mark", (F.col("members") > TOGETHER).alias("hot")), "suffix-parted")
    single = wholes.join(parted, "mark").select(
        "name", "hash", F.struct("mark", "low", "starts", (F.col("n") > 1).alias("known"), "hot").alias("range"))
    asked = saved(single.groupBy("name", "hash").agg(F.collect_list("range").alias("ranges")), "suffix-asked")
    settled = (anchors.join(wholes.filter("n > 1").select(*same), same, "left_semi")
               .select("name", "hash", "low", (F.col("low") + F.col("starts") - 1).alias("high")))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        names = [field.split()[0] for field in CONTEXT.split(", ")]
        for batch in batches:
            out = []
            for name, digest, raw, ranges in zip(batch["name"], batch["hash"], batch["data"], batch["ranges"]):
                data = unpack.decompress(raw)
                out += [(r["mark"], name, digest, r["low"], r["known"], r["hot"], data[r["low"]: r["low"] + r["starts"] + least - 1])
                        for r in ranges]
                if len(out) > 5_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    small = long.select("name", "hash", packed(F.col("text")).alias("data"))
    contexts = saved(small.join(asked, ["name", "hash"]).mapInPandas(cut_out, CONTEXT), "suffix-contexts")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, left = Hashes(SEGMENT + least), None
        for batch in batches:
            left = batch if left is None else pd.concat([left, batch])
            last = left["mark"] == left["mark"].iloc[-1]
            if not last.all():
                whole, left = left[~last], left[last]
                edges = np.flatnonzero(np.diff(whole["mark"].to_numpy())) + 1
                cuts = [0, *edges[np.flatnonzero(np.diff(edges // 2_000)) + 1], len(whole)] if len(edges) else [0, len(whole)]
                yield from (meet(whole.iloc[a:b], hashes, least) for a, b in zip(cuts, cuts[1:]) if b > a)
        if left is not None:
            yield meet(left, hashes, least)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes(SEGMENT + least)
        for batch in batches:
            for a, b in slices(list(batch["data"]), SEGMENT):
                part = batch.iloc[a:b]
                rank, check, counts = all_starts(hashes, list(part["data"]), least)
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                frame = part[["name", "hash", "low", "known"]].loc[part.index.repeat(counts)]
                yield frame.assign(low=frame["low"].to_numpy() + inside, rank=rank.view(np.int64), check=check.view(np.int64))

    span = "name string, hash long, low long, high long"
    few = (contexts.filter("NOT hot").repartition("mark").sortWithinPartitions("mark").mapInPandas(compare, span))
    starts = saved(contexts.filter("hot").mapInPandas(
        spread, "name string, hash long, low long, known boolean, rank long, check long"), "suffix-starts")
    twice = saved(starts.groupBy("rank", "check").agg(F.sum(F.when(F.col("known"), 2).otherwise(1)).alias("n"))
                  .filter("n > 1").select("rank", "check"), "suffix-twice")
    many = (starts.filter("NOT known").join(twice, ["rank", "check"], "left_semi")
            .select("name", "hash", "low", F.col("low").alias("high")))
    # Copies of a row find the same ranges, each of which counts once.
    return (settled.unionByName(few).unionByName(many).distinct().groupBy("name", "hash")
            .agg(F.collect_list(F.struct("low", "high")).alias("at")))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 400, with_kept: bool = True) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (the bytes), a row per row.

    ``kept`` is null without ``with_kept``.

    Every byte goes that a string of ``least`` bytes covers which also starts anywhere else, in the same
    document or another; the strings are those of the input, copies of a row included, and overlaps
    count. Null counts as empty, shorter texts stay whole, very long ones are looked at in stretches.
    """
    at = repeats(docs, key, text, least).withColumnsRenamed({"name": "_name", "hash": "_hash", "at": "_at"})
    named = docs.select(F.col(key).alias("_key"), packed(F.col(text)).alias("_data"), row_name(key).alias("_name"),
                        F.xxhash64(text).alias("_hash"))

    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        import zstandard

        unpack, out = zstandard.ZstdDecompressor(), []
        for raw, ranges in zip(texts, found):
            data = unpack.decompress(raw)
            ranges = [] if ranges is None else ranges
            low, high = (np.array([r[end] for r in ranges], np.int64) for end in ("low", "high"))
            removed, runs, kept = spans(data, low, high, least)
            out.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    cut_udf = F.pandas_udf(cut, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return (named.join(at, ["_name", "_hash"], "left").select(F.col("_key").alias(key), cut_udf(F.col("_data"), F.col("_at")).alias("_cut"))
            .select(F.col(f"`{key}`"), "_cut.*"))
