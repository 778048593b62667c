"""Fill-in-the-middle: documents cut in three and put together in another order, piece by piece."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of a hundred documents so many are transformed, and of a hundred of those so many start with the suffix.
TRANSFORMED, SUFFIX_FIRST = 90, 20

PIECE = 4096  # code points of a piece, at most
SLICE = 1 << 20  # code points that are looked at together
HEAD, TEXT = -1, 0  # ``part`` of the row that describes a document, and of a text that is not cut
PARTS = {PREFIX: 1, MIDDLE: 2, SUFFIX: 3}  # in the order of the text
_FACTS = "n long, form string, prefix_chars long, middle_chars long"
_NONE = (None, None, None, None)


def unit_starts(text: str) -> Iterator[np.ndarray]:
    """Where the units of a text start, slice by slice: runs of ASCII letters, and every other code point alone."""
    inside = False
    for start in range(0, len(text), SLICE):
        codes = np.frombuffer(text[start: start + SLICE].encode("utf-32-le"), "<u4")
        letter = (codes | 32) - np.uint32(97) < 26
        begins = ~letter | ~np.r_[inside, letter[:-1]]
        inside = bool(letter[-1])
        yield np.flatnonzero(begins) + start


def count_units(text: str) -> int:
    return sum(len(s) for s in unit_starts(text))


def place_of(text: str, units: int) -> int:
    """The code point at which so many units end."""
    for starts in unit_starts(text):
        if units < len(starts):
            return int(starts[units])
        units -= len(starts)
    return len(text)


def plan(name: str, text: str) -> tuple[int, str, int, int]:
    """Units, form and the two cuts of a document; a hash of its name decides them."""
    digest = hashlib.sha256(f"1:{name}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = count_units(text)
    if not text or h[2] % 100 >= TRANSFORMED or any(mark in text for mark in PARTS):
        return n, "plain", 0, 0
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return n, "spm" if h[3] % 100 < SUFFIX_FIRST else "psm", place_of(text, low), place_of(text, high)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``place``, ``part`` and ``data``: every document's output in pieces of at most ``PIECE`` code points.

    ``row`` is the document (its task, and its place in the task), ``place`` the order of the output. The
    first piece of a row has no data but its ``key`` (as text), ``n``, ``form``, ``prefix_chars`` and
    ``middle_chars``. A task that runs again gives its documents the same rows if it reads them in the same
    order, as it does from stored files; write any other frame first.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, out, size = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            for name, value in zip(batch["key"], batch["text"]):
                value = value or ""
                n, form, low, high = plan("" if name is None else name, value)
                spans = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, len(value))}
                if form == "plain":
                    order, facts = [], (n, form, None, None)
                    blocks = [(0, len(value))]
                else:
                    order = [PREFIX, SUFFIX, MIDDLE] if form == "psm" else [SUFFIX, PREFIX, MIDDLE]
                    facts, blocks = (n, form, low, high - low), [spans[mark] for mark in order]
                place = 1
                out.append((base, 0, b"", name, *facts))
                for i, (start, end) in enumerate(blocks):
                    if order:
                        out.append((base, place, order[i].encode(), None, *_NONE))
                        place += 1
                    for at in range(start, end, PIECE):
                        data = value[at: min(end, at + PIECE)].encode()
                        out.append((base, place, data, None, *_NONE))
                        place, size = place + 1, size + len(data)
                        if size > 8 * SLICE:
                            yield pd.DataFrame(out, columns=names)
                            out, size = [], 0
                base += 1
            if out:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0

    schema = f"row long, place long, data binary, key string, {_FACTS}"
    names = [field.split()[0] for field in schema.split(", ")]
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, schema)


def in_order(cut: DataFrame) -> DataFrame:
    """The pieces, those of a document together and in the order of its output."""
    return cut.repartition("row").sortWithinPartitions("row", "place")


def parsed(ordered: DataFrame) -> DataFrame:
    """The output read once as a stream of pieces: its digest, and every piece with the part that it belongs to.

    Only the output and its form tell the parts. A mark stands alone in a piece, and no text of a
    transformed document holds one, so the first piece equal to a mark is that mark.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = {mark.encode(): part for mark, part in PARTS.items()}
        head, part, digest = None, TEXT, None
        for batch in batches:
            out = []
            for record in zip(*(batch[c] for c in names[:-2])):
                row, place, data = record[:3]
                if place == 0:
                    if head is not None:
                        out.append((*head, HEAD, digest.hexdigest()))
                    head, part, digest = record, TEXT, hashlib.sha256()
                    continue
                digest.update(data)
                found = marks.get(data) if head[5] != "plain" else None
                if found is None:
                    out.append((row, place, data, None, *_NONE, part, None))
                else:
                    part = found
            yield pd.DataFrame(out, columns=names)
        if head is not None:
            yield pd.DataFrame([(*head, HEAD, digest.hexdigest())], columns=names)

    schema = f"row long, place long, data binary, key string, {_FACTS}, part int, output_sha256 string"
    names = [field.split()[0] for field in schema.split(", ")]
    return ordered.mapInPandas(nullable(read), schema)


def nullable(function):
    """The function on batches whose columns keep whole numbers beside nulls."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def plain(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({c: batch[c].astype(object).where(batch[c].notna(), None) for c in batch.columns})

        return function(map(plain, batches))
    return run


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256`` and ``restored_sha256``, a row per row.

    Pieces are shuffled once, sorted by document and place of the output, and streamed into its digest. The parts
    read from that stream are then sorted in the same partition by their order in the text, and streamed into
    the digest of the restored text. A task holds one batch of pieces however long a document is.

    A null text counts as empty and stays plain; a null key counts as the empty name. Repeated rows come back
    as often as they went in, and rows that repeat a key are cut at places of their own text. Other columns are
    ignored; an empty table gives no rows.
    """

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, digest = None, None
        for batch in batches:
            out = []
            for record in zip(*(batch[c] for c in ("part", "data", *names[:-1]))):
                if record[0] == HEAD:
                    if head is not None:
                        out.append((*head, digest.hexdigest()))
                    head, digest = record[2:], hashlib.sha256()
                else:
                    digest.update(record[1])
            yield pd.DataFrame(out, columns=names)
        if head is not None:
            yield pd.DataFrame([(*head, digest.hexdigest())], columns=names)

    schema = f"key string, {_FACTS}, output_sha256 string, restored_sha256 string"
    names = [field.split()[0] for field in schema.split(", ")]
    resorted = parsed(in_order(pieces(docs, key, text))).sortWithinPartitions("row", "part", "place")
    found = resorted.mapInPandas(nullable(restore), schema)
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *names[1:])


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, the transformed text, a row per row."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, parts = None, []
        for batch in batches:
            out = []
            for record in zip(*(batch[c] for c in ("place", "data", *names[:-1]))):
                if record[0] == 0:
                    if head is not None:
                        out.append((*head, b"".join(parts).decode()))
                    head, parts = record[2:], []
                else:
                    parts.append(record[1])
            yield pd.DataFrame(out, columns=names)
        if head is not None:
            yield pd.DataFrame([(*head, b"".join(parts).decode())], columns=names)

    schema = f"key string, {_FACTS}, output string"
    names = [field.split()[0] for field in schema.split(", ")]
    found = in_order(pieces(docs, key, text)).mapInPandas(nullable(join), schema)
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *names[1:])


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    def between(start: str, end: str | None) -> Column:
        rest = F.substr(output, F.locate(start, output) + F.lit(len(start)))
        return rest if end is None else F.substr(rest, F.lit(1), F.locate(end, rest) - F.lit(1))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
