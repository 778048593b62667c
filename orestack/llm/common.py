"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orestack.sources import workspace

# A word is a run of anything but these six white space bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read again.

    Cuts the lineage: rows that a lost executor held are read from the folder, not computed anew.
    """
    path = workspace.new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null or blank text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1)), F.array().cast("array<string>"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is in the evaluation fold; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def hash_fraction(key: Column, fraction: float) -> Column:
    """True for about this share of the keys, and always for the same ones."""
    steps = 1 << 20
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps)) < F.lit(int(min(1.0, fraction) * steps))


def slices(texts: Sequence[str], budget: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``budget`` characters each, at least one text in every range."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > budget:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)
