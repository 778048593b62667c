"""Removal of repeated runs of lines, found by winnowing over line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orestack.llm.common import saved

# Escapes that SQL literals know: blank, tab, carriage return, form feed and vertical tab.
BLANKS = r" \t\r\u000C\u000B"


def row_name(key: str) -> Column:
    """The key as a text that is never null."""
    return F.when(F.col(key).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(key).cast("string")))


def fingerprints(rows: DataFrame, lines: int, words: int) -> DataFrame:
    """A row per selected line: ``doc``, ``mark`` (its hash), ``at`` (its place) and the ``runs`` that chose it.

    Blank lines do not count, white space around a line neither. A line has two runs: the shortest that
    starts there and the shortest that ends there with ``lines`` lines or ``words`` words. Each selects the
    smallest of its line hashes, the last of equals, so equal runs select the same line, wherever they
    stand. The runs of a selected line are the steps by which a match extends from it, ahead and back: any
    longer repeated run is the union of those in it. A run is known by two hashes of all its lines.
    """
    line = f"named_struct('at', at, 'line', trim(BOTH '{BLANKS}' FROM line))"
    items = rows.select("doc", F.expr(
        f"filter(transform(split(text, '\\n', -1), (line, at) -> {line}), x -> x.line != '')").alias("lines"))
    items = items.select("doc", F.expr(
        "transform(lines, x -> named_struct('at', x.at, 'h', xxhash64(x.line), 'g', xxhash64(1, x.line), "
        "'w', size(split(x.line, '[\\\\x20\\\\x09-\\\\x0D]+'))))").alias("lines"))

    ahead = (f"aggregate(slice(lines, i + 1, {lines}), named_struct('n', 0, 'w', 0), "
             f"(a, x) -> if(a.w >= {words}, a, named_struct('n', a.n + 1, 'w', a.w + x.w)), "
             f"a -> if(a.w >= {words} OR a.n = {lines}, a.n, 0))")
    counted = items.select("doc", "lines", F.expr(f"transform(lines, (x, i) -> {ahead})").alias("n"))
    # The sizes of the runs from line i. One that is longer than the shortest, k, is the shortest to its end as
    # long as it does not hold the whole run of the next line.
    sizes = (f"if(k = 0, cast(array() AS array<int>), if(k = {lines}, array(k), sequence(k, greatest(k, least({lines}, "
             f"size(n) - i, coalesce(nullif(get(n, i + 1), 0), {lines}))))))")
    runs = counted.select("doc", F.expr(
        f"transform(n, (k, i) -> transform(transform({sizes}, m -> slice(lines, i + 1, m)), "
        "own -> named_struct('i', i, 'places', own.at, 'h', own.h, 'g', own.g)))").alias("runs"))
    chosen = runs.select("doc", F.expr(
        "transform(runs, own -> transform(own, r -> named_struct('places', r.places, 'run', xxhash64(r.h), "
        "'check', xxhash64(r.g), 'mark', array_min(r.h), "
        "'at', r.i + size(r.h) - array_position(reverse(r.h), array_min(r.h)))))").alias("runs"))
    anchors = chosen.select("doc", F.explode(F.expr(
        "transform(runs, (x, p) -> named_struct('at', p, 'runs', "
        f"filter(flatten(slice(runs, greatest(1, p - {lines - 2}), least({lines}, p + 1))), r -> r.at = p)))")).alias("a"))
    return anchors.filter(F.size("a.runs") > 0).select(
        "doc", F.col("a.at").alias("at"), F.col("a.runs")[0]["mark"].alias("mark"),
        F.transform("a.runs", lambda r: F.struct(r["places"].alias("places"), r["run"].alias("run"),
                                                 r["check"].alias("check"))).alias("runs"))


def repeated(rows: DataFrame, lines: int = 3, words: int = 50) -> DataFrame:
    """``doc`` and ``gone``: the places of the lines of ``rows(doc, text)`` that later repeated runs cover.

    Fingerprints meet by a count per hash and a join of positions, never in pairs: a run is repeated when
    the same run has an earlier place, so each run is only compared with the first of its kind.
    """
    marks = saved(fingerprints(rows, lines, words), "line-marks")
    place = F.struct("doc", "at")
    # Written, so that a hot mark or run meets a plain shuffle, which adaptive execution can split.
    shared = saved(marks.groupBy("mark").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .filter("first != last").select("mark"), "line-shared")
    runs = saved(marks.join(shared, "mark", "left_semi").select("doc", F.explode("runs").alias("r"))
                 .select("doc", "r.places", "r.run", "r.check"), "line-runs")
    place = F.struct("doc", F.col("places")[0])
    first = saved(runs.groupBy("run", "check").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                  .filter("first != last").select("run", "check", "first"), "line-firsts")
    later = runs.join(first, ["run", "check"]).filter(place != F.col("first"))
    # A set, so that the copies of a row, which are one document, do not gather theirs.
    return later.select("doc", F.explode("places").alias("place")).groupBy("doc").agg(F.collect_set("place").alias("gone"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = 3, words: int = 50,
          counts: tuple[str, str] = ("lines_in", "lines_removed")) -> DataFrame:
    """The documents with their repeated runs of lines deleted, and two ``counts``: lines in, lines removed.

    Columns of the documents that have the names of the counts give way to them; all others stay as they are.

    A run of ``lines`` or more lines, or of ``words`` or more words, that stands earlier in this or another
    document is deleted where it comes again. Earlier means a smaller key (null last), then the hash of
    the text, then the place. Blank lines stay. Rows that repeat key and text count as one document and
    get the same result. A null text stays null, an empty one empty; a document may lose all its lines.
    """
    doc = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), row_name(key).alias("name"),
                   F.xxhash64(text).alias("hash"))
    rows = docs.select(doc.alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    gone = repeated(rows, lines, words).select(F.col("doc.name").alias("_name"), F.col("doc.hash").alias("_hash"), "gone")
    # The row travels as one value, so no column of it can clash.
    named = docs.select(F.struct("*").alias("row"), row_name(key).alias("_name"), F.xxhash64(text).alias("_hash"),
                        F.split(text, "\n", -1).alias("lines"))
    joined = named.join(gone, ["_name", "_hash"], "left")
    keep = F.expr("transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i])")

    def column(name: str) -> Column:
        own = F.col("row")[name]
        return (F.when(F.col("gone").isNull(), own).otherwise(F.array_join(keep, "\n")) if name == text else own).alias(name)

    return joined.select(
        *(column(c) for c in docs.columns if c not in counts),
        F.coalesce(F.size("lines"), F.lit(0)).alias(counts[0]),
        F.coalesce(F.size("gone"), F.lit(0)).alias(counts[1]))
