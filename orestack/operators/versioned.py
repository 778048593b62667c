"""Keyed upserts, as-of reads, history and restore over plain parquet.

A versioned table is a folder with two parts. ``rows/_version=N`` holds the rows written by version
N: the whole table for an overwrite, the new rows for an append, the changed rows for a merge.
``commits`` holds one row per committed version and is written last, so a failed attempt stays
invisible and its retry replaces it. One writer at a time is assumed; a second one fails, since a
committed version is never written again.

Every commit names the chain of versions whose rows make up its contents, so a read needs one commit and
lists only the folders of its chain. A merge costs no more than the touched keys need, and a restore
writes no rows at all. An overwrite starts a new chain, and so does every merge that
finds ``MOST_CHANGES`` merges in its chain or is asked to: it writes the untouched rows as well.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F, types as T

from orestack import schemas, settings
from orestack.operators.dedup import latest_per_key
from orestack.sources.workspace import new_folder

INSERTED, UPDATED, KEPT, DELETED = "I", "U", "K", "D"
MOST_CHANGES = 8  # versions that a read lays over its base
# A source of up to this size is written and read twice by a merge, so that its keys, which Spark may broadcast, can
# cut the table first. The keys of a larger one would not be broadcast: it is read once, and joined with the table.
STAGED_BYTES = 8 * 1024 ** 2
_TECHNICAL = ("_version", "_op")


class VersionNotFound(LookupError):
    """No committed version answers the request."""


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows; the job that reads them fails on a NULL key and on a key with several rows.

    The rows are counted over the key, for which a frame that is unique by a window has its shuffle already.
    """
    unknown = F.lit(False)
    for name in key:
        unknown = unknown | F.col(name).isNull()
    copies = F.count(F.lit(1)).over(Window.partitionBy(*key))
    problem = F.when(unknown, "a row without a key").when(F.col("_copies") > 1, "several rows of one key")
    fine = F.when(problem.isNotNull(), F.raise_error(F.concat(F.lit("cannot merge: "), problem)).cast("boolean")).otherwise(True)
    return df.withColumn("_copies", copies).filter(fine).drop("_copies")


def merge_changes(source: DataFrame, current: DataFrame, key: Sequence[str],
                  update_columns: Sequence[str] | None = None, deleted: str | None = None,
                  cut: bool = True, whole: bool = False, covering: bool = False,
                  newer: Callable[[str], Column] | None = None) -> DataFrame:
    """Rows an upsert writes: every source row, marked ``I`` or ``U`` in ``_op``.

    A matched row takes ``update_columns`` (default: all) from the source and keeps the other
    columns of the current row; an unmatched row is inserted whole. ``source`` must hold one row
    per key and no NULL key. A source row whose flag ``deleted`` is true removes its key: it is marked ``D``, and
    left out where the key is not known. The flag itself is not written.

    The current rows are first cut down to the keys of the source. Spark broadcasts those keys when
    they are small enough, which leaves a large table unshuffled; otherwise the semi join and the
    left join share one shuffle on the key. Without ``cut`` the source is read once, and each side shuffled once.

    With ``whole`` (and without ``cut``) a full join adds the current rows that the source does not name, marked ``K``.
    With ``covering`` too, no more of the current rows is read than of matched ones: those marked ``K`` tell only that
    there are such rows.

    With ``newer`` (and without ``covering``) a matched row is left alone when it ranks above that of the source: ``newer``
    gives the rank of a row from its columns, whose names have the given prefix.
    """
    if covering and newer is not None:
        raise ValueError("what matched rows rank by is not read when the source covers them")
    key = list(key)
    known = [name for name in current.columns if name not in _TECHNICAL]
    own = [name for name in source.columns if name != deleted]
    updated = set(own if update_columns is None else update_columns) | set(key)
    kept = [name for name in known if name not in updated]
    held = [name for name in known if name not in key] if whole and not covering or newer is not None else kept
    matching = current.join(source.select(*key), key, "left_semi") if cut else current
    targets = matching.select(
        *key, *(F.col(name).alias(f"_kept_{name}") for name in held), F.lit(True).alias("_matched"))

    def merged(name: str) -> Column:
        if name not in own:
            return F.col(f"_kept_{name}").alias(name)
        if name in updated and whole and name in held:
            return F.when(F.col("_arrived"), F.col(name)).otherwise(F.col(f"_kept_{name}")).alias(name)
        if name in updated:
            return F.col(name)
        before = F.col(f"_kept_{name}") if name in kept else F.lit(None)
        return F.when(F.col("_matched"), before).otherwise(F.col(name)).alias(name)

    added = [name for name in own if name not in known]
    rows = source.withColumn("_arrived", F.lit(True)).join(targets, key, "full" if whole else "left")
    if newer is not None:
        fresh = F.col("_matched").isNull() | (newer("") >= newer("_kept_"))
        rows = rows.withColumn("_arrived", F.when(F.col("_arrived") & fresh, True)) if whole else rows.filter(fresh)
    operation = F.when(F.col("_arrived").isNull(), KEPT).when(F.col("_matched"), UPDATED).otherwise(INSERTED)
    if deleted is not None:
        gone = F.coalesce(F.col("_arrived") & F.col(deleted), F.lit(False))
        rows = rows.filter(~gone | F.col("_matched").isNotNull())
        operation = F.when(gone, DELETED).otherwise(operation)
    return rows.select(*(merged(name) for name in [*known, *added]), operation.alias("_op"))


def overlay(base: DataFrame, latest: DataFrame, key: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """The base rows with changed rows replaced and new rows added.

    ``latest`` holds one row per changed key. ``touched`` may give the same keys in a cheaper way,
    repeats included. The anti join leaves the base unshuffled when they are small enough to broadcast.
    """
    keys = (latest if touched is None else touched).select(*key)
    return base.join(keys, list(key), "left_anti").unionByName(latest, allowMissingColumns=True)


def added_rows(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``after`` whose key is not in ``before``."""
    return after.join(before.select(*key), list(key), "left_anti")


def changed_values(before: DataFrame, after: DataFrame, key: Sequence[str], column: str,
                   null_safe: bool = False) -> DataFrame:
    """Keys in both frames whose ``column`` differs, with both values.

    As with ``!=``, a change from or to NULL counts only when ``null_safe``.
    """
    old, new = f"{column}_before", f"{column}_after"
    pairs = before.select(*key, F.col(column).alias(old)).join(
        after.select(*key, F.col(column).alias(new)), list(key))
    differs = ~F.col(old).eqNullSafe(F.col(new)) if null_safe else F.col(old) != F.col(new)
    return pairs.filter(differs)


def _nullable(fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(field.name, field.dataType) for field in fields])


def _fit(df: DataFrame, known: T.StructType) -> DataFrame:
    """The frame with the columns of a table first; fails when a column has another type there."""
    added = [field for field in df.schema.fields if field.name not in known.names]
    return df.to(_nullable([*known.fields, *added]))


class VersionedTable:
    """A versioned table in a folder. Without a ``key`` it takes appends and overwrites only.

    ``hidden`` columns are stored with the rows, and read only by ``current(hidden=True)``. ``stored`` may write them, in a
    merge, in a shorter form; it leaves rows alone that have it. ``carried`` is a pair: how a large merge makes rows shorter
    before it shuffles them, under the same names, and how it makes them whole again.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = (), hidden: Sequence[str] = (),
                 stored: Callable[[DataFrame], DataFrame] | None = None,
                 carried: tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = list(key)
        self.hidden = list(hidden)
        self.stored = stored or (lambda rows: rows)
        self.short, self.whole = carried or (lambda rows: rows, lambda rows: rows)

    # -- metadata ---------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """The committed versions; empty when the table does not exist yet."""
        reader = self.spark.read.schema(schemas.COMMITS)
        try:
            return reader.parquet(f"{self.path}/commits").select(*schemas.COMMITS.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schemas.COMMITS)

    def history(self, limit: int | None = None) -> DataFrame:
        """Version, time, operation and row counts, newest first."""
        newest_first = self.commits().select(
            F.col("_version").alias("version"), "committed_at", "operation",
            "rows_inserted", "rows_updated",
        ).orderBy(F.col("version").desc())
        return newest_first if limit is None else newest_first.limit(limit)

    def version_count(self) -> DataFrame:
        """One row: number of versions and the latest one."""
        return self.commits().agg(
            F.count(F.lit(1)).alias("version_count"), F.max("_version").alias("latest_version"))

    def latest_version(self) -> int | None:
        """The latest committed version, or None when there is none."""
        newest = self._newest()
        return None if newest is None else newest["_version"]

    def version_at(self, timestamp: str) -> int:
        """The latest version committed at or before a timestamp."""
        found = self.commits().filter(
            F.col("committed_at") <= F.lit(timestamp).cast("timestamp")).agg(F.max("_version")).first()[0]
        if found is None:
            raise VersionNotFound(f"no version of {self.path} was committed by {timestamp}")
        return found

    def _newest(self) -> Row | None:
        return self.commits().orderBy(F.col("_version").desc()).first()

    def _commit_of(self, version: int) -> Row:
        found = self.commits().filter(F.col("_version") == version).first()
        if found is None:
            raise VersionNotFound(f"{self.path} has no version {version}")
        return found

    # -- reads ------------------------------------------------------------------------------

    def current(self, hidden: bool = False, by_key: bool = False) -> DataFrame:
        """The latest contents; ``by_key`` brings the rows of a keyed table together by key, in one shuffle."""
        newest = self._newest()
        if newest is None:
            raise VersionNotFound(f"{self.path} has no committed version")
        return self._contents(newest, hidden, by_key)

    def as_of_version(self, version: int) -> DataFrame:
        """The contents as of a version."""
        return self._contents(self._commit_of(version))

    def as_of_timestamp(self, timestamp: str) -> DataFrame:
        """The contents as of the latest version committed at or before a timestamp."""
        return self.as_of_version(self.version_at(timestamp))

    def changes(self, version: int) -> DataFrame:
        """The rows that one version inserted, updated or deleted, marked in ``_op``."""
        schema = self._schema(self._commit_of(version))
        return self._rows([version], schema).drop("_version", *self.hidden).filter(F.col("_op") != KEPT)

    def appended_since(self, version: int) -> DataFrame | None:
        """The rows that were appended after a version; None when there are none."""
        newest = self._newest()
        later = [step for step in newest["chain"] if step > version] if newest else []
        return self._rows(later, self._schema(newest)).drop("_version", "_op") if later else None

    def source_version(self) -> int | None:
        """What the latest version says about its source; a restored version says what it said before."""
        newest = self._newest()
        return None if newest is None else newest["source_version"]

    def differing(self, before: int, after: int) -> tuple[DataFrame, DataFrame]:
        """The rows of two versions that can differ, as a pair to compare.

        When one version builds on the other, only the keys that were changed in between can differ, and only
        the rows of those keys are returned; otherwise all rows are.
        """
        first, last = self._commit_of(before), self._commit_of(after)
        schema, older = self._schema(last), self._contents(first)
        start, lineage = self._lineage(first), self._lineage(last)
        later = lineage[len(start):]
        if not self.key or lineage[:len(start)] != start or not later:
            return older, self._contents(last)
        touched = self._rows(later, schema).filter(F.col("_op") != KEPT)
        return (
            older.join(touched.select(*self.key), self.key, "left_semi"),
            self._latest(touched, later).filter(F.col("_op") != DELETED).select(*older.columns),
        )

    def stored_bytes(self) -> int:
        """The bytes of the files that hold the latest contents; 0 when there are none."""
        newest = self._newest()
        return 0 if newest is None else settings.scan_bytes(self._rows(newest["chain"], self._schema(newest)))

    def _latest(self, touched: DataFrame, versions: Sequence[int]) -> DataFrame:
        # The rows of a single version are unique already.
        return touched if len(versions) == 1 else latest_per_key(touched, self.key, "_version")

    def _contents(self, commit: Row, hidden: bool = False, by_key: bool = False) -> DataFrame:
        schema = self._schema(commit)
        base, *later = commit["chain"]
        if not later:
            rows = self._rows([base], schema)
        elif self.key and by_key:
            # An overlay is a union, which a join by key shuffles a second time.
            rows = latest_per_key(self._rows([base, *later], schema), self.key, "_version")
        elif self.key:
            touched = self._rows(later, schema)
            rows = overlay(self._rows([base], schema), self._latest(touched, later), self.key, touched)
        else:
            rows = self._rows([base, *later], schema)
        if self.key:
            rows = rows.filter(F.col("_op") != DELETED)
        return rows.select(*(name for name in schema.names if hidden or name not in self.hidden))

    def _lineage(self, commit: Row) -> list[int]:
        return commit["lineage"] or commit["chain"]

    def _schema(self, commit: Row) -> T.StructType:
        return T.StructType.fromJson(json.loads(commit["table_schema"]))

    def _rows(self, versions: Sequence[int], schema: T.StructType) -> DataFrame:
        # The declared schema saves reading file footers and fills columns that older files lack.
        stored = T.StructType([
            *schema.fields,
            T.StructField("_op", T.StringType()),
            T.StructField("_version", T.LongType()),
        ])
        folders = [f"{self.path}/rows/_version={version}" for version in versions]
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(
            *folders).select(*stored.names)

    # -- writes -----------------------------------------------------------------------------

    def append(self, df: DataFrame, committed_at: str | None = None) -> int:
        """Add rows; new columns are added to the table. Returns the new version."""
        if self.key:
            raise ValueError("a keyed table takes merges and overwrites, not appends")
        newest = self._newest()
        if newest is None:
            return self._commit(df, "APPEND", newest, [], committed_at)
        return self._commit(_fit(df, self._schema(newest)), "APPEND", newest, newest["chain"], committed_at, follows=True)

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                  committed_at: str | None = None, gathered: bool = False) -> int:
        """Replace contents and schema. Returns the new version.

        With ``partition_by`` the rows are brought together per partition by a rebalance, which
        splits a partition that outgrows a task and merges small ones; not if they are ``gathered`` already.
        """
        if self.key:
            df = one_row_per_key(df, self.key)
        if partition_by and not gathered:
            df = df.hint("rebalance", *partition_by)
        if partition_by or sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        return self._commit(df, "WRITE", self._newest(), [], committed_at, partition_by)

    def merge(self, source: DataFrame, update_columns: Sequence[str] | None = None,
              committed_at: str | None = None, new_base: bool = False, source_version: int | None = None,
              deleted: str | None = None, staged: bool | None = None, covering: bool = False,
              newer: Callable[[str], Column] | None = None, follows: bool = False) -> int:
        """Upsert one row per key; the first merge creates the table. Returns the new version.

        Keys whose source row has the flag ``deleted`` are removed, until a later merge brings them again; older
        versions still have them. With ``new_base`` the version holds the whole table and starts a new chain.
        ``staged`` tells whether the source is written first and read twice; by default the size of its plan does, which
        says too much after a join and nothing in a stream. ``covering``, for a new base, tells that the source is expected to
        name every key of the table: a large one then meets only the columns that keep their value, and should there be
        rows of other keys, these are added by a second write. ``newer``, for a source that is not staged, leaves rows of the
        table alone as ``merge_changes`` says; it ranks the rows as they are carried. A new base
        that ``follows`` still counts as built on the version before it, so ``differing`` tells their changes apart.
        """
        if not self.key:
            raise ValueError("a merge needs a keyed table")
        newest = self._newest()
        source = one_row_per_key(source, self.key)
        if newest is None:
            if deleted is not None:
                source = source.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
            return self._commit(self.stored(source), "WRITE", newest, [], committed_at, source_version=source_version)
        new_base = new_base or len(newest["chain"]) > MOST_CHANGES
        updated = None if update_columns is None else [*update_columns, *self.hidden]
        if staged is None:
            staged = settings.scan_bytes(source) <= STAGED_BYTES
        if staged and newer is not None:
            raise ValueError("a staged source is compared with the table before the merge")
        current = self._contents(newest, hidden=True, by_key=not staged)
        covering, unnamed = covering and new_base and not staged, Observation()
        if not staged:
            rows = merge_changes(self.short(source), self.short(current), self.key, updated, deleted, cut=False, whole=new_base,
                                 covering=covering, newer=newer)
            if covering:
                rows = rows.observe(unnamed, F.count_if(F.col("_op") == KEPT).alias("rows")).filter(F.col("_op") != KEPT)
            rows = self.whole(rows)
        else:
            # Read twice below, so it is written to the shared folder: a lost executor takes none of it along.
            folder = new_folder(self.spark, "merge-source")
            with settings.tidy(self.spark):
                source.write.parquet(folder)
            source = self.spark.read.schema(source.schema).parquet(folder)
            rows = merge_changes(source, current, self.key, updated, deleted)
            if new_base:
                rows = overlay(current.withColumn("_op", F.lit(KEPT)), rows, self.key, source)
        fitted, below = _fit(self.stored(rows), self._schema(newest)), [] if new_base else newest["chain"]

        def rest(written: DataFrame) -> DataFrame | None:
            if not unnamed.get["rows"]:
                return None
            kept = current.withColumn("_op", F.lit(KEPT)).to(fitted.schema)
            return kept.join(written.select(*self.key), self.key, "left_anti").select(*fitted.columns)

        return self._commit(fitted, "MERGE", newest, below, committed_at, source_version=source_version,
                            rest=rest if covering else None, follows=follows or not new_base)

    def restore(self, version: int, committed_at: str | None = None) -> int:
        """Make the contents of an older version current, as a new version without rows."""
        restored = self._commit_of(version)
        return self._record(self.latest_version() + 1, restored["chain"], "RESTORE", 0, 0, self._schema(restored),
                            committed_at, restored["source_version"], restored["lineage"])

    def _commit(self, df: DataFrame, operation: str, newest: Row | None, below: list[int],
                committed_at: str | None, partition_by: Sequence[str] = (), source_version: int | None = None,
                rest: Callable[[DataFrame], DataFrame | None] | None = None, follows: bool = False) -> int:
        # ``newest`` is the last commit that the caller saw, ``below`` the chain that the rows are laid over. ``rest`` may
        # add rows to the version when it sees those that were written. With ``follows`` the version goes on with the lineage.
        version = 0 if newest is None else newest["_version"] + 1
        if self.latest_version() != (None if newest is None else newest["_version"]):
            raise RuntimeError(f"another writer has committed version {version} of {self.path}")
        if "_op" not in df.columns:
            df = df.withColumn("_op", F.lit(INSERTED))
        schema = _nullable([field for field in df.schema.fields if field.name not in _TECHNICAL])
        counts = Observation()
        observed = df.observe(
            counts,
            F.count_if(F.col("_op") == INSERTED).alias("inserted"),
            F.count_if(F.col("_op") == UPDATED).alias("updated"),
        )
        folder = f"{self.path}/rows/_version={version}"
        with settings.tidy(self.spark):
            observed.write.mode("overwrite").option("compression", schemas.COMPRESSION).partitionBy(*partition_by).parquet(folder)
            if rest is not None and (more := rest(self.spark.read.schema(df.schema).parquet(folder))) is not None:
                more.write.mode("append").option("compression", schemas.COMPRESSION).partitionBy(*partition_by).parquet(folder)
        led = self._lineage(newest) if follows else []
        return self._record(version, [*below, version], operation, counts.get["inserted"], counts.get["updated"],
                            schema, committed_at, source_version, [*led, version])

    def _record(self, version: int, chain: list[int], operation: str, inserted: int, updated: int,
                schema: T.StructType, committed_at: str | None, source_version: int | None = None,
                lineage: list[int] | None = None) -> int:
        when = F.current_timestamp() if committed_at is None else F.lit(committed_at).cast("timestamp")
        self.spark.range(1).select(
            F.array(*map(F.lit, chain)).cast("array<bigint>").alias("chain"),
            when.alias("committed_at"),
            F.lit(operation).alias("operation"),
            F.lit(inserted).cast("bigint").alias("rows_inserted"),
            F.lit(updated).cast("bigint").alias("rows_updated"),
            F.lit(schema.json()).alias("table_schema"),
            F.lit(source_version).cast("bigint").alias("source_version"),
            F.array(*map(F.lit, lineage or chain)).cast("array<bigint>").alias("lineage"),
        ).coalesce(1).write.mode("error").parquet(f"{self.path}/commits/_version={version}")
        return version
