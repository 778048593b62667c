"""Session settings that the plans of this library count on. None of them changes a result."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles, picks broadcasts by measured size and splits hot join keys.
# The forced form also splits them where the split costs one more shuffle, as it does when an
# aggregation could otherwise reuse the partitioning of the join.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# A shuffle starts with one partition per this many input bytes, and adaptive execution merges those
# that turn out small.
BYTES_PER_PARTITION = 256 * 1024 ** 2

# Rows in a shuffle and its sorts are larger than in files: 18 stored bytes of an order line become about 300, and so do
# 80 bytes of CSV. A shuffle that is sized by its files gives a task more rows than it can sort in memory.
PARQUET_GROWTH, TEXT_GROWTH = 16, 4

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Shuffled bytes of a partition whose rows become much wider after the shuffle and are then sorted: some 13 times
# this in memory.
BYTES_BEFORE_WIDENING = 32 * 1024 ** 2


def shuffle_partitions(input_bytes: int, at_least: int) -> int:
    """Shuffle partitions to start with for an input of a size."""
    return max(at_least, -(-input_bytes // BYTES_PER_PARTITION))


def apply(spark: SparkSession, input_bytes: int | None = None) -> None:
    """Set them for the running session; with ``input_bytes`` also size its shuffles."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    if input_bytes is not None:
        default = int(spark.conf.get(_SHUFFLE_PARTITIONS))
        spark.conf.set(_INITIAL_PARTITIONS, str(shuffle_partitions(input_bytes, default)))


def scan_bytes(scan: DataFrame) -> int:
    """The bytes of the files that a plain scan reads, from the statistics of its plan."""
    return int(str(scan._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def row_bytes(scan: DataFrame, growth: int) -> int:
    """About what the rows of a plain scan take in memory, for sizing shuffles."""
    return scan_bytes(scan) * growth


def is_broadcast(frame: DataFrame) -> bool:
    """Whether Spark broadcasts a frame in a join, by the size that it plans with."""
    optimized = frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    most = frame.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(optimized)) <= most


@contextmanager
def _restored(spark: SparkSession, names: Sequence[str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def applied(spark: SparkSession, input_bytes: int | None = None) -> Iterator[None]:
    """The settings for a block of work; afterwards the session has those it had before."""
    with _restored(spark, [*ADAPTIVE, _INITIAL_PARTITIONS]):
        apply(spark, input_bytes)
        yield


@contextmanager
def open_files(spark: SparkSession, count: int) -> Iterator[None]:
    """A write by partition keeps fewer than ``count`` files open in a task, and does not sort the rows by partition first."""
    with _restored(spark, [_OPEN_FILES]):
        spark.conf.set(_OPEN_FILES, str(count))
        yield


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a job go when it ends, and not when the driver collects its garbage.

    For jobs whose result is a table or a few rows: a plan that is run a second time has to shuffle again.
    """
    with _restored(spark, [_CLEANUP]):
        spark.conf.set(_CLEANUP, "true")
        yield


@contextmanager
def widening(spark: SparkSession) -> Iterator[None]:
    """Shuffles give a partition at most ``BYTES_BEFORE_WIDENING``, for rows that are widened and then sorted."""
    with _restored(spark, [_ADVISORY]):
        most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ADVISORY))
        spark.conf.set(_ADVISORY, str(min(most, BYTES_BEFORE_WIDENING)))
        yield
