"""Plain parquet tables whose partitions are replaced one by one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orestack import schemas, settings


class PartitionedTable:
    """A partitioned parquet folder. Replaced partitions get new files, and all others keep theirs.

    Rows of a partition are brought together by a rebalance, which splits a partition that outgrows a task, unless they are
    ``gathered`` already.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    def current(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", "false").parquet(self.path)

    def replace(self, df: DataFrame, sort_by: Sequence[str] = (), gathered: bool = False) -> None:
        """Replace the whole table."""
        self._write(df, sort_by, "static", gathered)

    def replace_partitions(self, df: DataFrame, touched: Sequence[tuple], sort_by: Sequence[str] = (),
                           gathered: bool = False) -> None:
        """Replace the ``touched`` partitions by the rows of ``df``, which must all be in them.

        A touched partition without rows is removed: a dynamic overwrite leaves such a one as it was. The write itself
        tells which ones have rows.
        """
        for values in set(touched) - self._write(df, sort_by, "dynamic", gathered):
            self._remove("/".join(f"{name}={value}" for name, value in zip(self.partition_by, values)))

    def _write(self, df: DataFrame, sort_by: Sequence[str], mode: str, gathered: bool) -> set[tuple]:
        """Write the rows; returns the partitions that have some."""
        filled = Observation()
        rows = df if gathered else df.hint("rebalance", *self.partition_by)
        rows = rows.observe(filled, F.collect_set(F.struct(*self.partition_by)).alias("partitions"))
        rows = rows.sortWithinPartitions(*self.partition_by, *sort_by)
        with settings.tidy(self.spark):
            rows.write.mode("overwrite").option("partitionOverwriteMode", mode).option(
                "compression", schemas.COMPRESSION).partitionBy(*self.partition_by).parquet(self.path)
        return {tuple(row) for row in filled.get["partitions"]}

    def _remove(self, partition: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{partition}")
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
