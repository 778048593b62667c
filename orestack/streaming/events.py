"""Click events: a folder of JSON-lines files as a stream into the bronze layer."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from orestack import schemas
from orestack.operators.versioned import VersionedTable

# Fixed value.
SOURCE_LABEL = "clickstream_stream"

KEEP_KEYS = "2 days"  # of event time, for which copies of an event are known
LATE = "1 hour"  # that an event may be behind the newest one
POLL = 1  # seconds between two looks at a running query
_PROGRESS = "_progress"  # hidden from readers of the output


def event_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1) -> DataFrame:
    """New JSON-lines files of a folder. A broken line becomes a row of NULLs.

    One file per micro-batch suits a demonstration; raise it with the arrival rate of the files.
    """
    return (
        spark.readStream
        .schema(schemas.RAW_EVENTS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(folder)
    )


def with_audit(events: DataFrame, source: str = SOURCE_LABEL) -> DataFrame:
    """Add the micro-batch time and the source label."""
    return events.withColumns({
        "_bronze_ingested_at": F.current_timestamp(),
        "_source": F.lit(source),
    })


def start_ingest(events: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder, each file exactly once across restarts.

    Without ``every`` the query takes what is there and ends; with it, it runs on that interval.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        events.writeStream
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(out)
    )


def deduplicated(events: DataFrame, keep_for: str = KEEP_KEYS) -> DataFrame:
    """The first event of every id, also over restarts; a copy later than ``keep_for`` may come through again.

    State holds the ids of the last ``keep_for`` of event time only. An event without a time or an id is left
    out here, since neither a watermark nor a copy can be told by it; bronze keeps it.
    """
    timed = events.filter(F.col("event_id").isNotNull()).withColumn("event_at", F.col("event_time").try_cast("timestamp"))
    return timed.filter(F.col("event_at").isNotNull()).withWatermark("event_at", keep_for).dropDuplicatesWithinWatermark(["event_id"])


def windowed(events: DataFrame, size: str, slide: str | None = None, late: str = LATE) -> DataFrame:
    """Events and their amount per window of event time and type: tumbling, or sliding with ``slide``.

    A window is written once, when the watermark has passed its end by ``late``. Counts are aggregated per task
    before the shuffle, so a hot type sends a row per task and window.
    """
    return _counted(events, F.window("event_at", size, slide), late, "event_type")


def sessions(events: DataFrame, gap: str, late: str = LATE) -> DataFrame:
    """Events and their amount per session of a customer: events with less than ``gap`` between them."""
    return _counted(events.filter(F.col("customer_id").isNotNull()), F.session_window("event_at", gap), late, "customer_id")


def _counted(events: DataFrame, window: Column, late: str, key: str) -> DataFrame:
    timed = events.withColumn("event_at", F.col("event_time").try_cast("timestamp")).filter(F.col("event_at").isNotNull())
    return timed.withWatermark("event_at", late).groupBy(window.alias("window"), key).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(F.col("amount").cast("decimal(18,4)")).alias("amount"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "event_count", "amount")


def newest_events(events: DataFrame) -> DataFrame:
    """A row per event id: its copy with the latest time; of those with one time, the greatest in its other columns.

    An event without an id or a time is left out. Copies are aggregated per task before the shuffle.
    """
    timed = events.withColumn("event_at", F.col("event_time").try_cast("timestamp"))
    copy = F.struct("event_at", *(name for name in events.columns if name != "event_id"))
    known = timed.filter(F.col("event_id").isNotNull() & F.col("event_at").isNotNull())
    return known.groupBy("event_id").agg(F.max(copy).alias("newest")).select("event_id", "newest.*")


def merge_batch(batch: DataFrame, number: int, silver: VersionedTable) -> None:
    """Merge one micro-batch into the silver events, where a copy that is newer than the known one replaces it.

    A batch that silver holds already, since it was replayed after a crash, changes nothing.
    """
    done = silver.source_version()
    if done is not None and number <= done:
        return
    newest = newest_events(batch)
    if done is not None:
        copy = [name for name in newest.columns if name != "event_id"]
        before = silver.current().join(newest.select("event_id"), "event_id", "left_semi").select(
            "event_id", F.struct(*copy).alias("_known"))
        newest = newest.join(before, "event_id", "left").filter(
            F.col("_known").isNull() | (F.struct(*copy) > F.col("_known"))).drop("_known")
    silver.merge(newest, source_version=number, staged=True)


def upsert_events(spark: SparkSession, folder: str, silver: VersionedTable, checkpoint: str,
                  max_files_per_trigger: int = 1) -> StreamingQuery:
    """Merge what is new in a folder into the silver events, keyed by ``event_id``, and end.

    Silver stores the number of its last micro-batch with its commit, so it must stay with its ``checkpoint``.
    """
    query = (
        event_stream(spark, folder, max_files_per_trigger).writeStream
        .foreachBatch(lambda batch, number: merge_batch(batch, number, silver))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_events(spark: SparkSession, folder: str, out: str, checkpoint: str,
                  max_files_per_trigger: int = 1, every: str | None = None,
                  stop_after: float | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Run the ingest to its end, or on an interval for ``stop_after`` seconds.

    ``transform`` may replace the audit columns by other work on the stream.
    """
    events = event_stream(spark, folder, max_files_per_trigger)
    query = start_ingest(with_audit(events) if transform is None else transform(events), out, checkpoint, every)
    seen: dict[tuple, tuple] = {}
    until = None if stop_after is None else time.monotonic() + stop_after
    try:
        while query.isActive and (until is None or time.monotonic() < until):
            query.awaitTermination(POLL if until is None else min(POLL, max(0.0, until - time.monotonic())))
            _remember(query, seen)
    finally:
        query.stop()
        _remember(query, seen)
        if seen:
            spark.createDataFrame(sorted(seen.values()), schemas.PROGRESS).coalesce(1).write.mode("append").parquet(
                f"{out}/{_PROGRESS}")
    if query.exception() is not None:
        raise query.exception()
    return query


def _remember(query: StreamingQuery, seen: dict[tuple, tuple]) -> None:
    # A query keeps its last hundred; it is asked far more often than it can end so many.
    for step in query.recentProgress:
        key = (str(step.runId), step.batchId, step.timestamp)
        seen[key] = (*key, step.numInputRows, step.durationMs.get("triggerExecution"))


def progress(spark: SparkSession, out: str) -> DataFrame:
    """What the runs reported, oldest first: run, micro-batch, its start, input rows and milliseconds.

    It is read from what every run wrote beside its output, and never from the output. A micro-batch
    without rows is there too. Empty before the first report.
    """
    try:
        rows = spark.read.schema(schemas.PROGRESS).parquet(f"{out}/{_PROGRESS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schemas.PROGRESS)
    return rows.orderBy("started_at", "batch_id")
