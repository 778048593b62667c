from __future__ import annotations

import json
import time
from pathlib import Path

from pyspark.sql import functions as F

import samples
from orestack import schemas
from orestack.operators.versioned import VersionedTable
from orestack.streaming import events


def _arrive(folder: str, name: str, lines: int = 4) -> None:
    source = Path(folder) / "in"
    source.mkdir(exist_ok=True)
    good = [json.dumps({"event_id": f"{name}-{n}", "event_type": "purchase", "amount": 1.5}) for n in range(lines)]
    (source / f"{name}.json").write_text("\n".join([*good, "{broken"]) + "\n")


def _run(spark, folder, **options):
    return events.ingest_events(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", **options)


def test_one_micro_batch_per_file_and_nothing_twice(spark, folder):
    for name in "abc":
        _arrive(folder, name)
    _run(spark, folder)
    assert samples.rows(events.progress(spark, f"{folder}/out").filter("input_rows > 0"), "input_rows") == [(5,)] * 3
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == 15 and out.filter("event_id IS NULL").count() == 3
    assert samples.rows(out.select("_source").distinct()) == [("clickstream_stream",)]
    assert out.filter(F.col("_bronze_ingested_at").isNull()).count() == 0

    _run(spark, folder)
    assert spark.read.parquet(f"{folder}/out").count() == 15

    _arrive(folder, "d")
    _run(spark, folder)
    assert spark.read.parquet(f"{folder}/out").count() == 20
    assert samples.rows(events.progress(spark, f"{folder}/out").filter("input_rows > 0"), "input_rows") == [(5,)] * 4


def test_many_files_per_micro_batch(spark, folder):
    for name in "abcd":
        _arrive(folder, name)
    _run(spark, folder, max_files_per_trigger=2)
    assert samples.rows(events.progress(spark, f"{folder}/out").filter("input_rows > 0"), "input_rows") == [(10,)] * 2


def test_an_interval_run_stops_in_time(spark, folder):
    _arrive(folder, "a")
    start = time.time()
    query = _run(spark, folder, every="1 second", stop_after=6)
    assert not query.isActive and time.time() - start < 30
    assert spark.read.parquet(f"{folder}/out").count() == 5


def test_progress_of_more_batches_than_a_query_remembers(spark, folder):
    for n in range(110):
        _arrive(folder, f"f{n}", lines=1)
    _run(spark, folder)
    _run(spark, folder)
    reported = events.progress(spark, f"{folder}/out")
    assert [r.batch_id for r in reported.filter("input_rows > 0").collect()] == list(range(110))
    assert reported.filter("input_rows > 0").agg(F.sum("input_rows")).first()[0] == 220
    assert "/_progress/" not in "".join(spark.read.parquet(f"{folder}/out").inputFiles())
    assert events.progress(spark, f"{folder}/nothing").count() == 0


def _send(folder, name, *lines):
    source = Path(folder) / "in"
    source.mkdir(exist_ok=True)
    (source / f"{name}.json").write_text("\n".join(json.dumps(line) for line in lines) + "\n")


def _event(key, at, kind="view", customer="C1", amount=1.0):
    return {"event_id": key, "event_type": kind, "customer_id": customer, "amount": amount, "event_time": at}


def test_repeated_events_come_through_once(spark, folder):
    _send(folder, "a", _event("1", "2024-01-01T00:00:00"), _event("1", "2024-01-01T00:00:00"), _event("2", "2024-01-01T01:00:00"),
          _event(None, "2024-01-01T01:00:00"), _event("x", "when"))
    _run(spark, folder, transform=events.deduplicated)
    _send(folder, "b", _event("1", "2024-01-01T00:00:00"), _event("3", "2024-01-02T00:00:00"))
    _run(spark, folder, transform=events.deduplicated)
    _send(folder, "c", _event("3", "2024-01-02T00:00:00"), _event("2", "2024-01-01T01:00:00"))
    _run(spark, folder, transform=events.deduplicated)
    assert samples.rows(spark.read.parquet(f"{folder}/out"), "event_id") == [("1",), ("2",), ("3",)]


def test_windows_close_once_and_leave_out_what_is_too_late(spark, folder):
    def run():
        _run(spark, folder, transform=lambda rows: events.windowed(rows, "1 hour"))

    _send(folder, "a", _event("1", "2024-01-01T00:10:00"), _event("2", "2024-01-01T00:50:00", amount=2.5), _event("3", "2024-01-01T01:30:00"))
    run()
    _send(folder, "b", _event("4", "2024-01-01T00:55:00"), _event("5", "2024-01-01T03:30:00"))
    run()
    _send(folder, "c", _event("6", "2024-01-01T00:59:00"), _event("7", "2024-01-01T09:30:00"))
    run()
    windows = spark.read.parquet(f"{folder}/out").selectExpr("hour(window_start) AS h", "event_count", "CAST(amount AS DOUBLE) AS amount")
    assert samples.rows(windows) == [(0, 3, 4.5), (1, 1, 1.0), (3, 1, 1.0)]


def test_sessions_end_after_a_gap(spark, folder):
    for name, events_ in (("a", [_event(str(n), f"2024-01-01T00:{n:02d}:00", customer=c) for n in (0, 5, 30) for c in ("C1", "C2")]),
                          ("b", [_event("9", "2024-01-01T00:34:00"), _event("end", "2024-01-02T00:00:00", customer=None),
                                 _event("end", "2024-01-02T00:00:00", customer="end")])):
        _send(folder, name, *events_)
        _run(spark, folder, transform=lambda rows: events.sessions(rows, "10 minutes"))
    found = spark.read.parquet(f"{folder}/out").selectExpr("customer_id", "minute(window_start) AS m", "event_count")
    assert samples.rows(found) == [("C1", 0, 2), ("C1", 30, 2), ("C2", 0, 2), ("C2", 30, 1)]


def test_newer_copies_replace_older_ones_and_a_replayed_batch_changes_nothing(spark, folder):
    silver = VersionedTable(spark, f"{folder}/silver", key=["event_id"])

    def run():
        events.upsert_events(spark, f"{folder}/in", silver, f"{folder}/state")
        return samples.rows(silver.current(), "event_id", "amount")

    _send(folder, "a", _event("1", "2024-01-01T00:00:00"), _event("1", "2024-01-02T00:00:00", amount=2.0),
          _event("2", "2024-01-01T00:00:00"), _event(None, "2024-01-01T00:00:00"), _event("x", "when"))
    assert run() == [("1", 2.0), ("2", 1.0)]
    _send(folder, "b", _event("1", "2024-01-01T12:00:00", amount=3.0), _event("2", "2024-01-01T00:00:01", amount=4.0), _event("3", "2024-01-01T00:00:00"))
    assert run() == run() == [("1", 2.0), ("2", 4.0), ("3", 1.0)]
    version = silver.latest_version()
    events.merge_batch(spark.read.schema(schemas.RAW_EVENTS).json(f"{folder}/in"), silver.source_version(), silver)
    assert silver.latest_version() == version
    # Without its checkpoint the stream starts again, and silver knows all of its batches.
    events.upsert_events(spark, f"{folder}/in", silver, f"{folder}/other")
    assert silver.latest_version() == version
