"""The streaming job on captured arrivals: outputs, recovery, idleness, state, switching."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import PipelineConfig
from tidemark.operators import logs
from tidemark.plans import datasets
from tidemark.sources import capture, table, topics
from tidemark.schema import DLQ_FIELDS
from tidemark.streaming import sinks, tenant_state
from tidemark.streaming.job import TelemetryJob
from tidemark.streaming.pipeline import Paths, distinct_sends, start_pipeline
from tidemark.streaming.progress import ProgressSamples, read_samples
from tidemark.streaming.state import WatermarkState
from test_contract import GOOD

SF = "/root/testdata/sf0.001"


class Clock:
    """A processing-time clock that moves on by a fixed step for each batch."""

    def __init__(self, step: int = 10_000) -> None:
        self.now, self.step = 0, step

    def __call__(self) -> int:
        self.now += self.step
        return self.now


def put(folder, name: str, events: list[tuple[int, object]]) -> None:
    """One capture file; an event is (partition, JSON text or changes to a good record)."""
    folder.mkdir(exist_ok=True)
    lines = []
    for i, (part, event) in enumerate(events):
        value = event if isinstance(event, str) else json.dumps({**GOOD, **event})
        lines.append(json.dumps({"key": "k", "value": value, "src_partition": part, "offset": i}))
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(lines))
    # Files are taken in order of modification time, so the order is set, not left to chance.
    when = 1_700_000_000 + int(name.split(".")[0])
    os.utime(hidden, (when, when))
    hidden.rename(folder / name)


def minute(m: int, second: int = 0) -> dict:
    return {"event_time": f"2026-08-23T12:{m:02d}:{second:02d}.000Z", "event_id": f"e-{m}-{second}"}


def run(spark, folder, paths, config=None, clock=None, **kw):
    stream = topics.captured_stream(spark, str(folder), files_per_trigger=1)
    query = start_pipeline(spark, stream, paths, config, available_now=True, clock_ms=clock or Clock(), **kw)
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_rows_rejects_watermarks_and_restart(spark, tmp_path):
    folder, paths = tmp_path / "in", Paths(str(tmp_path / "out"))
    clock = Clock()
    put(folder, "0.json", [(0, minute(10)), (1, minute(5)), (0, '{"broken":')])
    run(spark, folder, paths, clock=clock)
    # Partition 1 holds the watermark at 12:05 minus ten seconds; this event is behind it and is kept.
    put(folder, "1.json", [(0, minute(1)), (0, minute(20))])
    run(spark, folder, paths, clock=clock)

    rows = {r["event_id"]: r for r in table.read_table(spark, paths.table).collect()}
    assert set(rows) == {"e-10-0", "e-5-0", "e-1-0", "e-20-0"}
    assert rows["e-10-0"]["watermark_at_arrival"] is None and rows["e-10-0"]["is_late"] is False
    assert rows["e-1-0"]["watermark_at_arrival"].minute == 4
    assert (rows["e-1-0"]["is_late"], rows["e-1-0"]["lateness_ms"]) == (True, 230_000)
    assert (rows["e-20-0"]["is_late"], rows["e-20-0"]["lateness_ms"]) == (False, 0)
    assert all(r["ingested_at"] >= r["processed_at"] for r in rows.values())

    rejects = sinks.read_dlq_files(spark, paths.dead_letters).collect()
    assert [(r["raw_payload"], r["error_category"]) for r in rejects] == [('{"broken":', "invalid_json")]


def test_idle_partition_stops_holding_the_watermark(spark, tmp_path):
    folder, paths = tmp_path / "in", Paths(str(tmp_path / "out"))
    put(folder, "0.json", [(0, minute(10)), (1, minute(5))])
    for i in range(1, 6):
        put(folder, f"{i}.json", [(0, minute(10 + i))])
    run(spark, folder, paths)
    got = {
        r["event_id"]: r["watermark_at_arrival"].strftime("%M:%S") if r["watermark_at_arrival"] else None
        for r in table.read_table(spark, paths.table).collect()
    }
    # Batches come ten seconds apart: partition 1 is counted for three more of them.
    assert [got[f"e-{10 + i}-0"] for i in range(6)] == [None, "04:50", "04:50", "04:50", "12:50", "13:50"]


def test_replayed_batch_reaches_the_same_watermark(spark, tmp_path):
    folder, paths = tmp_path / "in", Paths(str(tmp_path / "out"))
    put(folder, "0.json", [(0, minute(10))])
    put(folder, "1.json", [(0, minute(9))])
    clock = Clock(0)

    def failing_once(write):
        calls = []

        def sink(rows, batch_id):
            write(rows, batch_id)
            calls.append(batch_id)
            if calls == [0, 1]:
                raise RuntimeError("lost after the write")

        return sink

    sink = failing_once(sinks.table_sink(paths.table))
    stream = topics.captured_stream(spark, str(folder), files_per_trigger=1)
    query = start_pipeline(spark, stream, paths, available_now=True, clock_ms=clock, rows_sink=sink)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    run(spark, folder, paths, clock=clock, rows_sink=sink)
    rows = table.read_table(spark, paths.table).groupBy("event_id", "watermark_at_arrival").count().collect()
    # At least once: the batch that failed after its write is stored twice, with one watermark.
    assert sorted((r["event_id"], r["count"]) for r in rows) == [("e-10-0", 1), ("e-9-0", 2)]


def test_idempotent_folders_absorb_a_replay(spark, tmp_path):
    paths = Paths(str(tmp_path / "out"))
    rows = datasets.telemetry(spark, SF).limit(10).drop("ingested_at", "ym")
    write = sinks.idempotent_table_sink(paths.table)
    write(rows, 3)
    write(rows, 3)
    assert spark.read.parquet(paths.table).count() == 10


def test_whole_dataset_reconciles(spark, tmp_path):
    folder, paths = tmp_path / "in", Paths(str(tmp_path / "out"))
    arrivals = datasets.arrivals(spark, SF).select("key", "value", "src_partition", "offset")
    arrivals.repartition(3).write.json(str(folder))
    listener = ProgressSamples(str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        run(spark, folder, paths)
        stored = table.read_table(spark, paths.table).count()
        rejected = sinks.read_dlq_files(spark, paths.dead_letters).count()
        assert (stored, rejected) == (1_039, 11)
        deadline = time.time() + 20
        while time.time() < deadline and not list((tmp_path / "progress").glob("progress-*.json")):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    seen = listener.as_table(spark)
    total = seen.filter("name = 'validation_records_valid'").agg(F.sum("value")).first()[0]
    assert total <= 1_039 and seen.filter("name = 'batch_input_rows'").count() > 0


def test_a_missing_watermark_slot_stops_the_query(spark, tmp_path):
    state = WatermarkState(spark, str(tmp_path / "state"))
    assert state.after(-1).count() == 0
    arrivals = spark.createDataFrame([(0, 5_000)], "src_partition int, event_ms long")
    state.advance(state.after(-1), arrivals, 0, 1_000, None)
    state.advance(state.after(0), arrivals.limit(0), 1, 2_000, 4_000)
    assert state.watermark(state.after(1), 2_000, 1_000, 30_000) == 4_000
    for lost in (2, 5):  # never written, and a slot that another batch has
        with pytest.raises(RuntimeError, match="missing"):
            state.after(lost)


def test_late_counts_of_every_batch_are_kept(spark, tmp_path):
    folder, paths = tmp_path / "in", Paths(str(tmp_path / "out"))
    put(folder, "0.json", [(0, minute(10))])
    put(folder, "1.json", [(0, minute(9)), (0, minute(11))])
    run(spark, folder, paths)
    counted = read_samples(spark, paths.metrics).filter("name = 'records_late'")
    assert sorted((r["labels"]["batch_id"], r["value"]) for r in counted.collect()) == [("0", 0.0), ("1", 1.0)]


def test_replayed_dead_letters_are_replaced(spark, tmp_path):
    letters = spark.createDataFrame([tuple("abcdef")], list(DLQ_FIELDS))
    write = sinks.idempotent_dlq_sink(str(tmp_path / "dlq"))
    for _ in range(2):
        write(letters, 3)
    write(letters, 4)
    assert sinks.read_dlq_files(spark, str(tmp_path / "dlq")).count() == 2


def test_tenant_state_counts_and_milestones(spark, tmp_path):
    folder = tmp_path / "in"
    hot = {"tenant_id": "tenant-hot"}
    put(folder, "0.json", [(0, hot)] * 7 + [(1, {"tenant_id": "t1"}), (0, "bad")])
    checkpoint, output = str(tmp_path / "ckpt"), str(tmp_path / "totals")

    def go():
        query = tenant_state.start_tenant_state(
            spark, topics.captured_stream(spark, str(folder)), checkpoint, output, available_now=True
        )
        query.awaitTermination(120)
        assert query.exception() is None

    go()
    assert tenant_state.state_value(spark, checkpoint).first()["tenant_record_count"] == 7
    put(folder, "1.json", [(0, hot)] * 95)
    go()
    assert tenant_state.state_value(spark, checkpoint).first()["tenant_record_count"] == 102
    totals = spark.read.schema(tenant_state.OUTPUT).json(output)
    passed = sorted(r["tenant_record_count"] for r in tenant_state.milestones(totals).collect())
    assert passed == [1, 10, 100]
    assert totals.filter("tenant_id = 't1'").first()["total"] == 1


def test_switching_the_state_query_leaves_the_main_one_alone(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "0.json", [(0, {"tenant_id": "tenant-hot"})] * 3)
    paths = Paths(str(tmp_path / "out"))
    job = TelemetryJob(
        spark, lambda: topics.captured_stream(spark, str(folder)), paths, PipelineConfig(trigger="0 seconds")
    )
    job.start()
    with pytest.raises(RuntimeError):
        job.start()
    main = job.main.runId
    assert job.switch_tenant_state(False) is False
    assert job.switch_tenant_state(True) is True
    assert job.switch_tenant_state(True) is False
    job.side.processAllAvailable()
    assert tenant_state.state_value(spark, paths.tenant_state(0)).first()["tenant_record_count"] == 3
    assert job.switch_tenant_state(False) is True
    assert job.generation == 0 and job.main.runId == main and job.main.isActive
    with pytest.raises(ValueError):
        job.switch_tenant_state(True, parallelism=7)
    put(folder, "1.json", [(0, {"tenant_id": "tenant-hot"})] * 2)
    job.main.processAllAvailable()
    assert job.switch_tenant_state(True) is True
    job.side.processAllAvailable()
    assert tenant_state.state_value(spark, paths.tenant_state(0)).first()["tenant_record_count"] == 5
    job.stop()
    assert table.read_table(spark, paths.table).count() == 5


def test_side_table_without_repeated_sends(spark, tmp_path):
    source, out = str(tmp_path / "rows"), str(tmp_path / "unique")
    rows = datasets.telemetry(spark, SF)
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    unique = distinct_sends(stream, "40 days").writeStream.format("parquet").option("path", out)
    query = unique.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.read.parquet(out).count() == rows.select("producer_run_id", "producer_sequence").distinct().count()


def test_log_files_are_read_line_by_line(spark, tmp_path):
    (tmp_path / "a.log").write_text('{"level":"INFO","component":"c"}\nplain\n')
    lines = topics.log_files(spark, str(tmp_path), "svc")
    assert lines.columns == ["service", "raw"] and lines.count() == 2
    row = logs.with_labels(logs.parse_lines(lines)).first()
    assert (row["service"], row["level"], row["component"]) == ("svc", "INFO", "c")


def test_totals_are_carried_over_to_another_number_of_tasks(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), Paths(str(tmp_path / "out"))

    def more(counts: dict[str, int], first: int) -> None:
        rows = []
        for partition, (tenant, n) in enumerate(counts.items()):
            rows += [(tenant, json.dumps(GOOD | {"tenant_id": tenant}), partition, first + i) for i in range(n)]
        capture.write_capture(spark.createDataFrame(rows, "key string, value string, src_partition int, offset long"), topic)

    def side(generation, start):
        return capture.captured_topic(spark, topic, str(tmp_path / f"position-{generation}.json"), 20, starting=start)

    def main():
        return capture.captured_topic(spark, topic, str(tmp_path / "position-main.json"))

    def totals(generation):
        return {r["tenant_id"]: r["n"] for r in tenant_state.stored_totals(spark, paths.tenant_state(generation)).collect()}

    more({"tenant-hot": 30, "a": 5, "quiet": 2}, 0)
    config = PipelineConfig(trigger="0 seconds", tenant_state=True, parallelism=2)
    job = TelemetryJob(spark, main, paths, config, side)
    job.start()
    job.switch_tenant_state(False)
    assert totals(0) == {"tenant-hot": 30, "a": 5, "quiet": 2}
    more({"tenant-hot": 12, "a": 1}, 30)
    assert job.switch_tenant_state(True, parallelism=3) and job.generation == 1
    job.side.processAllAvailable()
    more({"tenant-hot": 3}, 42)
    job.switch_tenant_state(False)
    assert totals(1) == {"tenant-hot": 45, "a": 6, "quiet": 2}
    assert job.switch_tenant_state(True) and job.generation == 1
    job.stop()
    assert totals(1) == {"tenant-hot": 45, "a": 6, "quiet": 2}
    changes = spark.read.schema(tenant_state.OUTPUT).json(f"{paths.tenant_state(1)}-output")
    assert changes.filter("tenant_id = 'quiet'").count() == 0
    assert changes.filter("tenant_id = 'tenant-hot'").agg(F.min("previous"), F.max("total")).first()[:] == (30, 45)
