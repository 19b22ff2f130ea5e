"""The captured topic as a source with offsets, and what is built on them: lag, numbers, row watermarks."""

from __future__ import annotations

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import PipelineConfig
from tidemark.operators import watermark
from tidemark.sources import capture, topics
from tidemark.streaming import committed, progress
from tidemark.streaming.pipeline import drain
from tidemark.streaming.running_count import start_running_count
from tidemark.streaming.state import TenantTotals
from test_contract import GOOD


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, src_partition int, offset long")


def plain(n: int, partition: int, first: int = 0):
    return [("k", f"v{partition}-{i}", partition, i) for i in range(first, first + n)]


@pytest.mark.parametrize(
    ("at", "ends", "limit", "want"),
    [
        ({}, {0: 10, 1: 5}, None, {0: 10, 1: 5}),
        ({0: 4}, {0: 10, 1: 5}, 100, {0: 10, 1: 5}),
        ({}, {0: 90, 1: 10}, 10, {0: 9, 1: 1}),
        ({}, {0: 1_000, 1: 1}, 10, {0: 9, 1: 1}),  # a small backlog is not passed over
        ({0: 10, 1: 5}, {0: 10, 1: 5}, 3, {0: 10, 1: 5}),
        ({0: 10, 2: 7}, {0: 4}, 3, {0: 10, 2: 7}),  # never back
    ],
)
def test_what_a_batch_takes(at, ends, limit, want):
    assert capture.admitted(at, ends, limit) == want


def taken(spark, path, position, checkpoint, limit=None, per_task=7):
    """Batches of (partition, offset) lists that a query over the capture gets until nothing waits."""
    got = []

    def keep(rows, batch_id):
        got.append(sorted((r["src_partition"], r["offset"], r["value"]) for r in rows.collect()))

    stream = capture.captured_topic(spark, str(path), str(position), limit, per_task)
    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(checkpoint)).trigger(processingTime="0 seconds").start()
    return got, drain(query)


def test_limit_restart_and_new_files(spark, tmp_path):
    path, position, checkpoint = (f"{tmp_path}/{x}" for x in ("topic", "position.json", "checkpoint"))
    capture.write_capture(arrivals(spark, plain(60, 0) + plain(20, 1, first=5)), path, file_rows=11)
    got, query = taken(spark, path, position, checkpoint, limit=40)
    assert [len(b) for b in got] == [40, 40]
    assert [collections.Counter(p for p, _, _ in b) for b in got] == [{0: 30, 1: 10}, {0: 30, 1: 10}]
    assert progress.end_offsets(query.lastProgress.sources[0]) == {"0": 60, "1": 25}
    # Later arrivals, a partition that is new among them, are read from where the query stopped.
    capture.write_capture(arrivals(spark, plain(3, 0, first=60) + plain(2, 4)), path)
    more, query = taken(spark, path, position, checkpoint, limit=40)
    assert more == [[(0, 60, "v0-60"), (0, 61, "v0-61"), (0, 62, "v0-62"), (4, 0, "v4-0"), (4, 1, "v4-1")]]
    every = [r for b in [*got, *more] for r in b]
    assert sorted(every) == sorted((p, o, v) for _, v, p, o in plain(63, 0) + plain(20, 1, first=5) + plain(2, 4))
    assert taken(spark, path, position, checkpoint, limit=40)[0] == []


def test_a_planned_batch_is_read_again(spark, tmp_path):
    path, position, checkpoint = (f"{tmp_path}/{x}" for x in ("topic", "position.json", "checkpoint"))
    capture.write_capture(arrivals(spark, plain(30, 0)), path)

    def fail(rows, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    stream = capture.captured_topic(spark, path, position, 10)
    query = stream.writeStream.foreachBatch(fail).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    got, _ = taken(spark, path, position, checkpoint, limit=10)
    assert [[o for _, o, _ in b] for b in got] == [list(range(10, 20)), list(range(20, 30))]


def test_a_hot_partition_is_read_by_many_tasks(spark, tmp_path):
    capture.write_capture(arrivals(spark, plain(100, 0)), f"{tmp_path}/topic", file_rows=30)
    reader = capture.CapturedReader({"path": f"{tmp_path}/topic", "position": f"{tmp_path}/p", "rowsPerTask": "25"})
    tasks = reader.partitions({}, {"0": 100})
    assert [(t.start, t.end) for t in tasks] == [(0, 25), (25, 50), (50, 75), (75, 100)]
    assert all(len(t.files) <= 2 for t in tasks)
    assert [o for t in tasks for b in reader.read(t) for o in b.column(3).to_pylist()] == list(range(100))
    with pytest.raises(ValueError, match="positive"):
        capture.CapturedReader({"path": "x", "position": "y", "maxOffsetsPerTrigger": "0"})


def test_lag_after_a_stop(spark, tmp_path):
    path = f"{tmp_path}/topic"
    capture.write_capture(arrivals(spark, plain(80, 0) + plain(20, 1)), path)
    stream = capture.captured_topic(spark, path, f"{tmp_path}/position", 50)
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    progress.store_samples(f"{tmp_path}/metrics", "one", progress.progress_samples(query.lastProgress))
    done = progress.committed_offsets(progress.read_samples(spark, f"{tmp_path}/metrics"))
    lag = topics.consumer_lag(capture.captured_ends(spark, path), done)
    assert sorted(map(tuple, lag.collect())) == [(0, 80, 40, 40), (1, 20, 10, 10)]


def test_offsets_of_other_sources_in_progress():
    class Source:
        def __init__(self, end):
            self.endOffset = end

    assert progress.end_offsets(Source("{'raw': {'0': 5, '1': 7}}")) == {"raw-0": 5, "raw-1": 7}
    assert progress.end_offsets(Source("{'logOffset': 3}")) == {"logOffset": 3}
    assert progress.end_offsets(Source(None)) == progress.end_offsets(Source("12")) == progress.end_offsets(Source("{")) == {}


@pytest.mark.parametrize(("limit", "block"), [(None, 65_536), (37, 4), (11, 1)])
def test_numbers_do_not_depend_on_batches(spark, tmp_path, limit, block):
    rng = random.Random(5)
    rows, at = [], collections.Counter()
    for i in range(150):
        tenant = "tenant-hot" if rng.random() < 0.7 else f"tenant-{rng.randrange(4)}"
        partition = 0 if tenant == "tenant-hot" else 1 + int(tenant[-1]) % 2
        value = json.dumps({**GOOD, "tenant_id": tenant, "event_id": f"e{i}"}) if i % 13 else "broken"
        rows.append((tenant, value, partition, at[partition]))
        at[partition] += 1
    path = f"{tmp_path}/topic"
    capture.write_capture(arrivals(spark, rows), path)
    stream = capture.captured_topic(spark, path, f"{tmp_path}/position", limit)
    out = f"{tmp_path}/out"

    def keep(df, batch_id):
        committed.write_batch(df.select("tenant_id", "event_id", "tenant_record_count"), out, batch_id, 1_000, 1_000, 0)

    drain(start_running_count(spark, stream, f"{tmp_path}/c", keep, "0 seconds", block))
    got = committed.read_committed(spark, out, "tenant_id string, event_id string, tenant_record_count long").collect()
    seen, want = collections.Counter(), []
    for i, (tenant, value, _, _) in enumerate(rows):
        if value != "broken":
            seen[tenant] += 1
            want.append((tenant, f"e{i}", seen[tenant]))
    assert sorted(map(tuple, got)) == sorted(want)
    last = max(r["batch_id"] for r in spark.read.parquet(f"{tmp_path}/c/totals").collect())
    kept = TenantTotals(spark, f"{tmp_path}/c/totals").after(last)
    assert {r["tenant_id"]: r["total"] for r in kept.collect() if r["tenant_id"]} == dict(seen)


def test_missing_totals_stop_the_count(spark, tmp_path):
    with pytest.raises(RuntimeError, match="running count of batch 3 is missing"):
        TenantTotals(spark, f"{tmp_path}/none").after(3)


@pytest.mark.parametrize("block", [3, 7, 1_000])
def test_row_watermark_against_a_loop(spark, block):
    rng = random.Random(block)
    rows, now = [], 0
    for i in range(160):
        now += rng.choice([0, 1, 40, 400]) * 10
        rows.append((i, rng.choice([0, 0, 0, 0, 3, 9]) if i > 20 else 0, now, rng.choice([0, now + rng.randrange(-900, 900)])))
    df = spark.createDataFrame(rows, "arrival long, src_partition int, at_ms long, event_ms long")
    got = watermark.row_watermark(df, out_of_order_ms=100, idle_ms=3_000, block_rows=block)
    reached, last, mark, want = {}, {}, None, {}
    for i, p, at, event in rows:
        low = [reached[q] for q in reached if at - last[q] <= 3_000]
        if low:
            mark = max(min(low) - 100, mark if mark is not None else min(low) - 100)
        want[i] = mark
        reached[p], last[p] = max(event, reached.get(p, event)), at
    assert got.columns == [*df.columns, "watermark_ms"]
    assert {r["arrival"]: r["watermark_ms"] for r in got.collect()} == want
    assert watermark.row_watermark(df.limit(0)).count() == 0


def test_one_window_holds_one_block(spark):
    df = spark.range(100).select(F.col("id").alias("arrival"), F.lit(0).alias("src_partition"), F.col("id").alias("at_ms"), F.col("id").alias("event_ms"))
    plan = watermark.row_watermark(df, block_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_block" in plan


def test_settings_of_the_source():
    assert PipelineConfig.from_settings({"max_offsets_per_trigger": "12"}).max_offsets_per_trigger == 12
    with pytest.raises(ValueError, match="max_offsets_per_trigger"):
        PipelineConfig(max_offsets_per_trigger=0)


def test_a_task_streams_only_the_row_groups_it_needs(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 50_000, 1, 1).selectExpr("'k' AS key", "repeat(sha2(string(id), 256), 30) AS value", "0 AS src_partition", "id AS offset")
    capture.write_capture(rows, f"{tmp_path}/topic")
    reader = capture.CapturedReader({"path": f"{tmp_path}/topic", "position": f"{tmp_path}/p", "rowsPerTask": "9000"})
    tasks = reader.partitions({}, {"0": 50_000})
    opened, whole = [], capture.pq.ParquetFile

    class Watched(whole):
        def iter_batches(self, size, groups, *args, **kwargs):
            opened.extend(self.metadata.row_group(g).num_rows for g in groups)
            return super().iter_batches(size, groups, *args, **kwargs)

    monkeypatch.setattr(capture.pq, "ParquetFile", Watched)
    batches = list(reader.read(tasks[2]))
    assert [o for b in batches for o in b.column(3).to_pylist()] == list(range(18_000, 27_000))
    assert 0 < sum(opened) <= 2 * capture.ROW_GROUP_ROWS
    assert max(b.nbytes for b in batches) <= 2 * capture.BATCH_BYTES
    assert sum(b.num_rows for t in tasks for b in reader.read(t)) == 50_000


def test_a_file_with_one_row_group_is_streamed_too(spark, tmp_path):
    """Captures written before, and by others, may hold a whole file in one row group."""
    folder = f"{tmp_path}/topic/src_partition=3"
    rows = spark.range(0, 30_000, 1, 1).selectExpr("'k' AS key", "repeat(sha2(string(id), 256), 30) AS value", "id AS offset")
    rows.write.parquet(folder)
    reader = capture.CapturedReader({"path": f"{tmp_path}/topic", "position": f"{tmp_path}/p"})
    (task,) = reader.partitions({}, {"3": 30_000})
    before = capture.pa.total_allocated_bytes()
    held, got = 0, []
    for batch in reader.read(task):
        held = max(held, capture.pa.total_allocated_bytes() - before)
        got += batch.column(3).to_pylist()
        assert set(batch.column(2).to_pylist()) == {3}
    assert got == list(range(30_000))
    assert held < 24 << 20
