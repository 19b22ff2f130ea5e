"""Committed batches: bounded files, retries, no half batch, replays that replace."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import PipelineConfig
from tidemark.operators import dlq
from tidemark.schema import TABLE_SCHEMA
from tidemark.sources import capture
from tidemark.streaming import committed, sinks
from tidemark.streaming.pipeline import Paths, drain, open_capture, start_pipeline
from test_contract import GOOD


@pytest.fixture(autouse=True)
def known(spark):
    committed.enable(spark)


def put(rows, path, batch_id, max_rows=1_000, retries=0):
    committed.write_batch(rows, path, batch_id, max_rows, 60_000, retries)


def test_files_are_of_bounded_size(spark, tmp_path):
    put(spark.range(0, 95, 1, 2), f"{tmp_path}/t", 0, max_rows=10)
    listed = committed.commits(spark, f"{tmp_path}/t").collect()
    assert sorted(r["n_rows"] for r in listed) == [7, 8, *[10] * 8] and {r["batch_id"] for r in listed} == {0}
    got = committed.read_committed(spark, f"{tmp_path}/t", "id long")
    assert sorted(r["id"] for r in got.collect()) == list(range(95))


def test_rows_that_waited_long_enough_are_closed():
    now = iter([0.0, 0.0, 0.5, 1.0, 1.0, 1.2, 2.5, 2.5, 2.6]).__next__
    batches = [pa.record_batch({"a": [i]}) for i in range(5)]
    assert [t.num_rows for t in committed.chunks(iter(batches), 100, 1_000, now)] == [2, 2, 1]
    assert list(committed.chunks(iter([]), 10, 10)) == []


def test_a_task_holds_a_bounded_number_of_bytes():
    batches = [pa.record_batch({"a": ["x" * 1_000] * 100}) for _ in range(10)]
    tables = list(committed.chunks(iter(batches), 1_000_000, 60_000, max_bytes=250_000))
    assert [t.num_rows for t in tables] == [300, 300, 300, 100]
    wide = [pa.record_batch({"a": ["x" * (1 << 20)] * 8}) for _ in range(10)]
    assert max(t.nbytes for t in committed.chunks(iter(wide), 1_000_000, 60_000)) < committed.FILE_BYTES + (9 << 20)


def test_a_replay_replaces_the_batch(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark.range(10), path, 0)
    put(spark.range(10, 20), path, 1)
    put(spark.range(10, 15), path, 1)
    assert sorted(r["id"] for r in committed.read_committed(spark, path, "id long").collect()) == list(range(15))
    assert committed.commits(spark, path).agg(F.sum("n_rows")).first()[0] == 15


def test_a_failed_task_leaves_no_half_batch(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark.range(5), path, 0)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        put(broken, path, 1, max_rows=3)
    assert sorted(r["id"] for r in committed.read_committed(spark, path, "id long").collect()) == list(range(5))
    put(spark.range(5, 9), path, 1)
    assert committed.read_committed(spark, path, "id long").count() == 9


def test_nothing_committed(spark, tmp_path):
    assert committed.read_committed(spark, f"{tmp_path}/none", "id long").collect() == []
    assert committed.commits(spark, f"{tmp_path}/none").collect() == []
    put(spark.range(0), f"{tmp_path}/t", 0)
    assert committed.read_committed(spark, f"{tmp_path}/t", "id long").count() == 0


def test_retries():
    calls = []

    def work(times):
        def run():
            calls.append(1)
            if len(calls) <= times:
                raise OSError("busy")

        return run

    committed.with_retries(work(2), 2, pause_s=0)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(OSError, match="busy"):
        committed.with_retries(work(9), 2, pause_s=0)
    assert len(calls) == 3
    assert PipelineConfig.from_settings({"sink_retries": "7", "sink_rows": "10"}).sink_retries == 7
    for bad in ({"sink_retries": -1}, {"sink_rows": 0}, {"sink_interval_ms": 0}):
        with pytest.raises(ValueError):
            PipelineConfig(**bad)


def test_crash_between_rows_and_dead_letters(spark, tmp_path):
    """The rows of a batch are committed, its dead letters fail, and the batch runs again."""
    rows = [("k", json.dumps({**GOOD, "event_id": f"e{i}"}) if i % 5 else "broken", 0, i) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, value string, src_partition int, offset long")
    capture.write_capture(df, f"{tmp_path}/topic")
    paths, config = Paths(f"{tmp_path}/job"), PipelineConfig(trigger="0 seconds", max_offsets_per_trigger=15, preview_rate=1.0)
    good = sinks.committed_dlq_sink(paths.dead_letters, config)

    def failing(envelopes, batch_id):
        if batch_id == 1:
            raise RuntimeError("no dead letters today")
        good(envelopes, batch_id)

    def start(letters):
        stream = open_capture(spark, f"{tmp_path}/topic", paths, config)
        return start_pipeline(spark, stream, paths, config, sinks.committed_table_sink(paths.table, config), letters)

    with pytest.raises(Exception, match="no dead letters today"):
        start(failing).processAllAvailable()
    drain(start(good))
    stored = committed.read_committed(spark, paths.table, TABLE_SCHEMA)
    letters = dlq.decoded(committed.read_committed(spark, paths.dead_letters, "value string"))
    assert sorted(r["event_id"] for r in stored.collect()) == sorted(f"e{i}" for i in range(40) if i % 5)
    assert letters.count() == 8
    # The first attempt's files are there, and no commit names them.
    files = [f for f in os.listdir(f"{paths.table}/data") if f.endswith(".parquet")]
    assert len(files) > committed.commits(spark, paths.table).count()
    previews = spark.read.json(paths.previews)
    assert sorted(r["position"] for r in previews.collect()) == [i * 65_536 for i in range(0, 40, 5)]
