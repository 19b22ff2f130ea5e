"""File index, mergeable quantile summaries, and repeated sends removed from a stream."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import summaries, validate
from tidemark.plans import registry
from tidemark.sources import capture, file_index, table
from tidemark.streaming import send_dedup
from test_contract import GOOD

SF = "/root/testdata/sf0.001"


def test_a_range_opens_the_files_that_can_hold_it(spark, tmp_path):
    rows = table.stored_form(registry.data.telemetry(spark, SF))
    path = f"{tmp_path}/t"
    table.write_rows(rows.repartitionByRange(6, "event_time"), path)
    index = file_index.build(spark, path)
    held = index.collect()
    assert len(held) == 6 and sum(r["n_rows"] for r in held) == rows.count()
    start, end = datetime(2024, 1, 10), datetime(2024, 1, 11)
    some = file_index.holding(index, start, end)
    assert 1 <= some.count() < 6
    found = file_index.read(spark, path, index, start, end)
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in some.collect()) == sorted(f.rsplit("/", 1)[-1] for f in found.inputFiles())
    want = table.between(table.read_table(spark, path), start, end)
    assert sorted(r["event_id"] for r in found.collect()) == sorted(r["event_id"] for r in want.collect())
    one = file_index.read(spark, path, index, start, end, "tenant-hot")
    assert one.count() == want.filter("tenant_id = 'tenant-hot'").count() > 0
    assert file_index.read(spark, path, index, datetime(1999, 1, 1), datetime(1999, 1, 2)).count() == 0


def test_a_file_without_bounds_is_kept(spark):
    rows = [("a", None, 1, 1, None, None, None, None), ("b", "202401", 1, 1, datetime(2024, 1, 1), datetime(2024, 1, 2), "a", "c")]
    index = spark.createDataFrame(rows, file_index.INDEX)
    found = lambda *a: sorted(r["path"] for r in file_index.holding(index, *a).collect())
    assert found(datetime(2024, 1, 1), datetime(2024, 1, 2)) == ["a", "b"]
    assert found(datetime(2024, 2, 1), datetime(2024, 2, 2)) == ["a"]
    assert found(datetime(2024, 1, 1), datetime(2024, 1, 2), "d") == ["a"]


def test_summaries_merge_to_the_same_as_one(spark):
    rows = spark.range(20_000).select((F.col("id") % 60).alias("minute"), (F.col("id") * 7919 % 10_007).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(99, None), (99, None)], "minute long, v long"))
    stored = summaries.summarize(rows, ["minute"], {"v": F.col("v")})
    merged = summaries.merge(stored, {"span": F.floor(F.col("minute") / 30)}, ["v"])
    found = summaries.quantiles(merged, ["span"], ["v"])
    by_span = {r["span"]: r for r in found.collect()}
    assert {k: r["n_rows"] for k, r in by_span.items()} == {0: 10_010, 1: 9_990, 3: 2}
    assert by_span[3]["v_p50"] is None
    off = summaries.rank_errors(rows.withColumn("span", F.floor(F.col("minute") / 30)), ["span"], "v", F.col("v"), found)
    for r in off.collect():
        assert all(0 <= r[f"v_p{p}_error"] <= summaries.RANK_ERROR for p in (50, 95, 99))
    assert summaries.merge(stored.limit(0), {"span": F.col("minute")}, ["v"]).count() == 0


def test_ties_have_no_rank_error(spark):
    rows = spark.createDataFrame([(1, v) for v in [5] * 90 + [9] * 10], "k int, v long")
    found = summaries.quantiles(summaries.summarize(rows, ["k"], {"v": F.col("v")}), ["k"], ["v"])
    (r,) = found.collect()
    assert (r["v_p50"], r["v_p95"], r["v_p99"]) == (5, 9, 9)
    (e,) = summaries.rank_errors(rows, ["k"], "v", F.col("v"), found).collect()
    assert [e[f"v_p{p}_error"] for p in (50, 95, 99)] == [0, 0, 0]


def test_late_originals_stay_and_replays_go(spark, tmp_path):
    def record(sequence: int, hour: int, run: str = "r"):
        return json.dumps({**GOOD, "producer_run_id": run, "producer_sequence": sequence, "event_time": f"2026-08-23T{hour:02d}:00:00.000Z", "produced_at": f"2026-08-23T{hour:02d}:00:00.000Z"})

    sends = [record(1, 12), record(2, 12), record(1, 12), record(3, 1), record(2, 12), record(3, 1), record(3, 1, "other"), record(4, 0)]
    df = spark.createDataFrame([("k", v, 0, i) for i, v in enumerate(sends)], "key string, value string, src_partition int, offset long")
    for part in (F.col("offset") < 3, F.col("offset") >= 3):
        capture.write_capture(df.filter(part), f"{tmp_path}/topic")
        stream = capture.captured_topic(spark, f"{tmp_path}/topic", f"{tmp_path}/position")
        once = send_dedup.distinct_sends(validate.valid_rows(validate.validate(stream), "offset"))
        query = once.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c")
        query.trigger(availableNow=True).start().awaitTermination(60)
    assert sorted(r["offset"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 3, 6, 7]
