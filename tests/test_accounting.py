"""Delivery accounting, retries, skew evidence, settings and scalar helpers on small tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import PipelineConfig
from tidemark.config import strict_flag
from tidemark.functions import text
from tidemark.functions.numbers import is_decimal_milestone, is_finite
from tidemark.operators import delivery, logs, metrics, skew


@pytest.fixture(scope="module")
def log(spark):
    attempts = spark.createDataFrame(
        [("r", 1, "a", 100, 1_000), ("r", 2, "b", 110, 1_000), ("r", 3, "c", 120, 1_000), ("r", 4, "d", 130, 1_000)],
        "run_id string, producer_sequence long, event_id string, payload_bytes long, enqueued_ms long",
    )
    callbacks = spark.createDataFrame(
        [("r", 1, 1, 8, 1_004, False, 7), ("r", 2, 1, 5, 1_008, False, 3), ("r", 3, None, None, None, True, 0)],
        "run_id string, producer_sequence long, partition int, offset long, acked_ms long, failed boolean, tx_retries long",
    )
    return delivery.delivery_log(attempts, callbacks)


def test_delivery_summary(log):
    row = delivery.delivery_summary(log).first()
    assert (row["attempted"], row["attempted_bytes"]) == (4, 460)
    assert (row["acked"], row["failed"], row["undelivered"], row["pending"]) == (2, 1, 1, 0)
    assert (row["ack_latency_avg_ms"], row["ack_latency_max_ms"], row["tx_retries"]) == (6.0, 8.0, 7)
    assert row["reconciled"] is True
    gates = delivery.run_gates(delivery.delivery_summary(log)).first()
    assert (gates["fully_acked"], gates["succeeded"]) == (False, False)


def test_sends_without_callback_are_pending_until_their_run_is_flushed(spark):
    sent = [(run, n, "e", 10, 1_000 + n) for run in "abc" for n in (1, 2, 3)]
    attempts = spark.createDataFrame(
        sent, "run_id string, producer_sequence long, event_id string, payload_bytes long, enqueued_ms long"
    )
    callbacks = spark.createDataFrame(
        [(run, 1, 0, 5, 1_009, False, 0) for run in "abc"],
        "run_id string, producer_sequence long, partition int, offset long, acked_ms long, failed boolean, tx_retries long",
    )
    flushes = spark.createDataFrame([("a", 1_003), ("b", 1_002)], "run_id string, flushed_ms long")
    summary = delivery.delivery_summary(delivery.delivery_log(attempts, callbacks, flushes))
    got = {r["run_id"]: (r["acked"], r["undelivered"], r["pending"], r["reconciled"]) for r in summary.collect()}
    assert got == {"a": (1, 2, 0, True), "b": (1, 1, 1, False), "c": (1, 0, 2, False)}
    gates = {r["run_id"]: (r["fully_acked"], r["succeeded"]) for r in delivery.run_gates(summary).collect()}
    assert gates == {"a": (False, False), "b": (False, False), "c": (False, True)}


def test_partition_maps(log):
    row = delivery.partition_maps(delivery.partition_distribution(log)).first()
    assert row["partition_counts"] == {"1": 2}
    assert row["offset_ranges"]["1"].asDict() == {"min": 5, "max": 8}


def test_interval_rates(spark):
    one = spark.createDataFrame(
        [("r", 0, 1, "acked")], "run_id string, enqueued_ms long, acked_ms long, status string"
    )
    row = delivery.interval_throughput(one).first()
    assert (row["interval_attempted"], row["attempted_per_second"], row["acked_per_second"]) == (1, 0.2, 0.2)


@pytest.mark.parametrize(
    ("statistics", "expected"),
    [
        ('{"brokers":{"a":{"txretries":3},"b":{"txretries":4}}}', 7),
        ('{"txretries":5,"brokers":{"a":{"txretries":3}}}', 5),
        ('{"txretries":2.9}', 2),
        ('{"txretries":-4}', 0),
        ('{"txretries":true,"brokers":{"a":{"txretries":3},"b":7,"c":{"txretries":false}}}', 3),
        ('{"brokers":[1]}', 0),
        ("{}", 0),
        ("not json", None),
        ("[3]", None),
    ],
)
def test_tx_retries(spark, statistics, expected):
    df = spark.createDataFrame([(statistics,)], "statistics string")
    assert delivery.tx_retries(df).first()["tx_retries"] == expected


def evidence(spark, keyed, hot, local, remote):
    rows = [("s", kind, sub, float(v)) for kind, values in zip(skew.EVIDENCE, (keyed, hot, local, remote)) for sub, v in values.items()]
    df = spark.createDataFrame(rows, "scope string, reading string, subtask int, value double")
    return skew.verification_errors(skew.evidence_maps(df, "scope")).first()["errors"]


ZERO = dict.fromkeys(range(4), 0)


def test_evidence_that_holds(spark):
    keyed = {0: 100, 1: 120, 2: 9_500, 3: 110}
    assert evidence(spark, keyed, {**ZERO, 2: 9_500}, {0: 100, 1: 120, 2: 999, 3: 110}, ZERO) == []


def test_owner_and_remote_errors(spark):
    errors = evidence(
        spark, dict.fromkeys(range(4), 100), {0: 1, 1: 0, 2: 2, 3: 0}, {0: 100, 1: 120, 2: 999, 3: 110}, {**ZERO, 2: 7}
    )
    assert errors == [
        "expected exactly one positive tenant-hot state gauge, found 2 (['0', '2'])",
        "expected the tenant-hot owner to process a majority of records; "
        "found {'0': 100.0, '1': 100.0, '2': 100.0, '3': 100.0}",
        "recent remote shuffle rates are not zero: {'2': 7.0}",
    ]


def test_complete_error_order(spark):
    expected = "['0', '1', '2', '3']"
    assert evidence(spark, {0: 25}, {2: 1, 3: 1}, {0: 0}, {0: 7}) == [
        f"lab_keyed_records subtasks are ['0'], expected {expected}",
        f"lab_hot_tenant_state_count subtasks are ['2', '3'], expected {expected}",
        f"local recent shuffle subtasks are ['0'], expected {expected}",
        f"remote recent shuffle subtasks are ['0'], expected {expected}",
        "expected exactly one positive tenant-hot state gauge, found 2 (['2', '3'])",
        "expected the tenant-hot owner to process a majority of records; found {'0': 25.0}",
        "recent local shuffle rates contain no positive byte rate",
        "recent remote shuffle rates are not zero: {'0': 7.0}",
    ]


def test_strict_flag():
    assert strict_flag("true", "x") is True and strict_flag("false", "x") is False
    for bad in ("True", "1", "yes", ""):
        with pytest.raises(ValueError, match="must be exactly 'true' or 'false'"):
            strict_flag(bad, "x")
    assert PipelineConfig.from_settings({}).tenant_state is False


def test_strict_flag_column(spark):
    df = spark.createDataFrame([("true",), ("false",)], "t string")
    assert [r[0] for r in df.select(text.strict_flag(F.col("t"), "x")).collect()] == [True, False]
    with pytest.raises(Exception, match="x must be exactly 'true' or 'false'"):
        spark.createDataFrame([("TRUE",)], "t string").select(text.strict_flag(F.col("t"), "x")).collect()


@pytest.mark.parametrize(
    "bad", [{"parallelism": 0}, {"out_of_order_ms": -1}, {"idle_ms": 0}, {"preview_rate": 1.5}, {"jdbc_batch_size": 0}]
)
def test_config_domains(bad):
    with pytest.raises(ValueError):
        PipelineConfig(**bad)


def test_milestones_and_finite(spark):
    df = spark.createDataFrame([(0,), (1,), (10,), (11,), (1_000,), (-1,)], "n long")
    assert [r[0] for r in df.select(is_decimal_milestone(F.col("n"))).collect()] == [False, True, True, False, True, False]
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in df.select(is_finite(F.col("x"))).collect()] == [True, False, False, False]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a\r\nb c\x0bd  ",), ("y" * 256,), ("z" * 257,)], "t string")
    got = [r[0] for r in df.select(text.bounded_detail(F.col("t"))).collect()]
    assert got == ["a b c d", "y" * 256, "z" * 253 + "..."]
    note = "Savepoint completed. Path: file:/a;\nSAVEPOINT completed.\n Path: file:/b.,\"'"
    df = spark.createDataFrame([(note,), ("nothing",)], "t string")
    assert [r[0] for r in df.select(text.last_savepoint_path(F.col("t"))).collect()] == ["file:/b", None]


def samples(spark, rows, name="c", labels=None):
    data = [(datetime(2024, 1, 1, 0, 0, s), name, labels or {"subtask_index": "0"}, float(v)) for s, v in rows]
    return spark.createDataFrame(data, "ts timestamp, name string, labels map<string,string>, value double")


def test_counter_reset_counts_from_zero(spark):
    row = metrics.counter_change(samples(spark, [(0, 10), (5, 14), (10, 3), (15, 5)]), 30).first()
    assert (row["increase"], row["rate"]) == (9.0, 0.3)


@pytest.mark.parametrize("seconds", [5, 10, 20])
def test_no_step_is_lost_between_windows(spark, seconds):
    """Also where a window holds one sample, and where the series crosses blocks of time."""
    one = samples(spark, [(s, s * s) for s in range(0, 60, 5)])
    assert metrics.counter_change(one, seconds).agg(F.sum("increase")).first()[0] == 55 * 55
    stepped = metrics.with_previous(one, block_seconds=15)
    assert sorted((r["ts"].second, r["previous"]) for r in stepped.collect() if r["previous"] is not None) == [
        (s, float((s - 5) ** 2)) for s in range(5, 60, 5)
    ]


def test_sliding_ranges_look_back_from_each_moment(spark):
    rows = metrics.max_over_time(samples(spark, [(3, 7), (20, 5), (31, 1)]), 20, every=10).collect()
    assert sorted((r["at"].second, r["max_value"]) for r in rows) == [(10, 7.0), (20, 7.0), (30, 5.0), (40, 1.0), (50, 1.0)]
    summed = metrics.rate_by(samples(spark, [(0, 0), (10, 10)]).unionByName(samples(spark, [(0, 5), (10, 25)], labels={"subtask_index": "1"})), [], 10)
    assert [r["sum_rate"] for r in summed.collect()] == [3.0]


def test_slope_of_a_line(spark):
    assert metrics.slope(samples(spark, [(0, 1), (10, 21), (20, 41)])).first()["slope"] == 2.0


def test_alert_needs_an_unbroken_hold(spark):
    values = [(0, 0), (5, 0), (10, 1), (15, 0), (20, 0), (25, 0), (30, 0), (35, 0)]
    for block in (7, 86_400):
        rows = metrics.alerts_held(samples(spark, values, "up"), F.col("value") == 0, 20, block).collect()
        assert [(r["active_from"].second, r["fires_at"].second, r["active_to"].second, r["samples"]) for r in rows] == [(15, 35, 35, 5)]


def test_silence_ends_a_hold(spark):
    rows = [(datetime(2024, 1, d, 0, 0, s), "up", {"job": "a"}, 0.0) for d in (1, 2) for s in (0, 25)]
    df = spark.createDataFrame(rows, "ts timestamp, name string, labels map<string,string>, value double")
    held = metrics.alerts_held(df, F.col("value") == 0, 20).collect()
    assert sorted((r["active_from"].day, r["active_to"].day, r["samples"]) for r in held) == [(1, 1, 2), (2, 2, 2)]


def test_rates_are_not_rounded(spark):
    log = spark.range(200_000).selectExpr(
        "'r' AS run_id", "id AS producer_sequence", "'e' AS event_id", "0 AS partition", "id AS offset", "'acked' AS status", "1 AS latency_ms"
    )
    small = delivery.delivery_trace(log, 0.00025, "t").count()
    assert 20 <= small <= 90 and delivery.delivery_trace(log, 0.00005, "t").count() > 0


def test_log_search_reads_escaped_values(spark):
    written = [r'{"message":"say \"hi\"","level":"INFO"}', r'{"message":"caf\u00e9"}', '{"message":"café"}']
    df = spark.createDataFrame([("s", t) for t in written], "service string, raw string")
    assert logs.search(df, message='say "hi"').count() == 1
    assert logs.search(df, message="café").count() == 2


def test_number_text_has_no_exponent(spark):
    df = spark.createDataFrame([(100.0,), (12345678.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(skew.number_text(F.col("x"))).collect()] == ["100.0", "12345678.0", "0.5"]


def test_instant_vector_drops_non_finite_and_unlabelled(spark):
    a = samples(spark, [(0, 1), (5, 2)], labels={"subtask_index": "0"})
    b = samples(spark, [(0, 1), (5, float("nan"))], labels={"subtask_index": "1"})
    c = samples(spark, [(0, 1)], labels={"job": "x"})
    rows = metrics.instant_vector(a.unionByName(b).unionByName(c), "c").collect()
    assert [(r["subtask"], r["value"]) for r in rows] == [("0", 2.0)]
    assert metrics.sum_or_zero(metrics.select_series(a, "nothing.*")).first()["total"] == 0.0


def test_log_lines(spark):
    raw = [
        ('{"event":"producer_final","producer_run_id":"r","attempted":5,"acked":4,"failed":1,"undelivered":0,"reconciled":true}', 1),
        ('{"event":"producer_final","producer_run_id":"r","attempted":5,"acked":5,"failed":0,"undelivered":0,"reconciled":true}', 2),
        ("plain", 3),
        ('{"event":"other"} trailing', 4),
        ('["a"]', 5),
    ]
    df = spark.createDataFrame([("s", t, n) for t, n in raw], "service string, raw string, n int")
    assert logs.parse_lines(df).count() == 2
    row = logs.final_run_log(df, "n").first()
    assert (row["acked"], row["gate"]) == (5, True)
    encoded = logs.encode_lines(spark.createDataFrame([("x", 1)], "level string, attempted int"), ["level", "attempted"])
    assert encoded.first()["raw"] == '{"attempted":1,"level":"x"}'
