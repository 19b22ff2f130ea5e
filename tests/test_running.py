"""Running aggregates, watermarks and lateness against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lateness
from tidemark.operators import keyed, watermark
from tidemark.operators.prefix import Running, blocked_running, running_number
from tidemark.operators.quantiles import grouped_quantiles
from tidemark.schema import LONG_MIN


def skewed(n: int, seed: int) -> list[tuple[str, int, int]]:
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.7 else f"k{rng.randrange(6)}", t, rng.randrange(1_000)) for t in range(n)]


@pytest.mark.parametrize("block", [1, 7, 100, 10_000])
def test_running_measures_do_not_depend_on_the_block_size(spark, block):
    rows = skewed(500, block)
    df = spark.createDataFrame(rows, "k string, t long, v long")
    out = blocked_running(
        df, ["k"], ["t"], F.expr(f"t div {block}"),
        {
            "total": Running("sum", F.col("v")),
            "top": Running("max", F.col("v")),
            "low_before": Running("min", F.col("v"), include_current=False),
        },
    )
    seen: dict[str, list[int]] = {}
    expected = {}
    for k, t, v in rows:
        before = seen.setdefault(k, [])
        low = min(before) if before else None
        before.append(v)
        expected[t] = (sum(before), max(before), low)
    assert {r["t"]: (r["total"], r["top"], r["low_before"]) for r in out.collect()} == expected


def test_global_numbering_with_gaps(spark):
    df = spark.range(0, 3_000, 7)
    out = running_number(df, [], ["id"], F.expr("id div 50"))
    assert all(r["n"] == r["id"] // 7 + 1 for r in out.collect())


def brute_watermark(arrivals, delay, idle):
    """arrivals: (batch, batch_ms, partition, event_ms)."""
    batches = sorted({(b, ms) for b, ms, _, _ in arrivals})
    out, best, reached, seen = {}, None, {}, {}
    for batch, now in batches:
        active = [reached[p] for p in reached if now - seen[p] <= idle]
        if active:
            low = min(active) - delay
            best = low if best is None else max(best, low)
        out[batch] = best
        for b, ms, p, e in arrivals:
            if b == batch:
                reached[p] = max(reached.get(p, e), e)
                seen[p] = ms
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("idle", [1, 25_000, 30_000, 400_000])
def test_watermark_matches_a_loop(spark, monkeypatch, seed, idle):
    monkeypatch.setattr(watermark, "BATCH_BLOCK", 16)
    rng = random.Random(seed)
    arrivals, now = [], 0
    for step in range(80):
        now += rng.choice([5_000, 10_000, 10_000, 45_000])
        if rng.random() < 0.1:
            continue
        for _ in range(rng.randrange(1, 6)):
            part = 0 if rng.random() < 0.6 else rng.randrange(1, 5)
            arrivals.append((step * 3, now, part, now - rng.randrange(0, 60_000)))
    df = spark.createDataFrame(arrivals, "batch_id long, batch_ms long, src_partition int, event_ms long")
    got = {r["batch_id"]: r["watermark_ms"] for r in watermark.arrival_watermark(df, idle_ms=idle).collect()}
    assert got == brute_watermark(arrivals, 10_000, idle)


@pytest.mark.parametrize(
    ("event", "mark", "expected"),
    [
        (1_000, LONG_MIN, (False, 0)),
        (1_000, None, (False, 0)),
        (2_001, 2_000, (False, 0)),
        (2_000, 2_000, (True, 0)),
        (1_250, 2_000, (True, 750)),
    ],
)
def test_lateness(spark, event, mark, expected):
    df = spark.createDataFrame([(event, mark)], "e long, w long")
    row = df.select(lateness.is_late(F.col("e"), F.col("w")), lateness.lateness_ms(F.col("e"), F.col("w"))).first()
    assert tuple(row) == expected


def test_rejects_offer_time_zero_or_nothing(spark):
    df = spark.createDataFrame([(5, None), (7, "bad")], "ms long, error string")
    zero = df.select(watermark.contributed_time(F.col("ms"), F.col("error"))).collect()
    none = df.select(watermark.contributed_time(F.col("ms"), F.col("error"), ignore_invalid=True)).collect()
    assert [r[0] for r in zero] == [5, 0]
    assert [r[0] for r in none] == [5, None]


def test_salted_counts_equal_plain_counts(spark):
    rows = [("hot" if i % 3 else f"t{i % 5}", f"e{i // 2}") for i in range(2_000)]
    df = spark.createDataFrame(rows, "tenant_id string, event_id string")
    plain = df.groupBy("tenant_id").agg(F.count(F.lit(1)), F.count_distinct("event_id"))
    assert sorted(map(tuple, keyed.salted_counts(df).collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("block", [None, 1, 10, 100_000])
def test_exact_quantiles_match_sorting(spark, block):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.8 else "b", rng.choice([None, rng.randrange(-500, 500)])) for _ in range(900)]
    rows += [("one", 7), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x long")
    out = grouped_quantiles(df, ["g"], {"x": F.col("x")}, mode="exact", count_as="rows", block=block)
    for r in out.collect():
        values = sorted(v for g, v in rows if g == r["g"] and v is not None)
        assert r["rows"] == sum(1 for g, _ in rows if g == r["g"])
        for p in (50, 95, 99):
            if not values:
                assert r[f"x_p{p}"] is None
                continue
            place = p / 100 * (len(values) - 1)
            low = int(place)
            high = min(low + 1, len(values) - 1)
            assert r[f"x_p{p}"] == pytest.approx(values[low] + (values[high] - values[low]) * (place - low), abs=2e-3)
