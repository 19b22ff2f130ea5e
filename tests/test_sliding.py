"""Overlapping ranges compared with a plain loop over samples and moments."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.operators.sliding import Measure, over_ranges

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def samples(seed: int, n: int = 160, span: int = 900):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        # whole seconds too, so that samples fall on the edges of ranges
        at = rnd.choice([rnd.randrange(span) * 1_000_000, rnd.randrange(span * 1_000_000), 300_000_000])
        rows.append((rnd.choice("ab"), START + timedelta(microseconds=at), float(rnd.randrange(-50, 50))))
    return rows


def plain(rows, seconds, every):
    """{(key, moment): values of the range}."""
    found = {}
    for key, ts, value in rows:
        micros = round((ts - START).total_seconds() * 1e6) + int(START.timestamp()) * 1_000_000
        at = -(-micros // (every * 1_000_000)) * every
        while at * 1_000_000 < micros + seconds * 1_000_000:
            found.setdefault((key, at), []).append((micros / 1e6, value))
            at += every
    return found


@pytest.mark.parametrize("seconds,every", [(60, 15), (60, 60), (50, 20), (15, 60), (45, 10), (7, 3)])
def test_sums_and_maxima_equal_a_plain_loop(spark, seconds, every):
    rows = samples(seconds * 100 + every)
    want = {k: (len(v), sum(x for _, x in v), max(x for _, x in v)) for k, v in plain(rows, seconds, every).items()}
    measures = {
        "n": Measure("sum", F.lit(1).cast("long")), "total": Measure("sum", F.col("v")), "top": Measure("max", F.col("v"))
    }
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    found = over_ranges(df, ["k"], measures, seconds, every).select("k", F.unix_seconds("at").alias("at"), "n", "total", "top").collect()
    got = {(r["k"], r["at"]): (r["n"], r["total"], r["top"]) for r in found}
    assert len(found) == len(got) and got == want


def test_null_keys_and_times_and_empty_tables(spark):
    schema = "k string, ts timestamp, v double"
    measures = {"total": Measure("sum", F.col("v"))}
    rows = [(None, START, None), (None, None, 2.0), ("a", START + timedelta(seconds=1), 3.0)]
    got = over_ranges(spark.createDataFrame(rows, schema), ["k"], measures, 10, 10).collect()
    epoch = int(START.timestamp())
    assert sorted((r["k"] or "", int(r["at"].replace(tzinfo=timezone.utc).timestamp()) - epoch, r["total"]) for r in got) == [
        ("", 0, None), ("a", 10, 3.0)
    ]
    assert over_ranges(spark.createDataFrame([], schema), ["k"], measures, 10, 5).count() == 0


@pytest.mark.parametrize("seconds,every", [(120, 30), (50, 20)])
def test_slope_over_sliding_ranges(spark, seconds, every):
    rows = samples(7)
    want = {}
    for key, points in plain(rows, seconds, every).items():
        if len(points) > 1:
            mx, my = (sum(p[i] for p in points) / len(points) for i in (0, 1))
            spread = sum((x - mx) ** 2 for x, _ in points)
            want[key] = sum((x - mx) * (y - my) for x, y in points) / spread if spread > 1e-9 else None
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double").select(
        F.lit("m").alias("name"), F.create_map(F.lit("k"), F.col("k")).alias("labels"), "ts", "value"
    )
    found = metrics.slope(df, seconds, every).select("labels_key", F.unix_seconds("at").alias("at"), "slope").collect()
    got = {(r["labels_key"][2:], r["at"]): r["slope"] for r in found}
    assert got.keys() == want.keys()
    for key, slope in want.items():
        assert got[key] == (None if slope is None else pytest.approx(slope, abs=2e-6))


def test_samples_are_not_copied_for_every_range(spark):
    df = spark.createDataFrame(samples(1), "k string, ts timestamp, v double")
    plan = over_ranges(df, ["k"], {"top": Measure("max", F.col("v"))}, 900, 5)._jdf.queryExecution().toString()
    explodes = [line for line in plan.splitlines() if "Generate explode" in line]
    # only places of moments are listed, and from rows of one per block
    assert explodes and not any("#v" in line or "top" in line for line in explodes)
