"""Importance resampling against plain counting, for runs of one to three words."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import pytest
from conftest import awkward, passage

from tidemark.llm import bytewords, resampling

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_features(text: str | None, n: int) -> list[int]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, lower)
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n, buckets, share=(10, 100), least=20):
    own = [[f % buckets for f in plain_features(t, n)] for _, t in docs]
    s = collections.Counter(b for d in own for b in d)
    t = collections.Counter(f % buckets for x in target for f in plain_features(x, n))
    ss, tt = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    out = []
    for (i, text), d in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in d)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(d), weight, score, None, len(plain_features(text, 1))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(able[: share[0] * len(able) // share[1]], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize(("n", "buckets", "share"), [(1, 10_000, (10, 100)), (3, 97, (100, 100)), (2, 10_000, (1, 3))])
def test_against_plain(spark, n, buckets, share):
    docs = [*awkward(), *[(100 + i, passage(i % 9, 15 + i)) for i in range(60)], *[(None, passage(2, 30))] * 5]
    target = [passage(3, 80), None, "", "Été2 x_y"]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, rank int, id string, score int")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, aim, n=n, buckets=buckets, share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target, n, buckets, share)


def test_no_rows(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, passage(1, 30)), (2, None)], "doc_id long, text string")
    assert resampling.resample(nothing, some).collect() == []
    got = sorted(tuple(r) for r in resampling.resample(some, nothing, share=(100, 100)).collect())
    assert [(r[0], r[1], r[4]) for r in got] == [(1, 30, 1), (2, 0, None)]


def test_ranks_over_many_ranges(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.scratch import Scratch

    rows = spark.range(5_000).select((F.col("id") % 7).alias("a"), "id")
    got = resampling.ranked(rows, [F.col("a").desc(), F.col("id")], Scratch(spark, "t")).collect()
    want = sorted((-(i % 7), i) for i in range(5_000))
    assert [(-r["a"], r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5_001))


@pytest.mark.parametrize("size", [1, 7, 40])
def test_pieces_hold_each_run_once(size):
    text = b"Aa bb  ccc\td-e " + b"z" * 90 + b" f g"
    by = resampling.WORDS
    whole = text.translate(by).split()
    seen = []
    for words, old in bytewords.pieces(text, by, 2, size):
        seen += [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        assert len(words) > old
    assert seen == [tuple(whole[i : i + 3]) for i in range(len(whole) - 2)]
