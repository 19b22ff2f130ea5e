"""Cases that once went wrong: rows made for far copies of one text, clashing names, weights by group, discounts."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import passage

from tidemark.llm import decontaminate, exact_dedup, kneser_ney, sampling, setsketch, warc


@pytest.mark.parametrize("m", [60, 120])
def test_copies_too_far_apart_are_not_paired_out(spark, monkeypatch, m):
    rng = random.Random(m)
    base = passage(8, 110).split()
    rows = []
    for i in range(m):
        own = list(base)
        for at in rng.sample(range(110), 2):
            own[at] = f"new{i}x{at}"
        rows.append((i, " ".join(own)))
    made = []
    plain = setsketch.links_of

    def counted(pairs, *rest):
        made.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(setsketch, "links_of", counted)
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.groups(rows, 5)
    assert sum(made) <= 12 * m


def test_parity_never_says_more_than_the_difference():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for _ in range(50):
        one = np.unique(rng.integers(0, 2**63, size=200).astype(np.uint64))
        two = np.unique(np.concatenate([one[: rng.integers(1, 200)], rng.integers(0, 2**63, size=rng.integers(1, 80)).astype(np.uint64)]))
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([one.tobytes(), two.tobytes()], pa.binary())], ["id", "members"])
        (made,) = setsketch._parity([batch])
        a, b = (np.array([c[i].as_py() for c in made.columns[1:]], np.int64) for i in (0, 1))
        assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= len(np.setxor1d(one, two))


def test_exact_copies_with_clashing_columns(spark):
    rows = [(1, "a", 7, "x", 9, "r"), (2, "a", 8, "y", 9, "s"), (2, "a", 8, "y", 9, "s"), (3, "b", 5, "z", 9, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _digest string, _n int, _row string")
    got = exact_dedup.drop_copies(df)
    assert got.schema == df.schema
    assert sorted(tuple(r) for r in got.collect()) == [rows[1], rows[3]]


def test_weights_do_not_depend_on_groups(spark):
    items = [(i, " ".join([*passage(1, 12).split(), *passage(100 + i, 10 + i).split()])) for i in range(12)]
    docs = [(i, " ".join(w if j % 9 else "x" for j, w in enumerate(t.split()[: 8 + 2 * i]))) for i, t in items] + [(50 + i, t) for i, t in items]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, all_ = (sorted(map(tuple, decontaminate.contaminated(a, b, group=g).collect())) for g in (1, 4096))
    assert one == all_ and {r[0] for r in one} >= {50 + i for i in range(12)}


@pytest.mark.parametrize("counts", [(1000, 5, 1, 0), (10, 400, 3, 1), (4, 1, 300, 900), (7, 0, 0, 0), (0, 3, 2, 1)])
def test_discounts_stay_within_their_counts(counts):
    d = kneser_ney.discounts(np.array(counts))
    assert all(0 <= v <= i for i, v in enumerate(d.tolist()))
    if counts == (1000, 5, 1, 0):
        y = 1000 / 1010
        assert d.tolist() == pytest.approx([0, y, 2 - 3 * y / 5, 3])


def test_equal_texts_with_both_labels_count_as_labelled(spark):
    docs = spark.createDataFrame([(i, "same") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 39)) for i in range(40)], "doc_id long, toxic int")
    kept = [i for i in range(40) if brute.remainder(i, 5)]
    got = sampling.labelled(docs, labels, "toxic", "doc_id", "text").collect()
    assert [tuple(r) for r in got] == [("same", int(39 in kept))]


def test_archives_are_dealt_by_their_bytes(spark):
    manifest = spark.createDataFrame([(f"f{i}", "t", warc.TASK_BYTES // 2) for i in range(9)], "name string, temporary string, bytes long")
    assert warc._spread(manifest).rdd.getNumPartitions() == 5
    assert warc._spread(manifest.limit(0)).count() == 0
