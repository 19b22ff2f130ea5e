"""Placement of keys by load: shares, splits, and rows that follow the plan."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidemark.functions.numbers import text_hash
from tidemark.operators import placement, skew


def rows_of(spark, counts):
    rows = [(key, f"{key}-{i}") for key, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "k string, e string")


def test_a_hot_key_is_cut_and_loads_are_even(spark):
    rows = rows_of(spark, {"hot": 800, **{f"t{i}": 10 for i in range(20)}})
    placed = placement.plan(rows, "k", 4)
    listed = placed.collect()
    load = Counter()
    for r in listed:
        load[r["owner"]] += r["records"]
    assert sum(load.values()) == 1_000 and max(load.values()) - min(load.values()) <= 20
    assert len({r["owner"] for r in listed if r["item"] == "khot"}) == 4
    hashed = skew.keyed_load(rows, 4, "k").agg(F.max("records")).first()[0]
    assert hashed >= 800 > max(load.values())


def test_rows_follow_the_plan(spark):
    rows = rows_of(spark, {"hot": 4_000, "warm": 500, **{f"t{i}": 3 for i in range(200)}})
    placed = placement.plan(rows, "k", 4, text_hash)
    owned = placement.with_owner(rows, placed, "k", "e", 4, text_hash).collect()
    assert len(owned) == rows.count() and all(0 <= r["owner"] < 4 for r in owned)
    owners = {}
    for r in owned:
        owners.setdefault(r["k"], set()).add(r["owner"])
    # only a key above the fair share has more than one owner
    assert {k for k, o in owners.items() if len(o) > 1} == {"hot"}
    planned = {o: n for o, n in placed.groupBy("owner").agg(F.sum("records")).collect()}
    for owner, n in Counter(r["owner"] for r in owned).items():
        assert abs(n - planned[owner]) < 150


def test_keys_the_plan_does_not_know_and_null_keys(spark):
    rows = rows_of(spark, {"a": 5}).unionByName(spark.createDataFrame([(None, "x"), (None, None)], "k string, e string"))
    placed = placement.plan(rows, "k", 2)
    assert {r["item"] for r in placed.collect()} == {"ka", "null"}
    later = rows.unionByName(rows_of(spark, {"new": 2}))
    owned = placement.with_owner(later, placed, "k", "e", 2).collect()
    assert len(owned) == 9 and all(r["owner"] in (0, 1) for r in owned)
    assert len({r["owner"] for r in owned if r["k"] == "new"}) == 1


def test_empty_table_and_many_keys(spark):
    empty = spark.createDataFrame([], "k string, e string")
    assert placement.plan(empty, "k", 3).count() == 0
    many = spark.range(20_000).selectExpr("concat('k', id) AS k", "'e' AS e")
    assert placement.plan(many, "k", 3).count() <= 33 * 3
