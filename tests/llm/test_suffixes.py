"""Sorted suffixes: segments over ranges, and the passages of the registered query in both directions."""

from __future__ import annotations

import collections

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, suffixes

WIDTH = 4


def segments(ranges: list[list[tuple[int, ...]]], batch: int) -> list[list[int]]:
    """The segment names of all rows, as the operator makes them from ranges read in batches."""
    names, edges = [], []
    for part, rows in enumerate(ranges):
        if not rows:
            continue
        found = suffixes.Segments(part, WIDTH)
        for at in range(0, len(rows), batch):
            names += found.add(np.array(rows[at : at + batch], np.uint64)).tolist()
        edges.append((part, found.first, found.last, found.open))
    over = dict(suffixes.carried(edges))
    own = lambda name: ((-name - 1) >> 6) << suffixes._ROW_BITS
    return [[over.get(x, own(x)) if x < 0 else x for x in row] for row in names]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(*[st.integers(0, 2)] * WIDTH), min_size=1, max_size=40),
    st.lists(st.integers(0, 40), max_size=6),
    st.integers(1, 7),
)
def test_rows_share_a_segment_exactly_if_they_begin_alike(rows, cuts, batch):
    rows = sorted(rows)
    edges = [0, *sorted(min(c, len(rows)) for c in cuts), len(rows)]
    names = segments([rows[a:b] for a, b in zip(edges, edges[1:])], batch)
    for length in range(WIDTH + 1):
        by_name, by_words = collections.defaultdict(set), collections.defaultdict(set)
        for i, row in enumerate(rows):
            by_name[names[i][length]].add(i)
            by_words[row[:length]].add(i)
        assert sorted(map(sorted, by_name.values())) == sorted(map(sorted, by_words.values()))


def plain(rows: list[tuple[int, str | None]], n: int = 50) -> tuple[dict[int, set[int]], dict[int, set[int]]]:
    """Words in kept passages and in those that are not, from all runs of ``n`` words."""
    where = collections.defaultdict(list)
    for i, text in rows:
        found = brute.words(text)
        for at in range(len(found) - n + 1):
            where[tuple(found[at : at + n])].append((i, at))
    kept, later = collections.defaultdict(set), collections.defaultdict(set)
    for places in where.values():
        least = min(i for i, _ in places)
        for i, at in places:
            if len({j for j, _ in places}) > 1 or any(abs(at - other) >= n for _, other in places):
                (kept if i == least else later)[i].update(range(at, at + n))
    return dict(kept), dict(later)


def test_registered_query_finds_these_passages_and_no_others(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    have = {True: collections.defaultdict(set), False: collections.defaultdict(set)}
    for r in queries.QUERIES["op8_suffix_array_dedup"].build(spark, sf).collect():
        have[r["kept"]][r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert (dict(have[True]), dict(have[False])) == plain(rows)
