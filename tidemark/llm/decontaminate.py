"""Find benchmark items inside documents: SimHash windows by Hamming blocks, then an exact check.

An item is in a document if a stretch of the document half as long again as the item has at least the
threshold's share of the item's shingle weight, where a shingle weighs 1 / (number of items that have it).

Candidates come from windows alone.  A window's 64-bit SimHash has bit i set if more than half of its
word shingles have it set in their hashes.  Windows of two kinds stand for an item.  Item-sized ones lie at
its head and tail; their lengths are on a grid of powers of two times 5, the largest that the item allows, so
that a document is hashed for a few lengths only.  Short ones of ``SHORT`` words, three shingles, begin at
every word: those with one of the rarest shingles that together weigh three times what a find may lack.

A find lacks a third of those at most.  If all weigh the same, they are a stretch of the item, and a changed
word takes four shingles or more from it unless near its ends.  The changes then leave so few gaps for
what is still there that one gap at least has three shingles, from 11 words on: that short window is
the same in the document.  With unequal weights there is no such bound, and tests measure that finds are not missed.

Fingerprints within ``RADIUS`` bits differ in at most RADIUS of RADIUS + 1 blocks of bits, so one block
at least is equal: windows are looked up by each block in turn, which finds all fingerprints within the
radius.  Each candidate is checked on the shingles themselves, over all stretches of the document.

Documents stay where they are read; only the items' index moves.  Items are taken in groups of about
``GROUP`` so that an index is never larger than that, however many items there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import materialize

K = 5
SHORT = K + 2
RADIUS = 3
THRESHOLD = 0.8
GROUP = 4096
GRID = [5]
while GRID[-1] < 1_000_000:
    GRID.append(2 * GRID[-1])


def bit_counts(hashes: np.ndarray, k: int, most: int) -> np.ndarray:
    """For each bit, how many of the k-word shingles before each word have it set; right for windows of up to ``most`` shingles."""
    bits = np.unpackbits(words.combine(hashes, k).view(np.uint8).reshape(-1, 8), axis=1)
    # sums may wrap around: differences of two are right as long as a window has fewer than 2**15 shingles
    kind = np.int16 if most < 2**15 else np.int32
    run = np.zeros((len(bits) + 1, 64), dtype=kind)
    np.cumsum(bits, axis=0, dtype=kind, out=run[1:])
    return run


def simhashes(hashes: np.ndarray, length: int, run: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the window of ``length`` words at each word where one fits; ``run`` are the bit counts, if known."""
    k = min(K, length)
    m = length - k + 1
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    if m == 1:
        return words.combine(hashes, k)
    run = bit_counts(hashes, k, m) if run is None else run
    return np.packbits((run[m:] - run[:-m]) > m // 2, axis=1).view(np.uint64).ravel()


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 blocks that make up the 64 bits."""
    edges = np.linspace(0, 64, radius + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]


@dataclass
class Length:
    """The items' fingerprints of one window length, sorted by each block."""

    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    def __post_init__(self) -> None:
        self.sorted = []
        for shift, width in blocks(RADIUS):
            value = (self.prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(value, kind="stable")
            filter_ = np.zeros(1 << min(width, 20), dtype=bool)
            filter_[value & np.uint64(len(filter_) - 1)] = True
            self.sorted.append((np.uint64(shift), np.uint64((1 << width) - 1), value[order], order, filter_))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, fingerprint) pairs within the radius."""
        found_w, found_f = [], []
        for shift, mask, value, order, filter_ in self.sorted:
            own = (prints >> shift) & mask
            at = np.flatnonzero(filter_[own & np.uint64(len(filter_) - 1)])
            lo, hi = np.searchsorted(value, own[at]), np.searchsorted(value, own[at], side="right")
            n = hi - lo
            w = np.repeat(at, n)
            f = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            close = np.bitwise_count(prints[w] ^ self.prints[f]) <= RADIUS
            found_w.append(w[close])
            found_f.append(f[close])
        pairs = np.unique(np.stack([np.concatenate(found_w), np.concatenate(found_f)]), axis=1)
        return pairs[0], pairs[1]


class Index:
    """Fingerprints, shingles and weights of a group of items (id, text)."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, shared: dict[int, int] | None = None):
        """``shared`` is in how many items of the whole table a shingle is, where that is more than one."""
        self.ids: list[int] = []
        self.n_words: list[int] = []
        self.shingles: list[np.ndarray] = []
        self.offsets: list[np.ndarray] = []
        self.threshold = threshold
        self.words: list[np.ndarray] = []
        for row, hashes in words.texts(pa.array([text or "" for _, text in items], pa.string())):
            n = len(hashes)
            if not n:
                continue
            item = len(self.ids)
            self.ids.append(items[row][0])
            self.n_words.append(n)
            own, offset = np.unique(words.combine(hashes, min(K, n)), return_index=True)
            self.shingles.append(own)
            self.offsets.append(offset)
            self.words.append(hashes)
        every, count = np.unique(np.concatenate(self.shingles), return_counts=True) if self.shingles else (np.zeros(0, np.uint64), np.zeros(0))
        if shared is not None:
            count = np.array([shared.get(x, 1) for x in every.tolist()], dtype=np.int64)
        self.every = every
        self.weights = [1.0 / count[np.searchsorted(every, s)] for s in self.shingles]
        self.numbers = [np.searchsorted(every, s) for s in self.shingles]
        self.widths = sorted({min(K, n) for n in self.n_words})
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[every & np.uint64(len(self.filter) - 1)] = True
        made: dict[int, list[tuple[int, int, int]]] = {}
        for item, hashes in enumerate(self.words):
            for length, starts in self._windows(item).items():
                prints = simhashes(hashes, length)
                made.setdefault(length, []).extend((int(prints[s]), item, s) for s in sorted(starts))
        del self.words
        self.lengths = {
            length: Length(np.array([x[0] for x in rows], np.uint64), np.array([x[1] for x in rows]), np.array([x[2] for x in rows]))
            for length, rows in made.items()
        }

    def _windows(self, item: int) -> dict[int, set[int]]:
        """Where the windows that stand for an item begin, by length."""
        n = self.n_words[item]
        short = SHORT if n >= SHORT else min(K, n)
        rare = self._rarest(item)
        own = np.searchsorted(self.shingles[item], words.combine(self.words[item], min(K, n)))
        has = np.lib.stride_tricks.sliding_window_view(rare[own], short - min(K, n) + 1).any(axis=1)
        found = {short: set(np.flatnonzero(has).tolist())}
        whole = max([g for g in GRID if g <= n], default=0)
        if whole > SHORT:
            found[whole] = {0, n - whole}
        return found

    def _rarest(self, item: int) -> np.ndarray:
        """Which shingles of an item are the rarest, and of those the first, that weigh three times what a find may lack."""
        weight = self.weights[item]
        order = np.lexsort((self.offsets[item], -weight))
        rare = np.zeros(len(weight), dtype=bool)
        rare[order[: int(np.searchsorted(np.cumsum(weight[order]), 3 * (1 - self.threshold + 1e-9) * weight.sum(), side="right")) + 1]] = True
        return rare

    def _hits(self, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the shingle) of all items' shingles, in order of place."""
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in self.widths:
            own = words.combine(hashes, k)
            at = np.flatnonzero(self.filter[own & np.uint64(len(self.filter) - 1)])
            number = np.minimum(np.searchsorted(self.every, own[at]), len(self.every) - 1)
            good = (self.every[number] == own[at]) & (at + k <= ends[at])
            places.append(at[good])
            numbers.append(number[good])
        place, number = np.concatenate(places), np.concatenate(numbers)
        order = np.argsort(place, kind="stable")
        return place[order], number[order]

    def _best(self, item: int, place: np.ndarray, number: np.ndarray) -> tuple[float, int] | None:
        """(similarity, where the item would begin) of the best stretch, from the hits of one row; None below the threshold."""
        own, weight, n = self.numbers[item], self.weights[item], self.n_words[item]
        at = np.minimum(np.searchsorted(own, number), len(own) - 1)
        mine = own[at] == number
        place, at = place[mine], at[mine]
        whole = weight.sum()

        def share(lo: int, hi: int) -> float:
            # rounded, so that a share of exactly the threshold does not hang on the order of a sum
            return round(float(weight[np.unique(at[lo:hi])].sum() / whole), 12)

        if share(0, len(at)) < self.threshold:
            return None
        reach = n + 2 * (n // 4) - min(K, n)
        best, lo, total, held = (0.0, 0, 0), 0, 0.0, np.zeros(len(own), np.int64)
        heaviest = 0.0
        for hi in range(len(at)):
            total += weight[at[hi]] if not held[at[hi]] else 0.0
            held[at[hi]] += 1
            while place[hi] - place[lo] > reach:
                held[at[lo]] -= 1
                total -= weight[at[lo]] if not held[at[lo]] else 0.0
                lo += 1
            if total > heaviest + 1e-9 * whole:
                heaviest, best = total, (0.0, lo, hi + 1)
        value = share(*best[1:])
        if value < self.threshold:
            return None
        starts, often = np.unique((place - self.offsets[item][at])[best[1] : best[2]], return_counts=True)
        return value, int(starts[often.argmax()])

    def search(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        """(row, item, similarity, first word) of the best place of each item that reaches the threshold in each row."""
        if not self.ids:
            return
        ends = np.repeat(first[1:], np.diff(first))
        place, number = self._hits(hashes, ends)
        rows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        most = max(self.lengths)
        run = bit_counts(hashes, K, most) if most > K and len(hashes) >= K else None
        for length, index in self.lengths.items():
            window, found = index.near(simhashes(hashes, length, run))
            inside = window + length <= ends[window] if len(window) else np.zeros(0, bool)
            rows.append(np.searchsorted(first, window[inside], side="right") - 1)
            items.append(index.item[found[inside]])
        pairs = np.unique(np.concatenate(rows) * len(self.ids) + np.concatenate(items))
        for row, item in zip((pairs // len(self.ids)).tolist(), (pairs % len(self.ids)).tolist()):
            lo, hi = np.searchsorted(place, first[row : row + 2])
            if best := self._best(item, place[lo:hi], number[lo:hi]):
                yield row, item, best[0], max(0, best[1] - int(first[row]))


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for row, hashes in words.texts(batch.column(1)):
            if len(hashes):
                found.append(np.unique(words.combine(hashes, min(K, len(hashes)))))
                rows.append(np.full(len(found[-1]), row))
        ids = batch.column(0).take(pa.array(np.concatenate(rows)))
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(found).view(np.int64))], ["id", "shingle"])


def _groups(items: DataFrame, id_col: str, text_col: str, group: int, threshold: float) -> Iterator[Index]:
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL")
    n = max(1, math.ceil(rows.count() / group))
    of = lambda i: F.pmod(F.xxhash64("id"), F.lit(n)) == i
    # Weights count items of the whole table, whatever group they are looked for in.
    own = materialize(rows.mapInArrow(_item_shingles, "id long, shingle long"), "item-shingles")
    often = materialize(own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "item-weights")
    for i in range(n):
        part = rows.filter(of(i)).orderBy("id", "text")
        some = own.filter(of(i)).select("shingle").distinct().join(often, "shingle").collect()
        shared = {r["shingle"] % 2**64: r["n"] for r in some}
        yield Index([(r["id"], r["text"]) for r in part.toLocalIterator()], threshold, shared)


def _found_in(column: pa.Array, index: Index) -> Iterator[tuple[int, int, float, int]]:
    data, ends = words.text_bytes(column)
    for lo, hi in words.slices(ends, 1 << 18):
        hashes, first, _ = words.word_hashes(data, ends[lo : hi + 1])
        for row, item, value, start in index.search(hashes, first):
            yield lo + row, item, value, start


def _find(index: Index, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, values, starts = [], [], [], []
            for row, item, value, start in _found_in(batch.column(1), index):
                if value >= threshold:
                    rows.append(row)
                    items.append(item)
                    values.append(value)
                    starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([index.ids[i] for i in items], pa.int64()),
                    pa.array(values, pa.float64()),
                    pa.array(starts, pa.int64()),
                    pa.array([index.n_words[i] for i in items], pa.int64()),
                ],
                ["id", "item_id", "similarity", "first_word", "item_words"],
            )

    return run


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    group: int = GROUP,
) -> DataFrame:
    """One row for each document and item found in it: id, item_id, similarity, first_word, item_words.

    first_word counts the document's words from 0 to where the item would begin.  Null or empty texts
    and items have no finds; an item without an id is not looked for; an item of fewer than 5 words is
    one shingle of all its words; rows that repeat an id each have their own finds; documents with a
    null id have theirs under null.  Without items or documents the result is empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id long, item_id long, similarity double, first_word long, item_words long"
    found = None
    for index in _groups(items, item_id_col, item_text_col, group, threshold):
        part = rows.mapInArrow(_find(index, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def _keep_clean(index: Index, text_at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for row, _, value, _ in _found_in(batch.column(text_at).cast(pa.string()), index):
                keep[row] &= value < threshold
            yield batch.filter(pa.array(keep))

    return run


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    group: int = GROUP,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all columns; null and empty texts stay."""
    for index in _groups(items, item_id_col, item_text_col, group, threshold):
        docs = docs.mapInArrow(_keep_clean(index, docs.columns.index(text_col), threshold), docs.schema)
    return docs
