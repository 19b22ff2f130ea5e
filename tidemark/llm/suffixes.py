"""Passages that repeat, by sparse suffix arrays.

Of every window of ``WINDOW`` consecutive runs of ``RUN`` words the run with the smallest hash is an
anchor.  Which one it is depends on the words of the window alone, so two copies of a passage of
RUN + WINDOW - 1 = 50 words have an anchor at the same place.  Each 50-word window of a text belongs to
one anchor, about twenty windows to each.  Only anchors whose run occurs more than once go on.

Anchors with the same words over all their windows are one context, and a context is all that is kept of
them: its smallest place, its largest place in the same document, and its largest id.  A run with one
context needs no more.

Where a run has several, the suffix that begins at one anchor of each context is retained.  Suffixes are
sorted by their words in ranges, and each is compared with its neighbour in that order.  Rows whose
neighbours have n words in common are a segment of length n, whose first row names it; where a range ends
within one, its name is carried over the edge.  The words before the anchors, read backwards, are
sorted and compared in the same way.  A match at the anchor is then extended to both sides: two contexts
have the window of l words to the left and 50 - l to the right in common exactly if they are in one
segment of length 50 - l of the first order and in one of length l of the second.  Nothing limits how
many partners a segment has, and no pairs are made.

What is known of a window then goes back to all anchors of its context, and windows that overlap or touch
are merged into passages of any length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words
from tidemark.llm.scratch import Scratch

RUN = 12
WINDOW = 39
LEAST = RUN + WINDOW - 1
BEFORE = WINDOW - 1
_ROWS = 4096
_ANCHOR = "run long, context long, id long, body long, place int, lo int, hi int"
_SUFFIX = "context long, lo int, hi int, onward binary, backward binary"
_SEGMENTS = "context long, starts array<long>, part long, first binary, last binary"
# A segment is named by its first row: the range in the high bits, the row in the low ones.
_ROW_BITS = 40


def chosen(runs: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor's place of each window of a text, from its run hashes."""
    if len(runs) < window:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(runs, window)
    return np.concatenate([at + i + view[at : at + _ROWS].argmin(axis=1) for at in range(0, len(view), _ROWS) for i in [np.arange(min(_ROWS, len(view) - at))]])


def anchors(hashes: np.ndarray, run: int = RUN, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and run hashes of a text's anchors; a text of fewer than run + window - 1 words has none."""
    runs = words.combine(hashes, run)
    places = np.unique(chosen(runs, window))
    return places, runs[places]


def _contexts(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Run, context, place, and first and last window (counted from the place) of each anchor of a text."""
    runs = words.combine(hashes, RUN)
    places, lo = np.unique(chosen(runs), return_index=True)
    windows = words.combine(hashes, LEAST)
    hi = np.append(lo[1:], len(windows))[: len(lo)] - 1
    shape = ((hi - lo) * 64 + places - lo).astype(np.uint64)
    return runs[places], words.mix(windows[lo] + words.mix(windows[hi] + words.mix(shape))), places, lo - places, hi - places


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [np.zeros(0, np.int64)], [[np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3]
        for row, hashes in words.texts(batch.column(2)):
            if len(hashes) >= LEAST:
                found.append(_contexts(hashes))
                rows.append(np.full(len(found[-1][0]), row))
        take = pa.array(np.concatenate(rows))
        run, context, place, lo, hi = (np.concatenate(x) for x in zip(*found))
        columns = [pa.array(run.view(np.int64)), pa.array(context.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)]
        columns += [pa.array(x.astype(np.int32)) for x in (place, lo, hi)]
        yield pa.RecordBatch.from_arrays(columns, ["run", "context", "id", "body", "place", "lo", "hi"])


def _binary(keys: np.ndarray) -> pa.Array:
    """Rows of words as bytes that sort as the words do, one after the other."""
    data = keys.astype(">u8").tobytes()
    ends = (np.arange(len(keys) + 1) * keys.shape[1] * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each listed anchor: the 50 words from it onward, and the 38 before it backward; none is 0."""
    for batch in batches:
        lists = batch.column(1)
        ends = lists.offsets.to_numpy()
        parts = lists.values
        place = parts.field("place").to_numpy()
        for row, hashes in words.texts(batch.column(0)):
            text = np.concatenate([np.zeros(BEFORE, np.uint64), hashes, np.zeros(LEAST, np.uint64)])
            for at in range(ends[row], ends[row + 1], _ROWS):
                mine = np.arange(at, min(at + _ROWS, ends[row + 1]))
                here = place[mine][:, None] + BEFORE
                columns = [parts.field(c).take(pa.array(mine)) for c in ("context", "lo", "hi")]
                columns += [_binary(text[here + np.arange(LEAST)]), _binary(text[here - 1 - np.arange(BEFORE)])]
                yield pa.RecordBatch.from_arrays(columns, ["context", "lo", "hi", "onward", "backward"])


def in_common(keys: np.ndarray) -> np.ndarray:
    """How many words each row after the first begins with that the row before it begins with, too."""
    differ = keys[1:] != keys[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])


class Segments:
    """Names of the segments of rows that come in order, in batches, from one range.

    The segment of length n that a row is in began at the last row that has fewer than n words in common
    with the row before it.  A segment that the range begins with may have begun in an earlier one: its
    name is negative until ``carried`` knows better.
    """

    def __init__(self, part: int, width: int):
        self.part, self.width, self.rows = part, width, 0
        self.open = -(part * 64 + np.arange(width + 1, dtype=np.int64)) - 1
        self.first: np.ndarray | None = None
        self.last: np.ndarray | None = None

    def add(self, keys: np.ndarray) -> np.ndarray:
        """The segment names of each row, for lengths from 0 to the number of words."""
        if self.first is None:
            self.first = self.last = keys[0]
            common = np.concatenate([[self.width], in_common(keys)])
        else:
            common = in_common(np.concatenate([self.last[None], keys]))
        number = self.rows + np.arange(len(keys), dtype=np.int64)
        begins = np.where(common[:, None] < np.arange(self.width + 1), number[:, None], -1)
        begins = np.maximum.accumulate(begins, axis=0)
        names = np.where(begins >= 0, begins + (self.part << _ROW_BITS), self.open)
        self.rows, self.last, self.open = self.rows + len(keys), keys[-1], names[-1]
        return names


def carried(edges: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """(name, right name) of the segments that reach over edges, from (range, first row, last row, last names) of all ranges.

    Those that are not listed begin with their range.
    """
    found, last, names = [], None, None
    for part, first, final, open_ in sorted(edges, key=lambda e: e[0]):
        common = -1 if last is None else int(in_common(np.stack([last, first]))[0])
        mine = -(part * 64 + np.arange(len(open_), dtype=np.int64)) - 1
        right = np.where(np.arange(len(open_)) <= common, mine if names is None else names, part << _ROW_BITS)
        found += list(zip(mine[: common + 1].tolist(), right[: common + 1].tolist(), strict=True))
        last, names = final, np.where(open_ < 0, right, open_)
    return found


def _words_of(column: pa.Array, width: int) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(">u8").astype(np.uint64).reshape(-1, width)


def _segments(width: int, length: Callable[[np.ndarray], np.ndarray]):
    """For each row its segment names at the length that ``length`` gives for each of its windows; then one row of the range's edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["context", "starts", "part", "first", "last"]
        segments = Segments(TaskContext.get().partitionId(), width)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                lo, hi = part.column(1).to_numpy().astype(np.int64), part.column(2).to_numpy()
                found = segments.add(_words_of(part.column(3), width))
                n = hi - lo + 1
                ends = np.concatenate([[0], np.cumsum(n)])
                each = np.repeat(np.arange(len(n)), n)
                window = lo[each] + np.arange(len(each)) - ends[each]
                starts = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found[each, length(window)]))
                none = pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), starts, pa.nulls(len(n), pa.int64()), none, none], names)
        if segments.first is not None:
            edge = [pa.array([None], pa.int64()), pa.array([segments.open.tolist()], pa.list_(pa.int64())), pa.array([segments.part], pa.int64())]
            yield pa.RecordBatch.from_arrays([*edge, _binary(segments.first[None]), _binary(segments.last[None])], names)

    return run


def _sorted_segments(suffixes: DataFrame, key: str, width: int, length: Callable[[np.ndarray], np.ndarray], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(context, names), and (name, right name) of the segments that reach over the edges of ranges.

    Rows that are alike in the key may lie in several ranges.  What comes to the driver, and is small enough to be
    broadcast, is at most one row for each length and range.
    """
    spark = suffixes.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = suffixes.select("context", "lo", "hi", key).repartitionByRange(ranges, key, "context").sortWithinPartitions(key, "context")
    table = scratch.keep(placed.mapInArrow(_segments(width, length), _SEGMENTS), f"segments-{key}")
    edges = [
        (r["part"], *(np.frombuffer(bytes(r[c]), ">u8").astype(np.uint64) for c in ("first", "last")), np.array(r["starts"], np.int64))
        for r in table.filter("part IS NOT NULL").toLocalIterator()
    ]
    over = spark.createDataFrame(carried(edges), "name long, right_name long")
    return table.filter("part IS NULL").select("context", F.col("starts").alias(key)), over


def _named(windows: DataFrame, key: str, over: DataFrame) -> DataFrame:
    """``windows`` with the right names of the segments in the column ``key``."""
    own = F.shiftleft(F.shiftright(-F.col(key) - 1, 6), _ROW_BITS)
    right = F.coalesce("right_name", F.when(F.col(key) < 0, own), F.col(key))
    return windows.join(F.broadcast(over.withColumnRenamed("name", key)), key, "left").withColumn(key, right).drop("right_name")


def _repeats(body: Column | None = None, place: Column | None = None) -> Column:
    """Whether the smallest id has the words at two places, or at another than the given one, that do not overlap."""
    body, place = (F.col("head.body") if body is None else body), (F.col("head.place") if place is None else place)
    elsewhere = (F.col("head.body") != body) | (F.bitwise_not("tail.body") != body)
    return elsewhere | (place - F.col("head.place") >= LEAST) | (-F.col("tail.place") - place >= LEAST)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each passage that also occurs elsewhere: id, first_word, n_words, other_id, kept.

    Passages have 50 words or more and are as long as the repeated 50-word windows that overlap or touch;
    words count from 0.  kept is true where no smaller id has the window; windows that are kept and windows
    that are not make passages of their own, which may overlap.  Cutting the words of those that are not
    kept, save the words that a kept one of the document has too, leaves one document with each window.
    other_id is the smallest id of the other documents with one of the passage's windows, or the document's
    own id where that is smaller and a window is in it twice without overlap.  Shorter, empty and null
    texts have none; rows without an id take no part; rows that repeat id and text count as one; an empty
    table gives an empty result; columns other than the two are not read.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    every = scratch.keep(rows.mapInArrow(_anchors, _ANCHOR), "anchors")
    often = every.groupBy("run").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("mixed")).filter("n > 1")
    # aggregates are kept before they are joined: Spark splits a common key only if the join reads two shuffles of its own
    runs = scratch.keep(often.select("run", "mixed"), "runs")
    found = scratch.keep(every.join(runs, "run").drop("run"), "found")
    scratch.drop(every, runs)
    # the tail has the largest body and place of the smallest id
    head = F.min(F.struct("id", "body", "place")).alias("head")
    tail = F.min(F.struct("id", F.bitwise_not("body").alias("body"), (-F.col("place")).alias("place"))).alias("tail")
    shape = [F.min(c).alias(c) for c in ("lo", "hi", "mixed")]
    contexts = scratch.keep(found.groupBy("context").agg(head, tail, F.max("id").alias("top"), *shape), "contexts")
    known = F.struct("context", "head.place", "lo", "hi")
    mixed = contexts.filter("mixed")
    lists = mixed.groupBy("head.id", "head.body").agg(F.collect_list(known).alias("known"))
    kept = scratch.keep(rows.join(lists, ["id", "body"]).select("text", "known").mapInArrow(_suffixes, _SUFFIX), "suffixes")
    onward, over_onward = _sorted_segments(kept, "onward", LEAST, lambda window: window + LEAST, scratch)
    backward, over_backward = _sorted_segments(kept, "backward", BEFORE, lambda window: -window, scratch)
    scratch.drop(kept)
    names = mixed.select("context", "head", "tail", "top", "lo").join(onward, "context").join(backward, "context")
    each = names.select("context", "head", "tail", "top", "lo", F.posexplode(F.arrays_zip("onward", "backward")))
    each = each.select("context", "head", "tail", "top", (F.col("lo") + F.col("pos")).alias("at"), "col.onward", "col.backward")
    windows = scratch.keep(_named(_named(each, "onward", over_onward), "backward", over_backward), "windows")
    window = ["at", "onward", "backward"]
    repeated = (F.col("top") != F.col("head.id")) | _repeats()
    same = windows.groupBy(*window).agg(F.min("head").alias("head"), F.min("tail").alias("tail"), F.max("top").alias("top"))
    same = scratch.keep(same.filter(repeated), "same")
    what = ["context", "head", "tail", "top"]
    parts = windows.select(*window, "context").join(same, window)
    island = F.col("at") - F.row_number().over(Window.partitionBy(*what).orderBy("at"))
    parts = parts.dropDuplicates(["context", "at"]).withColumn("island", island).groupBy(*what, "island").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    whole = contexts.filter("NOT mixed").filter(repeated)
    spans = scratch.keep(parts.select(*what, "lo", "hi").unionByName(whole.select(*what, "lo", "hi")), "spans")
    scratch.drop(windows, contexts, same)

    def match(id_: str, body: str, place: str, other: Column, kept: bool) -> Column:
        ends = (F.col(place) + F.col("lo")).alias("first"), (F.col(place) + F.col("hi") + LEAST).alias("last")
        return F.struct(F.col(id_).alias("id"), F.col(body).alias("body"), *ends, other.alias("other"), F.lit(kept).alias("kept"))

    joined = found.select("context", "id", "body", "place").join(spans, "context")
    own = F.when(_repeats(F.col("body"), F.col("place")), F.col("id")).when(F.col("top") != F.col("id"), F.col("top"))
    later = F.array(match("id", "body", "place", F.col("head.id"), False), match("head.id", "head.body", "head.place", F.col("id"), True))
    both = F.when(F.col("id") != F.col("head.id"), later).otherwise(F.array(match("id", "body", "place", own, True)))
    matches = joined.select(F.explode(both).alias("m")).select("m.*").filter("other IS NOT NULL")
    by_place = Window.partitionBy("id", "body", "kept").orderBy("first", "last")
    reached = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    merged = matches.groupBy("id", "body", "kept", "first", "last").agg(F.min("other").alias("other"))
    numbered = merged.withColumn("new", (F.coalesce(reached, F.lit(-1)) < F.col("first")).cast("int")).withColumn("passage", F.sum("new").over(by_place))
    passages = numbered.groupBy("id", "body", "kept", "passage").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("other").alias("other"))
    return passages.select(
        F.col("id").alias(id_col),
        F.col("first").cast("long").alias("first_word"),
        (F.col("last") - F.col("first")).cast("long").alias("n_words"),
        F.col("other").alias("other_id"),
        "kept",
    )
