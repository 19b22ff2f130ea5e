"""Interpolated modified Kneser-Ney language model, counted in Spark, read from memory-mapped arrays.

The model is of order 2: the probability of a word given the one before it, interpolated with the
probability that a word continues any history, and that with a uniform share for unseen words.

Counting moves no row per token.  A task turns its texts into word hashes, counts equal ones in numpy,
and sends packed blocks, cut by hash range; the number of ranges grows with the text, so each range is
a bounded amount of work, and a frequent word is one entry of a block, not a hot key.

1. Vocabulary: per range a sorted array of word hashes with counts.  A word's id is its rank over all.
2. Pairs (id, id) as one 64-bit key: per range a sorted array of keys with counts, and what these add to
   each history (its total, how many of its pairs occur once, twice, more often) and to each word (how
   many histories it continues).
3. Those sums: per range of ids, dense arrays.

All arrays are files in the shared folder, written under a name of the task's attempt; the manifest of
the Spark job that made them says which ones count.  Workers map them into memory, so the tasks of a
machine share one copy and read only the pages they touch.  Scoring needs a shared folder that is
mounted (a path, or file://).
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.scratch import Scratch

FOLDS, HELD_OUT = 7, 2
RANGE_BYTES = 12 << 20
FLUSH = 1 << 20
END = np.uint64(0x9E3779B97F4A7C15)  # stands for the end of a text; words hash to it only by chance
_BLOCK = "part int, keys binary, counts binary"


def token_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per run of rows: its first row, all tokens with an end after each text, and each row's first token."""
    data, ends = words.text_bytes(column)
    for lo, hi in words.slices(ends):
        hashes, first, _ = words.word_hashes(data, ends[lo : hi + 1])
        yield lo, np.insert(hashes, first[1:], END), first + np.arange(len(first))


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[new], np.add.reduceat(counts, new) if len(keys) else counts


class Counts:
    """A bounded buffer of keys that leaves as blocks of distinct keys and their counts."""

    def __init__(self, part_of):
        self.part_of, self.held, self.size = part_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, counts = np.unique(np.concatenate(self.held), return_counts=True)
            parts = self.part_of(keys)
            order = np.argsort(parts, kind="stable")
            keys, counts, parts = keys[order], counts[order].astype(np.uint32), parts[order]
            cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]]))
            spans = list(zip(cuts, cuts[1:]))
            columns = [pa.array(parts[cuts[:-1]], pa.int32()), pa.array([keys[a:b].tobytes() for a, b in spans]), pa.array([counts[a:b].tobytes() for a, b in spans])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "counts"])
        self.held, self.size = [], 0


def hash_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of equal width over all 64-bit values, numbered from 0."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _save(root: str, **arrays: np.ndarray) -> str:
    """Write arrays under a name no other attempt has."""
    path = f"{root}/{uuid.uuid4().hex}"
    os.makedirs(path)
    for name, array in arrays.items():
        array.tofile(f"{path}/{name}")
    return path


@dataclass
class Arrays:
    """Files of ranges of a sorted or dense array, mapped when first read."""

    kinds: dict[str, str]
    paths: dict[int, str] = field(default_factory=dict)
    maps: dict = field(default_factory=dict)

    def get(self, part: int, name: str) -> np.ndarray:
        if (part, name) not in self.maps:
            path = f"{self.paths[part]}/{name}" if part in self.paths else ""
            there = path and os.path.getsize(path)
            self.maps[part, name] = np.memmap(path, dtype=self.kinds[name], mode="r") if there else np.zeros(0, self.kinds[name])
        return self.maps[part, name]

    def __getstate__(self):
        return {"kinds": self.kinds, "paths": self.paths, "maps": {}}


@dataclass
class Model:
    parts: int
    root: str
    vocabulary: Arrays = field(default_factory=lambda: Arrays({"hash": "u8", "count": "u8"}))
    pairs: Arrays = field(default_factory=lambda: Arrays({"key": "u8", "count": "u4"}))
    totals: Arrays = field(default_factory=lambda: Arrays({"total": "u8", "once": "u8", "twice": "u8", "more": "u8", "histories": "u8"}))
    base_id: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    n_tokens: int = 0
    n_types: int = 0
    n_pairs: int = 0
    ids_per_part: int = 1
    discounts: np.ndarray = field(default_factory=lambda: np.zeros((2, 4)))
    unseen: float = 1.0

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and count of each word; -1 and 0 for one not seen in training."""
        each, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(each), -1, np.int64), np.zeros(len(each), np.int64)
        parts = hash_part(each, self.parts)
        for part, lo, hi in _runs(parts):
            table = self.vocabulary.get(part, "hash")
            at = np.searchsorted(table, each[lo:hi])
            at[at == len(table)] = 0
            hit = table[at] == each[lo:hi] if len(table) else np.zeros(hi - lo, bool)
            ids[lo:hi][hit] = self.base_id[part] + at[hit]
            counts[lo:hi][hit] = self.vocabulary.get(part, "count")[at[hit]]
        return ids[back], counts[back]

    def before(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The id before each token; the start of a text is the number of types."""
        out = np.concatenate([[self.n_types], ids[:-1]])
        out[first[:-1]] = self.n_types
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(keys), np.int64)
        parts = hash_part(words.mix(keys), self.parts)
        order = np.argsort(parts, kind="stable")
        for part, lo, hi in _runs(parts[order]):
            table, rows = self.pairs.get(part, "key"), order[lo:hi]
            at = np.searchsorted(table, keys[rows])
            at[at == len(table)] = 0
            hit = table[at] == keys[rows] if len(table) else np.zeros(hi - lo, bool)
            counts[rows[hit]] = self.pairs.get(part, "count")[at[hit]]
        return counts

    def sums(self, ids: np.ndarray, *names: str) -> list[np.ndarray]:
        """Named sums of each id; 0 for id -1."""
        each, back = np.unique(ids, return_inverse=True)
        out = [np.zeros(len(each), np.int64) for _ in names]
        known = np.flatnonzero(each >= 0)
        for part, lo, hi in _runs(each[known] // self.ids_per_part):
            rows = known[lo:hi]
            for values, name in zip(out, names):
                values[rows] = self.totals.get(int(part), name)[each[rows] - part * self.ids_per_part]
        return [values[back] for values in out]

    def log10_probability(self, ids: np.ndarray, previous: np.ndarray) -> np.ndarray:
        if not self.n_types:  # nothing was learned
            return np.zeros(len(ids))
        pair_d, word_d = self.discounts
        (histories,) = self.sums(ids, "histories")
        total, once, twice, more = self.sums(previous, "total", "once", "twice", "more")
        lower = np.maximum(histories - word_d[np.minimum(histories, 3)], 0) / max(1, self.n_pairs) + self.unseen / (self.n_types + 1)
        both = (ids >= 0) & (previous >= 0) & (total > 0)
        key = (previous[both].astype(np.uint64) << np.uint64(32)) | ids[both].astype(np.uint64)
        each, back = np.unique(key, return_inverse=True)
        count = np.zeros(len(ids), np.int64)
        count[both] = self.pair_counts(each)[back]
        bottom = np.maximum(total, 1)
        left = np.where(total > 0, (pair_d[1] * once + pair_d[2] * twice + pair_d[3] * more) / bottom, 1.0)
        return np.log10(np.maximum(count - pair_d[np.minimum(count, 3)], 0) / bottom + left * lower)


def _runs(sorted_parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.concatenate([[True], sorted_parts[1:] != sorted_parts[:-1], [True]])) if len(sorted_parts) else [0]
    for lo, hi in zip(cuts, cuts[1:]):
        yield int(sorted_parts[lo]), int(lo), int(hi)


def discounts(n: np.ndarray) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from how many entries have the counts 1 to 4, none below 0 or above its count."""
    n1, n2, n3, n4 = (float(max(x, 0)) for x in n)
    if not n1:  # nothing occurs once: the usual halves keep some mass for what is unseen
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(float(np.clip(v, 0, i)) for i, v in enumerate(d, 1))])


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts(lambda keys: hash_part(keys, parts))
        for batch in batches:
            for _, tokens, _ in token_hashes(batch.column(0)):
                yield from held.add(tokens)
        yield from held.flush()

    return run


def _count_pairs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts(lambda keys: hash_part(words.mix(keys), model.parts))
        for batch in batches:
            for _, tokens, first in token_hashes(batch.column(0)):
                ids, _ = model.words(tokens)
                yield from held.add((model.before(ids, first).astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
        yield from held.flush()

    return run


def _merged(group: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    whole = lambda name, kind: np.frombuffer(b"".join(group.column(name).to_pylist()), dtype=kind)
    keys, counts = _counted(whole("keys", np.uint64), whole("counts", np.uint32).astype(np.uint64))
    return group.column("part")[0].as_py(), keys, counts


def _low_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in range(1, 5)]


_SAVED = "part int, path string, entries long, tokens long, n1 long, n2 long, n3 long, n4 long"


def _saved(part: int, path: str, counts: np.ndarray) -> pa.Table:
    values = [part, path, len(counts), int(counts.sum()), *_low_counts(counts)]
    names = [c.split()[0] for c in _SAVED.split(", ")]
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6]
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _save_words(root: str):
    def run(group: pa.Table) -> pa.Table:
        part, keys, counts = _merged(group)
        return _saved(part, _save(root, hash=keys, count=counts), counts)

    return run


def _save_pairs(root: str, ids_per_part: int):
    """The manifest row of a range of pairs, and rows of what it adds to ids, by range of ids."""

    def run(group: pa.Table) -> pa.Table:
        part, keys, counts = _merged(group)
        out = _saved(part, _save(root, key=keys, count=counts.astype(np.uint32)), counts)
        rows = [out.append_column("ids", pa.array([None], pa.binary())).append_column("sums", pa.array([None], pa.binary()))]
        sides = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        one, two = counts == 1, counts == 2
        columns = [counts, one, two, ~one & ~two]
        history, at = np.unique(sides[0], return_index=True)  # pairs are sorted by history
        as_history = np.stack([np.add.reduceat(c.astype(np.uint64), at) for c in columns])
        word, seen = np.unique(sides[1], return_counts=True)
        every = np.union1d(history, word)
        sums = np.zeros((5, len(every)), dtype=np.uint64)
        sums[:4, np.searchsorted(every, history)] = as_history
        sums[4, np.searchsorted(every, word)] = seen
        for id_part, lo, hi in _runs(every // ids_per_part):
            empty = _saved(id_part, "", np.zeros(0, np.int64))
            packed = [every[lo:hi].astype(np.uint32).tobytes(), np.minimum(sums[:, lo:hi], 2**32 - 1).astype(np.uint32).tobytes()]
            rows.append(empty.append_column("ids", pa.array([packed[0]], pa.binary())).append_column("sums", pa.array([packed[1]], pa.binary())))
        return pa.concat_tables(rows)

    return run


def _save_totals(root: str, ids_per_part: int):
    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        dense = np.zeros((5, ids_per_part), dtype=np.uint64)
        for ids, sums in zip(group.column("ids").to_pylist(), group.column("sums").to_pylist()):
            at = np.frombuffer(ids, np.uint32).astype(np.int64) - part * ids_per_part
            dense[:, at] += np.frombuffer(sums, np.uint32).reshape(5, -1)  # ids are distinct within a block
        names = ["total", "once", "twice", "more", "histories"]
        return _saved(part, _save(root, **dict(zip(names, dense))), dense[4][dense[4] > 0])

    return run


def local_path(root: str) -> str:
    path = root.removeprefix("file://")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"{root} is not a mounted folder, from which arrays can be mapped into memory")
    return path


def train(texts: DataFrame, scratch: Scratch, text_col: str = "text", range_bytes: int = RANGE_BYTES) -> Model:
    """Count the model over all rows of ``texts``.  Only one row per range reaches the driver."""
    rows = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    model = Model(max(1, math.ceil(size / range_bytes)), f"{local_path(scratch.root)}/arrays")
    made = scratch.keep(rows.mapInArrow(_count_words(model.parts), _BLOCK).groupBy("part").applyInArrow(_save_words(model.root), _SAVED), "words")
    listed = made.collect()
    if not listed:
        return model
    sizes = np.zeros(model.parts, np.int64)
    for r in listed:
        model.vocabulary.paths[r["part"]], sizes[r["part"]] = r["path"], r["entries"]
    model.base_id = np.concatenate([[0], np.cumsum(sizes)])
    model.n_tokens, model.n_types = sum(r["tokens"] for r in listed), int(sizes.sum())
    if model.n_types >= 2**32 - 1:
        raise ValueError("a vocabulary of 2**32 words needs wider pairs")
    model.ids_per_part = math.ceil((model.n_types + 1) / model.parts)
    schema = f"{_SAVED}, ids binary, sums binary"
    pairs = scratch.keep(
        rows.mapInArrow(_count_pairs(model), _BLOCK).groupBy("part").applyInArrow(_save_pairs(model.root, model.ids_per_part), schema), "pairs"
    )
    listed = pairs.filter("path <> ''").drop("ids", "sums").collect()
    model.pairs.paths = {r["part"]: r["path"] for r in listed}
    model.n_pairs = sum(r["entries"] for r in listed)
    low = np.array([sum(r[f"n{i}"] for r in listed) for i in range(1, 5)])
    sums = pairs.filter("path = ''").select("part", "ids", "sums").groupBy("part").applyInArrow(_save_totals(model.root, model.ids_per_part), _SAVED)
    listed = scratch.keep(sums, "totals").collect()
    model.totals.paths = {r["part"]: r["path"] for r in listed}
    low_words = np.array([sum(r[f"n{i}"] for r in listed) for i in range(1, 5)])
    model.discounts = np.stack([discounts(low), discounts(low_words)])
    d = model.discounts[1]
    n_more = model.n_types - low_words[0] - low_words[1]
    model.unseen = float(d[1] * low_words[0] + d[2] * low_words[1] + d[3] * n_more) / model.n_pairs
    scratch.drop(made, pairs)
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bottom = math.log10(model.n_tokens + model.n_types + 1)
        for batch in batches:
            parts = []
            for _, tokens, first in token_hashes(batch.column(1)):
                ids, counts = model.words(tokens)
                rows = first[:-1]
                parts.append(
                    (
                        np.diff(first),
                        np.add.reduceat((counts > 0).astype(np.int64), rows),
                        np.add.reduceat(np.log10(counts + 1.0) - bottom, rows),
                        np.add.reduceat(model.log10_probability(ids, model.before(ids, first)), rows),
                    )
                )
            n, known, base, score = (np.concatenate(c) for c in zip(*parts)) if parts else [np.zeros(0)] * 4
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A null or empty text is one end token.  Without training rows N and V are 0 and both scores are 0.
    Null and repeated ids are kept, one result row for each input row; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scored = rows.mapInArrow(_score(model), "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows outside the held-out fold and score all; a row without an id is in no fold."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    scratch = Scratch(docs.sparkSession, "kneser-ney")
    model = train(docs.filter(remainder != HELD_OUT), scratch, text_col)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return score(docs, model, id_col, text_col).withColumn("held_out", held)
