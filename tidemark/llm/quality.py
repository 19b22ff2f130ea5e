"""Quality scores by histogram gradient-boosted trees over statistics of a document.

Statistics are sums over byte and word arrays of many texts at a time.  The trees are fitted to a
bounded sample of labelled texts: its features are binned once at sample quantiles, and every split
comes from histograms of gradients over the bins.  All trees have the same depth, so the model is three
arrays (feature, threshold, leaf) and a batch of rows walks all trees together, one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sampling, words

TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_HESSIAN = 2.0

_CLASSES = {
    "upper": [*range(ord("A"), ord("Z") + 1)],
    "lower": [*range(ord("a"), ord("z") + 1)],
    "digit": [*range(ord("0"), ord("9") + 1)],
    "blank": [0x20, 0x09],
    "line": [0x0A],
    "stop": [*b".!?"],
    "comma": [*b",;:"],
    "shout": [*b"!"],
    "bar": [*b"|"],
    "symbol": [*b"#$%&*+/<=>@\\^_`{}~"],
    "bracket": [*b"()[]\"'"],
    "other": [*range(0x80, 0x100)],
}
NAMES = [
    *(f"share_{name}" for name in _CLASSES),
    "log_bytes",
    "log_words",
    "word_bytes",
    "words_per_line",
    "words_per_stop",
    "repeats_before",
    "distinct_words",
    "distinct_pairs",
    "distinct_tens",
    "top_word",
    "caps_per_word",
]
_KIND = np.full(256, len(_CLASSES), dtype=np.uint8)
for _number, _bytes in enumerate(_CLASSES.values()):
    _KIND[_bytes] = _number


def features(column: pa.Array) -> np.ndarray:
    """The statistics of every row of a text column; those of an empty or null text are 0."""
    data, ends = words.text_bytes(column)
    out = np.zeros((len(column), len(NAMES)))
    kinds = len(_CLASSES) + 1
    for lo, hi in words.slices(ends):
        hashes, first, _ = words.word_hashes(data, ends[lo : hi + 1])
        for row in range(lo, hi):
            size = int(ends[row + 1] - ends[row])
            if not size:
                continue
            counts = np.zeros(kinds, dtype=np.int64)
            for at in range(int(ends[row]), int(ends[row + 1]), words.PIECE):
                counts += np.bincount(_KIND[data[at : min(at + words.PIECE, int(ends[row + 1]))]], minlength=kinds)
            own = hashes[first[row - lo] : first[row - lo + 1]]
            n = len(own)
            out[row, : kinds - 1] = counts[:-1] / size
            upper, lines, stops, blanks = counts[0], counts[4], counts[5], counts[3] + counts[4]
            rest = out[row, kinds - 1 :]
            rest[0], rest[1] = np.log1p(size), np.log1p(n)
            if n:
                ordered = np.sort(own)
                new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                rest[2] = (size - blanks) / n
                rest[3], rest[4] = n / (lines + 1), n / (stops + 1)
                rest[5] = (own[1:] == own[:-1]).mean() if n > 1 else 0.0
                rest[6] = len(new) / n
                for place, k in ((7, 2), (8, 10)):
                    run = words.combine(own, k)
                    rest[place] = len(np.unique(run)) / len(run) if len(run) else 1.0
                rest[9] = np.diff(np.append(new, n)).max() / n
                rest[10] = upper / n
    return out


@dataclass
class Trees:
    """Trees of one depth as arrays: [tree, inner node] and [tree, leaf]; node i has children 2i+1, 2i+2."""

    base: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.feature.size:
            tree = np.arange(len(self.feature))[None, :]
            rows = np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            while node[0, 0] < self.feature.shape[1] if len(x) else False:
                node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
            total += self.leaf[tree, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Fit to labels 0 and 1; with one label only, every score is that label's smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(base)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    n_inner, n_features = 2**depth - 1, x.shape[1]
    made = Trees(base, np.zeros((trees, n_inner), np.int32), np.full((trees, n_inner), np.inf), np.zeros((trees, n_inner + 1)))
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            width = 2**level
            local = node - (width - 1)
            best = np.zeros(width)
            for f in range(n_features):
                cell = local * BINS + binned[:, f]
                g, h = (np.bincount(cell, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (gradient, hessian))
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h < LEAST_HESSIAN) | (h_all - h < LEAST_HESSIAN)] = 0
                cut = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), cut] > best + 1e-9):
                    if cut[k] < len(edges[f]):
                        best[k] = gain[k, cut[k]]
                        made.feature[t, width - 1 + k], made.threshold[t, width - 1 + k] = f, edges[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), made.feature[t, node]] > made.threshold[t, node])
        leaf = node - n_inner
        g, h = (np.bincount(leaf, weights=w, minlength=n_inner + 1) for w in (gradient, hessian))
        made.leaf[t] = -RATE * g / (h + RIDGE)
        total += made.leaf[t, leaf]
    return made


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column(0))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([values, batch.column(1)], ["x", "y"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = sampling.SAMPLE) -> Trees:
    """Learn from at most ``most`` labelled texts outside fold 0; only their statistics reach the driver."""
    sample = sampling.labelled(docs, labels, label, id_col, text_col, most).select("text", F.least("y", F.lit(1)).alias("y"))
    rows = sample.mapInArrow(_features, "x array<double>, y int").toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(NAMES)))
    y = rows["y"].to_numpy(dtype=float)
    order = np.lexsort([*x.T, y])  # the model does not depend on the order rows come in
    return boost(x[order], y[order])


def _score(model: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(features(part.column(1))))], ["id", "score"])

    return run


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; a null text is scored as an empty one; null and repeated ids are kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "id long, score double").withColumnRenamed("id", id_col)
