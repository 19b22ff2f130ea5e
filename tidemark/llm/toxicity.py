"""Toxicity by a learned lexicon, fuzzy matching of misspelled terms, and the context of each match.

Learning, on a bounded sample of labelled texts:

1. Spark counts in how many toxic and other texts each word, and each beginning of a word, occurs.
   Terms that tell the two apart beyond chance become candidates.
2. The lexicon is chosen greedily: a text counts half as much after each chosen term that it has, so
   words that only come along in one group of similar texts do not crowd out real terms.
3. A logistic model of four sums over a text's matches is fitted.

Matching: the lexicon is a trie; Levenshtein automata of distance 1 run over it, and the product is made
deterministic once.  That automaton then steps through all tokens of many texts at a time, and nearly
every token drops out after a few letters.  Beginnings of words and short terms match exactly.

Context: a match inside quotation marks within ``CONTEXT`` characters counts a quarter; matches with
others near by count more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sampling

CANDIDATES = 3000
LEXICON = 200
SIGNIFICANT = 24.0
STEM_LETTERS = range(3, 9)
FUZZY_LETTERS = 5
CONTEXT = 120
QUOTED = 0.25
NEAR = 0.25
PIECE_CHARS = 1 << 18
_WORD = re.compile(r"[^\W_]+")
_OPENING, _CLOSING = "\"“«„‹", "\"”»“›"


@dataclass
class Automaton:
    """Deterministic product of a lexicon's trie and Levenshtein automata of distance 1."""

    classes: dict[str, int]
    step: np.ndarray  # state x class -> state; state 0 is the start, state 1 is dead
    entry: np.ndarray  # entry that ends in a state, or -1
    distance: np.ndarray
    stem: np.ndarray  # the state says all at once, whatever letters follow

    @cached_property
    def class_of(self) -> np.ndarray:
        """Class of each code point: 0 between tokens, 1 a letter or digit of no entry."""
        table = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=np.uint8, count=0x110000)
        for letter, number in self.classes.items():
            table[ord(letter)] = number
        return table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "class_of"}


def automaton(terms: list[tuple[str, bool]]) -> Automaton:
    """For (text, is a stem) entries; entry numbers are places in the list."""
    letters = sorted({c for text, _ in terms for c in text})
    classes = {c: i + 2 for i, c in enumerate(letters)}
    children: list[dict[str, int]] = [{}, {}]  # node 0: root of fuzzy words, node 1: root of exact entries
    ends: dict[int, tuple[int, bool]] = {}
    for number, (text, stem) in enumerate(terms):
        node = 0 if not stem and len(text) >= FUZZY_LETTERS else 1
        for c in text:
            node = children[node].setdefault(c, len(children))
            if node == len(children):
                children.append({})
        ends.setdefault(node, (number, stem))

    def closed(items: dict[int, int]) -> frozenset[tuple[int, int]]:
        todo = list(items.items())
        while todo:
            node, edits = todo.pop()
            if edits < 1:
                for child in children[node].values():
                    if items.get(child, 9) > edits + 1:
                        items[child] = edits + 1
                        todo.append((child, edits + 1))
        return frozenset(items.items())

    start = closed({0: 0, 1: 1})
    states, queue, step = {start: 0, frozenset(): 1}, [start], {}
    entry, distance, stems = [-1, -1], [0, 0], [False, False]
    while queue:
        state = queue.pop()
        for c in [None, *letters]:
            reached: dict[int, int] = {}

            def put(node: int, edits: int) -> None:
                if edits <= 1 and reached.get(node, 9) > edits:
                    reached[node] = edits

            for node, edits in state:
                if c in children[node]:
                    put(children[node][c], edits)
                if edits < 1:
                    put(node, edits + 1)
                    for child in children[node].values():
                        put(child, edits + 1)
            to = closed(reached)
            stem = next((ends[n][0] for n, _ in sorted(to) if n in ends and ends[n][1]), None)
            if stem is not None:
                to = frozenset({(-1 - stem, 0)})
            if to not in states:
                states[to] = len(states)
                if stem is not None:
                    entry.append(stem)
                    distance.append(0)
                    stems.append(True)
                else:
                    queue.append(to)
                    # words on the exact side carry one edit from the start, which is none
                    whole = [(e if _fuzzy(terms[ends[n][0]]) else 0, ends[n][0]) for n, e in to if n in ends and not ends[n][1]]
                    best = min(whole, default=(0, -1))
                    entry.append(best[1])
                    distance.append(best[0])
                    stems.append(False)
            step[states[state], 1 if c is None else classes[c]] = states[to]
    table = np.ones((len(states), len(letters) + 2), dtype=np.int32)
    for (row, column), to in step.items():
        table[row, column] = to
    return Automaton(classes, table, np.array(entry), np.array(distance), np.array(stems))


def _fuzzy(term: tuple[str, bool]) -> bool:
    return not term[1] and len(term[0]) >= FUZZY_LETTERS


def matches(codes: np.ndarray, machine: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Place, entry and distance of each matching token, and the number of tokens."""
    kind = machine.class_of[codes]
    inside = kind > 0
    begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    kind = np.append(kind, 0)
    state, place = np.zeros(len(begins), dtype=np.int32), begins
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth, origin = 0, begins
    while len(place):
        here = kind[place]
        ended = here == 0
        hit = ended & (machine.entry[state] >= 0)
        found.append((origin[hit], state[hit]))
        state = machine.step[state, here]
        early = machine.stem[state] & ~ended
        found.append((origin[early], state[early]))
        on = ~ended & ~early & (state != 1)
        origin, state, depth = origin[on], state[on], depth + 1
        place = origin + depth
    at = np.concatenate([f[0] for f in found]) if found else np.zeros(0, int)
    last = np.concatenate([f[1] for f in found]) if found else np.zeros(0, int)
    order = np.argsort(at, kind="stable")
    return at[order], machine.entry[last[order]], machine.distance[last[order]], len(begins)


def quoted(text: str, place: int) -> bool:
    """Whether a quotation opens within the context before a place and closes within that after it."""
    before = text[max(0, place - CONTEXT) : place].rsplit("\n", 1)[-1]
    after = text[place : place + CONTEXT].split("\n", 1)[0]
    straight = before.count('"') % 2 == 1 and '"' in after
    opened = max(before.rfind(c) for c in _OPENING[1:])
    closed = max(before.rfind(c) for c in "”»›")
    return straight or (opened > closed and any(c in after for c in _CLOSING[1:]))


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))  # entry x distance
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-6.0, 0, 0, 0, 0]))
    machine: Automaton | None = None

    def hits(self, texts: list[str]) -> Iterator[tuple[int, str, np.ndarray, np.ndarray, np.ndarray, int]]:
        """Per text: row, text, places, entries, distances, tokens.  Many short texts go through together."""
        row = 0
        while row < len(texts):
            stop, size = row, 0
            while stop < len(texts) and (stop == row or size + len(texts[stop]) < PIECE_CHARS):
                size += len(texts[stop]) + 1
                stop += 1
            group = [t.lower() for t in texts[row:stop]]
            codes = np.frombuffer("\n".join(group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            ends = np.cumsum([len(t) + 1 for t in group])
            at, entry, distance, _ = matches(codes, self.machine)
            cut = np.searchsorted(at, np.concatenate([[0], ends]))
            for i, text in enumerate(group):
                lo, hi = cut[i], cut[i + 1]
                base = ends[i] - len(text) - 1
                yield row + i, text, at[lo:hi] - base, entry[lo:hi], distance[lo:hi], max(1, len(text) // 6)
            row = stop

    def features(self, texts: list[str]) -> np.ndarray:
        """Weighted sum of matches, largest one, number, and share of the text, by row."""
        out = np.zeros((len(texts), 4))
        if not self.terms:
            return out
        for row, text, at, entry, distance, size in self.hits(texts):
            if not len(at):
                continue
            near = np.searchsorted(at, at + CONTEXT, side="right") - np.searchsorted(at, at - CONTEXT) - 1
            context = np.where([quoted(text, int(p)) for p in at], QUOTED, 1 + NEAR * np.minimum(near, 4))
            value = self.weights[entry, distance] * context
            out[row] = math.log1p(max(0.0, value.sum())), max(0.0, value.max()), math.log1p(len(at)), min(1.0, 20 * value.sum() / size)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(self.coefficients[0] + x @ self.coefficients[1:], -30, 30)))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[int]] = {}

    def table() -> pa.RecordBatch:
        values = list(counts.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *(pa.array([v[i] for v in values], pa.int64()) for i in (0, 1))], ["term", "other", "toxic"]
        )

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set(_WORD.findall(text.lower()))
            terms = {w for w in found if 3 <= len(w) <= 24}
            terms |= {f"{w[:n]}*" for w in found for n in STEM_LETTERS if n < len(w)}
            for term in terms:
                counts.setdefault(term, [0, 0])[y] += 1
            if len(counts) > 200_000:
                yield table()
                counts.clear()
    yield table()


def _by_text(of: Callable[[list[str], list[int]], Iterator[tuple]], names: list[str]):
    """A task that gives the rows ``of`` makes of some (text, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = list(of(part.column(0).to_pylist(), part.column(1).to_pylist()))
                kinds = [pa.list_(pa.int32()) if names[0] == "own" else pa.list_(pa.float64()) if names[0] == "x" else pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], kinds[i]) for i in (0, 1)], names)

    return run


def _terms_of(exact: dict[str, int]):
    def of(texts: list[str], ys: list[int]) -> Iterator[tuple]:
        for text, y in zip(texts, ys):
            found = set(_WORD.findall(text.lower()))
            own = {exact[w] for w in found if w in exact} | {exact[s] for w in found for k in STEM_LETTERS if k < len(w) and (s := w[:k] + "*") in exact}
            yield sorted(own), y

    return _by_text(of, ["own", "y"])


def _fuzzy_only(model: Model):
    """The terms that a text without any exact match has with one error."""

    def of(texts: list[str], ys: list[int]) -> Iterator[tuple]:
        for i, _, _, entry, distance, _ in model.hits(texts):
            if len(entry) and not (distance == 0).any():
                for e in set(entry[distance == 1].tolist()):
                    yield e, ys[i]

    return _by_text(of, ["entry", "y"])


def _features_of(model: Model):
    return _by_text(lambda texts, ys: zip(model.features(texts).tolist(), ys), ["x", "y"])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def _ratio(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio of each term's counts against chance, and its smoothed log odds."""
    n = np.maximum(toxic + other, 1e-9)
    base = n_toxic / (n_toxic + n_other)
    rate = toxic / n
    log = lambda a, b: np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / b), 0.0)
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    return 2 * n * (log(rate, base) + log(1 - rate, 1 - base)), odds


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", most: int = sampling.SAMPLE) -> Model:
    """Learn from at most ``most`` labelled texts outside fold 0; without both labels nothing is learned."""
    sample = sampling.labelled(docs, labels, label, id_col, text_col, most).select("text", F.least("y", F.lit(1)).alias("y"))
    n = dict(sample.groupBy("y").count().collect())
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_other:
        return Model()
    counted = sample.mapInArrow(_count_terms, "term string, other long, toxic long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    share = F.lit(n_toxic / (n_toxic + n_other))
    some = counted.filter((F.col("toxic") >= 3) & (F.col("toxic") > 1.5 * share * (F.col("toxic") + F.col("other"))))
    ranked = some.orderBy(F.desc(F.col("toxic") * F.log(F.col("toxic") / (F.col("toxic") + F.col("other")) / share) - F.col("other")), "term").limit(CANDIDATES).collect()
    # words before stems of the same reach, long stems before short ones
    ranked = sorted(((r["term"], r["toxic"], r["other"]) for r in ranked), key=lambda r: (r[0].endswith("*"), -len(r[0]), r[0]))
    if not ranked:
        return Model()
    exact = {term.rstrip("*") + ("*" if term.endswith("*") else ""): i for i, (term, _, _) in enumerate(ranked)}
    held = sample.mapInArrow(_terms_of(exact), "own array<int>, y int").collect()  # at most ``most`` rows
    y = np.array([r["y"] for r in held])
    rows_ = np.repeat(np.arange(len(held)), [len(r["own"]) for r in held])
    columns_ = np.array([c for r in held for c in r["own"]], int)
    weight, chosen = np.ones(len(y)), []
    open_ = np.ones(len(ranked), dtype=bool)
    while len(chosen) < LEXICON:
        toxic = np.bincount(columns_, weights=(weight * (y == 1))[rows_], minlength=len(ranked))
        other = np.bincount(columns_, weights=(y == 0)[rows_].astype(float), minlength=len(ranked))
        gain, odds = _ratio(toxic, other, max(1.0, (weight * (y == 1)).sum()), n_other)
        gain[~open_ | (odds < 1)] = 0
        best = int(gain.argmax())
        if gain[best] < SIGNIFICANT:
            break
        chosen.append(best)
        open_[best] = False
        name = ranked[best][0]
        if name.endswith("*"):  # all words that begin so are matched by it
            open_ &= ~np.array([t.startswith(name[:-1]) for t, _, _ in ranked])
        # a shorter beginning that hardly reaches further says the same with less care
        reach = 1.25 * ranked[best][1]
        open_ &= ~np.array([t.endswith("*") and name.startswith(t[:-1]) and n <= reach for t, n, _ in ranked])
        weight[rows_[columns_ == best]] *= 0.5
    if not chosen:
        return Model()
    _, odds = _ratio(np.array([ranked[i][1] for i in chosen], float), np.array([ranked[i][2] for i in chosen], float), n_toxic, n_other)
    terms = [(ranked[i][0].rstrip("*"), ranked[i][0].endswith("*")) for i in chosen]
    model = Model(terms, np.column_stack([odds, odds / 2]), machine=automaton(terms))
    # a fuzzy match weighs as much as texts that have it, and no exact one, are toxic
    seen = np.ones((len(terms), 2))
    for r in sample.mapInArrow(_fuzzy_only(model), "entry int, y int").groupBy("entry", "y").count().collect():
        seen[r["entry"], r["y"]] += r["count"]
    model.weights[:, 1] = odds / 2 * np.clip(2 * seen[:, 1] / seen.sum(axis=1), 0, 1) ** 2
    told = sample.mapInArrow(_features_of(model), "x array<double>, y int").collect()  # four numbers a row
    table = np.array(sorted((*r["x"], r["y"]) for r in told))
    model.coefficients = _logistic(table[:, :-1], table[:, -1])
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = model.scores(pc.fill_null(part.column(1), "").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; a null or empty text gets the score of a text without matches."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "id long, score double").withColumnRenamed("id", id_col)


def _keep_below(model: Model, text_at: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = model.scores(pc.fill_null(part.column(text_at).cast(pa.string()), "").to_pylist())
                yield part.filter(pa.array(scores < limit))

    return run


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all columns."""
    return docs.mapInArrow(_keep_below(model, docs.columns.index(text_col), limit), docs.schema)
