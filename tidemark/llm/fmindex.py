"""A bidirectional FM-index over a vocabulary, and the search of it for words one edit away.

The words are set one after the other with a delimiter before, between and after them.  The rotations of
that text and of its mirror image are sorted; each order is kept as its last column with counts at every
``STEP`` places.  A pattern is an interval in both orders at once, so it can grow at either end by any letter.

All patterns of a chunk move together, one letter at a time, as arrays of intervals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

STEP = 16
CHUNK = 1 << 11
LEFT, RIGHT = 0, 1


def rotations(codes: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``codes`` in order, by doubling the length compared."""
    n, step = len(codes), 1
    rank = codes.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    while step < n:
        key = rank * n + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


class Ranks:
    """How often each letter occurs before any place of a column."""

    def __init__(self, column: np.ndarray, letters: int):
        n = len(column)
        self.blocks = np.full((n // STEP + 1, STEP), letters, np.int32)
        self.blocks.ravel()[:n] = column
        own = np.zeros((len(self.blocks), letters + 1), np.int32)
        np.add.at(own, (np.repeat(np.arange(len(self.blocks)), STEP), self.blocks.ravel()), 1)
        self.before = np.zeros_like(own)
        self.before[1:] = np.cumsum(own, axis=0)[:-1]
        self.before[:, letters] = 0

    def at(self, places: np.ndarray) -> np.ndarray:
        """One row of counts, one for each letter and a zero, for each place."""
        block, rest = places // STEP, places % STEP
        out = self.before[block]
        for i in range(int(rest.max(initial=0))):
            some = np.flatnonzero(rest > i)
            out[some, self.blocks[block[some], i]] += 1
        return out


@dataclass
class Spans:
    """Intervals of equal size in the order of the text and in that of its mirror image."""

    lo: np.ndarray
    mirror: np.ndarray
    size: np.ndarray

    def take(self, which) -> Spans:
        return Spans(self.lo[which], self.mirror[which], self.size[which])


class Index:
    def __init__(self, words: list[str]):
        text = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype=np.uint32)
        self.letters, codes = np.unique(text, return_inverse=True)
        self.sigma = len(self.letters)
        self.n = len(codes)
        self.starts = np.flatnonzero(codes == 0)
        self.order = rotations(codes)
        mirrored = codes[::-1]
        self.ranks = (
            Ranks(codes[self.order - 1], self.sigma),
            Ranks(mirrored[rotations(mirrored) - 1], self.sigma),
        )
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=self.sigma))]).astype(np.int64)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(letters of all words, first place of each and the end); a letter that the text lacks is ``sigma``."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.letters, raw), self.sigma - 1)
        return np.where(self.letters[at] == raw, at, self.sigma), np.cumsum([0, *map(len, words)])

    def everything(self, count: int) -> Spans:
        return Spans(np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, self.n, np.int64))

    def extend(self, spans: Spans, side: int) -> Spans:
        """The intervals after one more letter at ``side``: a row for each pattern, a column for each letter."""
        own, other = (spans.lo, spans.mirror) if side == LEFT else (spans.mirror, spans.lo)
        before = self.ranks[side].at(own).astype(np.int64)
        size = self.ranks[side].at(own + spans.size) - before
        smaller = np.cumsum(size, axis=1) - size
        lo, mirror = self.first + before, other[:, None] + smaller
        # The column of letters that do not occur stays empty.
        size[:, self.sigma] = 0
        return Spans(lo, mirror, size) if side == LEFT else Spans(mirror, lo, size)

    def exact(self, letters: np.ndarray, first: np.ndarray, count: np.ndarray, side: int) -> Spans:
        """The intervals of patterns that grow towards ``side`` by ``count`` letters from ``first``, then by a delimiter."""
        step = -1 if side == LEFT else 1
        spans = self.everything(len(first))
        alive = np.arange(len(first))
        for i in range(int(count.max(initial=-1)) + 1):
            alive = alive[(spans.size[alive] > 0) & (count[alive] >= i)]
            place = np.where(count[alive] > i, first[alive] + step * i, 0)
            letter = np.where(count[alive] > i, letters[place], 0)
            grown = self.extend(spans.take(alive), side)
            row = np.arange(len(alive))
            spans.lo[alive], spans.mirror[alive], spans.size[alive] = (x[row, letter] for x in (grown.lo, grown.mirror, grown.size))
        return spans

    def one_edit(self, patterns: list[str], keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pattern, word) places of the words one edit away from each pattern whose half ``keep`` they have whole.

        The half is matched from where the two meet out to the delimiter; the search then turns and goes on
        over the other half to its delimiter, with exactly one inserted, deleted or replaced letter.
        """
        for lo in range(0, len(patterns), CHUNK):
            found = list(self._one_edit(patterns[lo : lo + CHUNK], keep))
            if found:
                pairs = np.unique(np.concatenate([p * len(self.starts) + w for p, w in found]))
                yield pairs // len(self.starts) + lo, pairs % len(self.starts)

    def _one_edit(self, patterns: list[str], keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        letters, begin = self.codes(patterns)
        length = np.diff(begin)
        half = length // 2
        if keep == LEFT:
            spans = self.exact(letters, begin[:-1] + half - 1, half, LEFT)
            first, todo, step, side = begin[:-1] + half, length - half, 1, RIGHT
        else:
            spans = self.exact(letters, begin[:-1] + half, length - half, RIGHT)
            first, todo, step, side = begin[:-1] + half - 1, half, -1, LEFT
        who = np.flatnonzero(spans.size > 0)
        spans, done, edited = spans.take(who), np.zeros(len(who), np.int64), np.zeros(len(who), bool)
        while len(who):
            grown = self.extend(spans, side)
            row = np.arange(len(who))
            ended = done == todo[who]
            place = np.where(ended, 0, first[who] + step * done)
            letter = np.where(ended, 0, letters[place])
            same = (grown.lo[row, letter], grown.mirror[row, letter], grown.size[row, letter])
            whole = ended & edited & (same[2] > 0)
            if whole.any():
                start = self.order[same[0][whole]]
                yield who[whole], np.searchsorted(self.starts, start)
            go = ~ended & (same[2] > 0)
            parts = [(who[go], *(x[go] for x in same), done[go] + 1, edited[go])]
            open_ = np.flatnonzero(~edited)
            if len(open_):
                yes = grown.size[open_] > 0
                yes[:, 0] = False
                at, column = np.nonzero(yes)
                at = open_[at]
                more = (grown.lo[at, column], grown.mirror[at, column], grown.size[at, column])
                edit = np.ones(len(at), bool)
                # A letter more than the pattern has; another letter than it has; a letter of it left out.
                parts.append((who[at], *more, done[at], edit))
                other = ~ended[at] & (column != letter[at])
                parts.append((who[at][other], *(x[other] for x in more), done[at][other] + 1, edit[other]))
                left = open_[~ended[open_]]
                parts.append((who[left], spans.lo[left], spans.mirror[left], spans.size[left], done[left] + 1, np.ones(len(left), bool)))
            who, *three, done, edited = (np.concatenate(x) for x in zip(*parts, strict=True))
            spans = Spans(*three)
