"""Words and word shingles of whole Arrow text columns as 64-bit hashes, without a loop per word.

A word is a run of bytes that are neither a space nor one of \\t \\n \\v \\f \\r, with A-Z in lower case.
Its hash adds one random number per (byte, place in the word), so equal words agree in every task and
every run, and different ones collide only by chance.  Texts are worked on in pieces of about
``PIECE`` bytes cut between words, so a very long text needs memory for its hashes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
PLACES = 64
_RANDOM = np.random.Generator(np.random.PCG64(20240101))
_BYTE_AT = _RANDOM.integers(0, 2**64, size=PLACES * 256, dtype=np.uint64)
_STEPS = _RANDOM.integers(0, 2**64, size=64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offset of each row; a null row is empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), ends.astype(np.int64)


def _hash_piece(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; a word also begins at each of ``starts``."""
    space = _SPACE[raw]
    begins = np.empty(len(raw), dtype=bool)
    begins[0] = True
    begins[1:] = space[:-1]
    begins[starts] = True
    begins &= ~space
    inside = np.flatnonzero(~space)
    first = np.flatnonzero(begins[inside])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    value = _BYTE_AT[(place % PLACES) * 256 + _LOWER[raw[inside]]]
    if lengths.max() > PLACES:
        value = value * (2 * (place // PLACES) + 1).astype(np.uint64)
    total = np.add.reduceat(value, first)
    return mix(total + lengths.astype(np.uint64) * _STEPS[0]), inside[first]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of consecutive rows, the number of the first word of each row, and each word's first byte."""
    lo, hi = int(ends[0]), int(ends[-1])
    hashes, places = [], []
    at = lo
    while at < hi:
        stop = min(hi, at + PIECE)
        if stop < hi:
            blank = np.flatnonzero(_SPACE[data[at:stop]])
            if len(blank):
                stop = at + int(blank[-1]) + 1
            else:  # a word longer than a piece: on to its end
                while stop < hi and not _SPACE[data[stop]]:
                    stop += 1
        inner = ends[(ends >= at) & (ends < stop)] - at
        h, p = _hash_piece(data[at:stop], inner)
        hashes.append(h)
        places.append(p + at)
        at = stop
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    return words, np.searchsorted(where, ends), where


def slices(ends: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes together; a longer row is a run of its own."""
    row, n = 0, len(ends) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, side="right")) - 1)
        yield row, min(stop, n)
        row = min(stop, n)


def combine(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, for every start at which one fits."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _STEPS[1]
    for i in range(1, k):
        total += words[i : i + n] * _STEPS[1 + i]
    return mix(total)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct ``k``-word shingles of one text, sorted; a shorter text is one shingle of all its words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return combine(words, len(words))
    return np.unique(combine(words, k))


def texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its word hashes) for every row of a text column."""
    data, ends = text_bytes(column)
    for lo, hi in slices(ends):
        words, first, _ = word_hashes(data, ends[lo : hi + 1])
        for row in range(lo, hi):
            yield row, words[first[row - lo] : first[row - lo + 1]]
