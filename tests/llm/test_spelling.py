"""Spelling variants against all pairs and plain counting."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest
from conftest import awkward

from tidemark.llm import fmindex, spelling


def one_edit(word: str, alphabet: set[str]) -> set[str]:
    n = len(word)
    cut = {word[:i] + word[i + 1 :] for i in range(n)}
    more = {word[:i] + c + word[i:] for i in range(n + 1) for c in alphabet}
    other = {word[:i] + c + word[i + 1 :] for i in range(n) for c in alphabet}
    return (cut | more | other) - {word}


def plain(rows, least=5, count=3, every=97):
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    alphabet = set("".join(n))
    near = {w: [x for x in one_edit(w, alphabet) if x in n] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def lexicon(seed: int, size: int, letters: str) -> list[str]:
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(size)}
    for w in list(words)[: size // 2]:
        words |= set(rng.sample(sorted(one_edit(w, set(letters))), 3))
    return sorted(words - {""})


@pytest.mark.parametrize("letters", ["ab", "abcdeéÿ"])
def test_search_finds_each_word_one_edit_away(letters):
    words = [w for w in lexicon(3, 200, letters) if len(w) >= 2]
    index = fmindex.Index(words)
    got = set()
    for keep in (fmindex.LEFT, fmindex.RIGHT):
        for p, w in index.one_edit(words, keep):
            got |= set(zip(p.tolist(), w.tolist(), strict=True))
    where = {w: i for i, w in enumerate(words)}
    want = {(i, where[x]) for w, i in where.items() for x in one_edit(w, set(letters)) if x in where}
    assert got == want


def test_patterns_with_letters_the_index_lacks():
    index = fmindex.Index(["cabins", "cabin"])
    found = [set(zip(p.tolist(), w.tolist(), strict=True)) for p, w in index.one_edit(["cabinz", "zabins", "zzzzzz"], fmindex.LEFT)]
    assert found == [{(0, 0), (0, 1)}]
    found = [set(zip(p.tolist(), w.tolist(), strict=True)) for p, w in index.one_edit(["cabinz", "zabins", "zzzzzz"], fmindex.RIGHT)]
    assert found == [{(1, 0)}]


def test_rotations_are_in_order():
    codes = np.array([0, 2, 1, 2, 1, 0, 1, 2, 0])
    order = fmindex.rotations(codes)
    assert [tuple(np.roll(codes, -i)) for i in order] == sorted(tuple(np.roll(codes, -i)) for i in range(len(codes)))


@pytest.mark.parametrize(("shard", "held"), [(spelling.SHARD, spelling.HELD), (64, 5)])
def test_variants_against_plain(spark, monkeypatch, shard, held):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "HELD", held)
    rng = random.Random(9)
    words = [w for w in lexicon(4, 60, "abcà") if len(w) >= 4] + ["letter", "Letters", "létter", "lette", "×÷×÷×", "wordword" * 40]
    rows = [*awkward()]
    for i in range(120):
        rows.append((1_000 + i, rng.choice([" ", "-", "1", "Ā"]).join(rng.choices(words, weights=[1 + (j % 17) ** 2 for j in range(len(words))], k=60))))
    rows.append((None, "letter Letters lette"))
    rows.append((2_000, "window " * 60 + "windows " * 25 + "Xwindows " * 9 + "xwindos " * 4))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    want = plain(rows)
    assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
    assert result(spelling.variants(df)) == want


def test_nothing(spark):
    assert result(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == []
    assert result(spelling.variants(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string"))) == []
