"""Plain versions of the text operators for small tables, written from their definitions."""

from __future__ import annotations

import collections
import math
import re
import zlib


def words(text: str | None) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def remainder(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def groups(rows: list[tuple[int, str | None]], k: int, num: int = 80, den: int = 100) -> dict[int, int]:
    """Smallest reachable id of each id, comparing all pairs that share a shingle."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for at, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(at)
    for a, (i, s) in enumerate(sets):
        shared = collections.Counter(b for x in s for b in where[x] if b < a)
        for b, inter in shared.items():
            j, t = sets[b]
            if den * inter >= num * (len(s) + len(t) - inter) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in parent}


def kneser_ney(rows: list[tuple[int, str | None]], folds: int, held: int) -> dict[int, tuple]:
    """(held out, tokens, known, N, base score, score) of each id."""
    end = object()
    docs = [(i, [*words(t), end]) for i, t in rows]
    uni, pairs = collections.Counter(), collections.Counter()
    for i, w in docs:
        if remainder(i, folds) != held:
            uni.update(w)
            pairs.update(zip([None, *w], w))
    n, v = sum(uni.values()), len(uni)

    def discounts(counts) -> list[float]:
        n1, n2, n3, n4 = (sum(1 for c in counts if c == k) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        return [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]

    follows, total, kinds = collections.Counter(b for _, b in pairs), collections.Counter(), collections.defaultdict(lambda: [0] * 4)
    for (a, _), c in pairs.items():
        total[a] += c
        kinds[a][min(c, 3)] += 1
    d2, d1 = discounts(pairs.values()), discounts(follows.values())
    unseen = sum(d1[min(c, 3)] for c in follows.values()) / len(pairs)

    def p(w, before) -> float:
        lower = max(follows.get(w, 0) - d1[min(follows.get(w, 0), 3)], 0) / len(pairs) + unseen / (v + 1)
        if before not in total:
            return lower
        c, left = pairs.get((before, w), 0), sum(d * m for d, m in zip(d2, kinds[before])) / total[before]
        return max(c - d2[min(c, 3)], 0) / total[before] + left * lower

    return {
        i: (
            remainder(i, folds) == held,
            len(w),
            sum(x in uni for x in w),
            n,
            sum(math.log10((uni.get(x, 0) + 1) / (n + v + 1)) for x in w),
            sum(math.log10(p(x, before)) for before, x in zip([None, *w], w)),
        )
        for i, w in docs
    }


def repeated_words(rows: list[tuple[int, str | None]], n: int = 50) -> dict[int, set[int]]:
    """Places of each id's words that lie in a run of ``n`` words which another id has."""
    where = collections.defaultdict(set)
    for i, t in rows:
        w = words(t)
        for at in range(len(w) - n + 1):
            where[tuple(w[at : at + n])].add((i, at))
    covered = collections.defaultdict(set)
    for places in where.values():
        if len({i for i, _ in places}) > 1:
            for i, at in places:
                covered[i].update(range(at, at + n))
    return covered
