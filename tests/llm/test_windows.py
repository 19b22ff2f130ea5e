"""SimHash windows of benchmark items: no find is missed, against needed shingles that miss none by their making."""

from __future__ import annotations

import collections
import random

import brute
import pyarrow as pa
import pytest

from tidemark.llm import decontaminate


def changed(rng: random.Random, w: list[str], n: int) -> list[str]:
    """n words substituted, inserted or deleted at places of their own."""
    w = list(w)
    for at in sorted(rng.sample(range(len(w)), n), reverse=True):
        w[at : at + 1] = [[f"s{rng.random()}"], [f"i{rng.random()}", w[at]], []][rng.randrange(3)]
    return w


def needed(items: list[set], weight: collections.Counter) -> list[set]:
    """Of each item the rarest shingles that weigh more than a find may lack: every find has one of them."""
    found = []
    for own in items:
        order, left = sorted(own, key=lambda x: weight[x]), 0.2 * sum(1 / weight[x] for x in own) + 1e-9
        found.append(set())
        for x in order:
            found[-1].add(x)
            left -= 1 / weight[x]
            if left < 0:
                break
    return found


@pytest.mark.parametrize(("shortest", "longest", "shared"), [(5, 14, 0), (11, 40, 0), (20, 200, 0), (20, 60, 15), (30, 200, 60)])
def test_windows_miss_no_find(shortest, longest, shared):
    """2-6 scattered changes (1-2 where items are short), with openings and ends that a third of the items share."""
    rng = random.Random(f"{shortest}-{longest}-{shared}")
    common = [[f"c{k}x{i}" for i in range(shared)] for k in range(2)]
    items = [[f"v{rng.randrange(4000)}" for _ in range(rng.randint(shortest, longest))] for _ in range(150)]
    items = [common[0] + t if i % 3 == 0 else t + common[1] if i % 3 == 1 else t for i, t in enumerate(items)]
    held = []
    for t in items:
        for n in (0, 1, 1, 2) if longest < 20 else (0, 1, 2, 2, 3, 4, 5, 6):
            made = changed(rng, t, n)
            held.append([f"b{rng.random()}" for _ in range(rng.randrange(30))] + made + [f"a{rng.random()}" for _ in range(30)])
    index = decontaminate.Index([(i, " ".join(t)) for i, t in enumerate(items)])
    got = {(row, item) for row, item, _, _ in decontaminate._found_in(pa.array([" ".join(t) for t in held]), index)}
    sets = [brute.shingles(" ".join(t), 5) for t in items]
    weight = collections.Counter(x for s in sets for x in s)
    rare = needed(sets, weight)
    want = set()
    for d, t in enumerate(held):
        own = [tuple(t[i : i + 5]) for i in range(len(t) - 4)]
        mine = set(own)
        for i, s in enumerate(sets):
            if rare[i] & mine:
                stretch = len(items[i]) + 2 * (len(items[i]) // 4) - 4
                need = 0.8 * sum(1 / weight[x] for x in s) - 1e-9
                spans = (set(own[a : a + stretch]) & s for a in range(max(1, len(own) - stretch + 1)))
                if sum(1 / weight[x] for x in s & mine) >= need and any(sum(1 / weight[x] for x in span) >= need for span in spans):
                    want.add((d, i))
    assert len(want) > 150 and got <= want
    print(f"recall {len(got & want) / len(want)} of {len(want)}")
    assert len(got & want) >= 0.999 * len(want)
