from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, id long, n int, row string, word string, key long, digest string, score double, y int"


def passage(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729 + i * i * 31) % 5003}" for i in range(n))


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, ties, repeated rows, near copies, and a very long text."""
    base = passage(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    far = " ".join(w if i % 3 else "x" + w for i, w in enumerate(base.split()))
    return [
        (1, base), (2, base.upper()), (3, near), (4, far), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "one"), (9, "one"),
        (10, "a b c"), (11, "A  b\nc"), (None, base), (None, None), (12, passage(2, 30_000)), (13, "z" * 70_000), (14, "to " * 3000),
        (15, passage(3, 60) + " " + passage(4, 70)), (16, passage(5, 40) + " " + passage(4, 70)), (17, "été naïve 日本 " * 40),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    """The awkward rows with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 0, 0, "r", "w", 0, "d", 0.0, 0) for i, t in awkward()], SCHEMA)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
