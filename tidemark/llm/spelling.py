"""Spelling variants: words one edit apart, found by bidirectional FM-index search, and the form each goes back to.

1. Words are maximal runs of letters, A-Z in lower case.  Where ``every`` divides the crc32 of ``<id>:<run>``, one
   letter of the run is taken out.  Words of ``least`` letters that occur ``count`` times make the vocabulary.
2. A word one edit away from a pattern has its left half or its right half whole.  For each, the
   vocabulary is dealt into shards in which all words of nearly the pattern's length with the first, or last, few
   letters of that half lie together with the pattern.  A shard has about ``SHARD`` letters of text whatever the size of
   the vocabulary: a group of more is split into parts, and its patterns are asked in each part.
3. A shard is one FM-index (``fmindex``): the half is matched exactly, the search turns, and the other half
   follows with exactly one edit, up to the delimiter.
4. A word's form is its most frequent near word (ties: smallest in code-point order) if that occurs at least
   twice as often.  Counts double along forms, so the way to the root is short; it is followed by doubling steps.

A null text has no words; a null id is written as an empty text before the colon.  Repeated rows count each time.
Replacement characters of broken UTF-8 are no letters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import fmindex
from tidemark.llm.scratch import Scratch

LEAST = 5
COUNT = 3
EVERY = 97
#: Letters of text in a shard, about.
SHARD = 1 << 17
#: Letters of a half by which words are dealt.
AFFIX = 3
#: Different words a task counts before it passes them on.
HELD = 200_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, every: int = EVERY
) -> DataFrame:
    """(word, n) for all words of ``least`` letters or more, after the deletions."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def table(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                whole = text.translate(_LOWER).decode("utf-8", "replace")
                seed = crc32(f"{key}:".encode())
                for run, c in Counter(m[0] for m in runs.finditer(whole)).items():
                    h = crc32(run.encode(), seed)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    total[run] += c
                if len(total) > HELD:
                    yield table(total)
                    total.clear()
        yield table(total)

    key = F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id")
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text")
    return docs.select(key, text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _dealt(words: DataFrame, keep: int, lengths) -> DataFrame:
    """A row for each pattern length of ``lengths``, with the letters by which that length is dealt."""
    rows = words.withColumn("length", F.explode(lengths))
    if keep == fmindex.LEFT:
        affix = F.expr(f"left(word, least(length div 2, {AFFIX}))")
    else:
        affix = F.expr(f"right(word, least(length - length div 2, {AFFIX}))")
    return rows.withColumn("keep", F.lit(keep)).withColumn("affix", affix)


def _search(table: pa.Table) -> pa.Table:
    """(word, n, near, near_n) of one shard: what its patterns find among its words."""
    words, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
    asked = np.array(table.column("asks").to_pylist(), dtype=bool)
    held = [i for i in range(len(words)) if not asked[i]]
    # A word lies in a shard once, though it is dealt there for several lengths.
    held = list({words[i]: i for i in held}.values())
    asks = np.flatnonzero(asked)
    if not held or not len(asks):
        return _PAIRS.empty_table()
    index = fmindex.Index([words[i] for i in held])
    made = []
    for patterns, found in index.one_edit([words[i] for i in asks], table.column("keep")[0].as_py()):
        a, b = asks[patterns].tolist(), [held[w] for w in found.tolist()]
        columns = [[words[i] for i in a], [counts[i] for i in a], [words[i] for i in b], [counts[i] for i in b]]
        made.append(pa.table(columns, schema=_PAIRS))
    return pa.concat_tables(made) if made else _PAIRS.empty_table()


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each word with every word exactly one edit away, once; ``vocabulary`` is a stored table."""
    size = F.length("word")
    letters = vocabulary.agg(F.sum(size + 1).alias("n")).first()["n"] or 0
    # Each word is dealt for three lengths.
    shards = max(1, -(-3 * letters // SHARD))
    both = []
    for keep in (fmindex.LEFT, fmindex.RIGHT):
        held = _dealt(vocabulary, keep, F.array(size - 1, size, size + 1)).withColumn("asks", F.lit(False))
        asking = _dealt(vocabulary, keep, F.array(size)).withColumn("asks", F.lit(True))
        large = held.groupBy("length", "affix").agg(F.ceil(F.sum(size + 1) / SHARD).alias("parts")).filter("parts > 1")
        parts = F.coalesce("parts", F.lit(1))
        held = held.join(large, ["length", "affix"], "left").withColumn("part", F.pmod(F.xxhash64("word"), parts))
        asking = asking.join(large, ["length", "affix"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        both += [held.select("keep", "length", "affix", "part", "asks", "word", "n"), asking.select("keep", "length", "affix", "part", "asks", "word", "n")]
    rows = both[0].unionByName(both[1]).unionByName(both[2]).unionByName(both[3])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("length", "affix", "part"), F.lit(shards)))
    found = rows.groupBy("keep", "shard").applyInArrow(_search, "word string, n long, near string, near_n long")
    return found.distinct()


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): where the way from form to form ends."""
    at = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = scratch.keep(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ended = ahead.filter("moved").isEmpty()
        scratch.drop(at)
        at = ahead
        if ended:
            return at.select("word", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    count: int = COUNT,
    every: int = EVERY,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    scratch = Scratch(docs.sparkSession, "spelling")
    counted = word_counts(docs, id_col, text_col, least, every)
    vocabulary = scratch.keep(counted.filter(F.col("n") >= count), "vocabulary")
    # -n first, so that the least of these is the most frequent word, and of those the smallest.
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("word")))
    near = near_words(vocabulary).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.m") >= 2 * F.col("n")
    near = scratch.keep(
        near.select(
            "word",
            "n_near",
            F.when(strong, F.col("best.word")).alias("form"),
            F.when(strong, -F.col("best.m")).alias("form_n"),
        ),
        "near",
    )
    ends = roots(near.filter("form IS NOT NULL").select("word", "form"), scratch)
    return (
        vocabulary.join(near, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
