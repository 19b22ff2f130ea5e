"""Importance resampling towards a target: hashed n-gram weights with Gumbel noise, and the top of them.

Words are runs of bytes that are digits, letters or above 127, with A-Z in lower case: one 256-byte table
translates a text and ``bytes.split`` cuts it.  The features of a text are all runs of 1 to ``n`` words
joined by one space; the crc32 of a run is the seed from which the run one word longer goes on, so no run
is ever put together.  A Counter reduces the features of a piece of text.

1. Each task adds its features up by bucket; Spark sums the tasks' tables, of ``buckets`` rows at most.
2. The gain of a bucket is ``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))`` with the
   counts s of S in the documents and t of T in the target.  The gains are ``buckets`` numbers.
3. A document's weight is the sum of its features' gains, its score adds Gumbel noise from a digest of its id.
4. The documents of ``min_words`` words or more are sorted by ranges of (score, id); a rank is the place in
   the range plus the rows of the ranges before, so the draw is exact and no task holds all of them.

A null text has no features and weight 0; a null id takes part with the noise of an empty id and sorts last
among equals.  Equal rows have ranks of their own.  With an empty target all gains come from the documents alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bytewords
from tidemark.llm.scratch import Scratch

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
SHARE = (10, 100)
#: All of ASCII but digits and letters.
WORDS = bytewords.table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def features(text: bytes, n: int) -> Iterator[tuple[int, Counter]]:
    """(new words, Counter of the crc32 of every run of 1 to n words that ends in one of them), by pieces."""
    for words, old in bytewords.pieces(text, WORDS, n - 1):
        runs = list(map(crc32, words))
        found = Counter(runs[old:])
        for length in range(2, n + 1):
            runs = list(map(crc32, words[length - 1 :], map(crc32, repeat(b" "), runs)))
            found.update(runs[max(0, old - length + 1) :])
        yield len(words) - old, found


def texts(df: DataFrame, text_col: str) -> Column:
    return F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary").alias("text")


def bucket_counts(df: DataFrame, text_col: str = "text", n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, c): how often the features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * buckets
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, found in features(text, n):
                    for crc, c in found.items():
                        total[crc % buckets] += c
        some = [b for b in range(buckets) if total[b]]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([total[b] for b in some], pa.int64())], ["bucket", "c"])

    counted = df.select(texts(df, text_col)).mapInArrow(count, "bucket long, c long")
    return counted.groupBy("bucket").agg(F.sum("c").alias("c"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from two tables of ``bucket_counts``; what comes to the driver is ``buckets`` rows."""
    both = source.withColumnRenamed("c", "s").join(target.withColumnRenamed("c", "t"), "bucket", "full_outer")
    s, t = [0] * buckets, [0] * buckets
    for row in both.collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    whole_s, whole_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log(float(b + 1) * whole_s / (float(a + 1) * whole_t))) for a, b in zip(s, t, strict=True)]


def weigh(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text", n: int = 1) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = len(gain)
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch.column(1).to_pylist():
                words = runs = total = 0
                for new, found in features(text, n):
                    words += new
                    runs += found.total()
                    total += sum(gain[crc % buckets] * c for crc, c in found.items())
                n_words.append(words)
                n_features.append(runs)
                weight.append(total)
            made = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(made, schema=schema)

    rows = docs.select(docs[id_col].cast("long").alias("id"), texts(docs, text_col))
    return rows.mapInArrow(weights, "id long, n_words long, n_features long, weight long")


def noise(id_column: Column, seed: int) -> Column:
    """1000 times the Gumbel noise of an id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... in ``order`` over all of them, without a task that holds them all."""
    # Rows that are alike in all of ``order`` may lie in several ranges.
    spread = rows.withColumn("_any", F.rand(1))
    placed = spread.repartitionByRange(*order, "_any").sortWithinPartitions(*order, "_any").drop("_any")
    placed = scratch.keep(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    # One row for each range.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("rank", F.col("_before") + place + 1)
        .drop("_at", "_part", "_before")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    share: tuple[int, int] = SHARE,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    Of the N documents with at least ``min_words`` words, floor(share[0] * N / share[1]) are drawn: those of
    the highest scores, ties to smaller ids.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets), buckets)
    scored = weigh(docs, gain, id_col, text_col, n)
    scored = scratch.keep(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    able = scored.filter(F.col("n_words") >= min_words)
    draw = share[0] * able.count() // share[1]
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    ranks = ranked(able, order, scratch).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranks.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
