"""Labelled rows a classifier may learn from: a bounded sample, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

FOLDS = 5
SAMPLE = 20_000


def fold(column: str | Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds if isinstance(column, str) else F.crc32(column) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int = SAMPLE) -> DataFrame:
    """(text, y) of at most ``most`` labelled rows outside fold 0, one row for each different text.

    The rows are those with the smallest hashed ids, so the sample is random with respect to the data
    and equal in every run.  Its ids are at most ``most`` pairs of numbers and are broadcast; texts
    do not move.  Rows without id or label are left out; of an id or a text with both labels, 1 counts.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("y"))
        .filter("_id IS NOT NULL AND y IS NOT NULL")
        .filter(fold("_id") != 0)
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialize(rows.join(F.broadcast(chosen), "_id").groupBy("text").agg(F.max("y").alias("y")), "labelled")
