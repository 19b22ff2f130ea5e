"""Exact deduplication with the frequent digests split off.

A few texts may make up a third of all rows, and all copies of one text meet in one task when a digest
is shuffled.  So the frequent digests are found first, by a Misra-Gries summary: every task counts its
rows in a bounded table and lowers all counters when the table is full, and the tables are merged.
(Spark's ``approx_top_k`` keeps such a table.)  A summary of ``tracked`` counters holds every digest
with more than ``3.5 / tracked`` of the rows.  What it proposes is counted exactly, by sums made in each
task before the shuffle; those verified winners - at most ``heavy`` rows - are broadcast, and their
copies are settled where they are read.  Only the other digests are shuffled, as (id, digest) rows.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import materialize

HEAVY = 256
TRACKED = 16_384
LEAST_COPIES = 32


def frequent_digests(digests: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``heavy`` digests that may be frequent, as one column ``digest``."""
    top = digests.selectExpr(f"approx_top_k(digest, {heavy}, {tracked}) AS top")
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest")).filter("digest IS NOT NULL")


def winners(digests: DataFrame, candidates: DataFrame, least: int = LEAST_COPIES) -> DataFrame:
    """Exact size and winner of each candidate digest with ``least`` copies or more."""
    return (
        digests.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") >= least)
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy: int = HEAVY,
    tracked: int = TRACKED,
    least: int = LEAST_COPIES,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical byte for byte; a null text is the empty text.  The largest id of a
    group stays.  Rows that repeat an id are all counted; each of those with the group's largest id has
    kept = true.  A null id never wins against another id; a group of null ids keeps null, and its rows
    are kept.  An empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    digests = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"),
        ),
        "digests",
    )
    won = materialize(winners(digests, frequent_digests(digests, heavy, tracked), least).coalesce(1), "winners")
    settled = digests.join(F.broadcast(won), "digest", "inner")
    same = Window.partitionBy("digest")
    rest = (
        digests.join(F.broadcast(won.select("digest")), "digest", "left_anti")
        .withColumn("keep_id", F.max("id").over(same))
        .withColumn("group_size", F.count(F.lit(1)).over(same))
    )
    return settled.unionByName(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of rows that repeat id and text, one stays.

    Only ids and digests decide.  The texts move once, to meet the (id, digest) pairs that stay, and
    repeats are numbered where that join has put them.  A text whose rows all lack an id keeps one row.
    """
    groups = exact_groups(docs, id_col, text_col).filter("kept")
    kept = groups.select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest")).distinct()
    # The row itself is one column, so no name of its own can clash with those added here.
    tagged = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].cast("long").alias("_id"),
        F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256).alias("_digest"),
    )
    order = [F.col("_row")[c].asc_nulls_first() for c in docs.columns if isinstance(docs.schema[c].dataType, T.AtomicType)]

    def one_of(rows: DataFrame, *key: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        return rows.withColumn("_n", place).filter("_n = 1").select("_row.*")

    named = one_of(tagged.filter("_id IS NOT NULL").join(kept, ["_id", "_digest"], "left_semi"), "_id", "_digest")
    nameless = tagged.filter("_id IS NULL").join(kept.filter("_id IS NULL"), "_digest", "left_semi")
    return named.unionByName(one_of(nameless, "_digest"))
