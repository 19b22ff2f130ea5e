"""The corpus pipeline: toxicity, exact copies, near-duplicates, benchmark passages, tokenisation.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which ``run`` writes as Parquet to the shared folder and reads again as the next stage's documents.
Every stage works on all rows its predecessor kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, exact_dedup, setsketch, toxicity
from tidemark.session import materialize

# Bytes of text that a task hands to Python at once; ten thousand rows, Spark's other limit, may be far more.
BATCH_BYTES = "8m"


def bounded(spark: SparkSession) -> None:
    """Bound what a task holds of its rows for Python, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go; the model learns from the labelled ones."""
    bounded(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles with a similarity of 0.8 or more, the smallest doc_id stays."""
    bounded(spark)
    return setsketch.drop_near_copies(docs, k=5, num=80, den=100)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bounded(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: id, token ids, their number and digest, and the digest of the bytes they decode to."""
    bounded(spark)
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", leaks),
    ("byte_bpe", tokens),
]

# Fuzzy matching by learned weights, sketches and byte-pair merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
