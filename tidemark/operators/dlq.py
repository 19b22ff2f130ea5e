"""Dead-letter envelopes, previews and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import iso_ms
from tidemark.functions.numbers import uniform
from tidemark.functions.text import bounded_detail, preview
from tidemark.schema import DLQ_FIELDS, PIPELINE_VERSION, SOURCE_TOPIC


def envelopes(
    invalid: DataFrame,
    failed_at: Column | None = None,
    source_topic: str = SOURCE_TOPIC,
    *extra: str,
) -> DataFrame:
    """The six envelope columns of each reject, in their fixed order, after any extra columns."""
    clock = F.current_timestamp() if failed_at is None else failed_at
    return invalid.select(
        *extra,
        "raw_payload",
        "error_category",
        bounded_detail(F.col("error_detail")).alias("error_detail"),
        F.lit(source_topic).alias("source_topic"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        iso_ms(clock).alias("failed_at"),
    )


def encoded(dlq: DataFrame, *extra: str) -> DataFrame:
    """The envelopes as compact JSON text in a ``value`` column (no key)."""
    return dlq.select(*extra, F.to_json(F.struct(*DLQ_FIELDS)).alias("value"))


def decoded(values: DataFrame) -> DataFrame:
    """The envelopes in a column ``value`` of JSON text, as columns."""
    fields = ", ".join(f"{name} string" for name in DLQ_FIELDS)
    return values.select(F.from_json("value", fields).alias("d")).select("d.*")


def by_category(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy("error_category").agg(F.count(F.lit(1)).alias("records"))


def head(dlq: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` dead letters in log order; the limit is the report."""
    return dlq.orderBy(*order).limit(n)


def sampled_preview(invalid: DataFrame, key: str, rate: float) -> DataFrame:
    """A repeatable sample of rejects, with text length and the first characters of the text."""
    return invalid.filter(uniform(F.col(key), 18) < F.lit(rate)).select(
        key,
        "error_category",
        "error_detail",
        F.length("raw_payload").cast("long").alias("raw_payload_length"),
        preview(F.col("raw_payload")).alias("raw_payload_preview"),
    )
