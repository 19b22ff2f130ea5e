"""Queries over structured log lines: one JSON object per line, among lines that are not JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.contract import decode, is_object

BODY = "body"


def parse_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Keep the lines that are JSON objects, with the object as VARIANT in ``body``.

    The one-element explode keeps the filter from being pushed below together with a second decoding.
    """
    return lines.withColumn(BODY, F.expr(f"explode(array({decode(raw)}))")).filter(is_object(BODY))


def text(field: str) -> Column:
    return F.try_variant_get(F.col(BODY), f"$.{field}", "string")


def number(field: str) -> Column:
    return F.try_variant_get(F.col(BODY), f"$.{field}", "long")


def timestamp() -> Column:
    return F.try_to_timestamp(text("timestamp"))


def with_labels(parsed: DataFrame) -> DataFrame:
    """Promote only level and component to columns; everything else stays in the line."""
    return parsed.select("*", text("level").alias("level"), text("component").alias("component"))


def search(
    lines: DataFrame,
    service: str | None = None,
    contains: str | None = None,
    raw: str = "raw",
    **fields: str,
) -> DataFrame:
    """Lines of a service holding a piece of text and having the given field values.

    ``contains`` looks at the line as it is written.  Fields are compared after decoding, since JSON
    may write one value in several ways.
    """
    if service is not None:
        lines = lines.filter(F.col("service") == service)
    if contains is not None:
        lines = lines.filter(F.col(raw).contains(contains))
    parsed = parse_lines(lines, raw)
    for name, value in fields.items():
        parsed = parsed.filter(text(name) == value)
    return parsed


def final_run_log(lines: DataFrame, order: str, event: str = "producer_final") -> DataFrame:
    """The last final record of each run and whether its delivery accounting holds."""
    finals = search(lines, event=event).select(
        text("producer_run_id").alias("producer_run_id"),
        F.struct(
            F.col(order).alias("at"),
            number("attempted").alias("attempted"),
            number("acked").alias("acked"),
            number("failed").alias("failed"),
            number("undelivered").alias("undelivered"),
            F.try_variant_get(F.col(BODY), "$.reconciled", "boolean").alias("reconciled"),
        ).alias("f"),
    )
    last = finals.groupBy("producer_run_id").agg(F.max_by("f", F.col("f.at")).alias("f")).select("producer_run_id", "f.*")
    clean = (F.col("failed") == 0) & (F.col("undelivered") == 0)
    return last.drop("at").select(
        "*",
        ((F.col("attempted") > 0) & (F.col("acked") == F.col("attempted")) & clean & F.col("reconciled")).alias("gate"),
    )


def level_counts(lines: DataFrame, since: Column | None = None) -> DataFrame:
    """Lines per service and level, from a moment on (the retention limit)."""
    parsed = with_labels(parse_lines(lines))
    if since is not None:
        parsed = parsed.filter(timestamp() >= since)
    return parsed.groupBy("service", "level").agg(F.count(F.lit(1)).alias("n_lines"))


def tail_matches(lines: DataFrame, order: list[Column], contains: str, scan: int = 5_000, keep: int = 20) -> DataFrame:
    """The last ``keep`` lines holding a text among the newest ``scan`` lines, with the number matched.

    Both limits are the report: the scan is bounded before anything is counted.
    """
    newest = lines.orderBy(*order).limit(scan)
    matched = newest.filter(F.col("raw").contains(contains))
    return matched.withColumn("matched", F.expr("count(1) over ()")).orderBy(*order).limit(keep)


def encode_lines(rows: DataFrame, fields: list[str], *beside: str) -> DataFrame:
    """Write columns as one compact JSON line with sorted keys, beside the columns named."""
    return rows.select(*beside, F.to_json(F.struct(*sorted(fields))).alias("raw"))
