"""Analytical views over the stored telemetry table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import elapsed_ms, start_of_minute
from tidemark.operators.quantiles import grouped_quantiles
from tidemark.schema import HOT_TENANT

STAGE_DELAYS = {
    "event_age": ("event_time", "produced_at"),
    "kafka_flink": ("produced_at", "processed_at"),
    "sink": ("processed_at", "ingested_at"),
    "end_to_end": ("produced_at", "ingested_at"),
}


def rows_and_events(rows_name: str = "total_rows") -> list[Column]:
    rows, unique = F.count(F.lit(1)), F.count_distinct(F.col("event_id"))
    return [rows.alias(rows_name), unique.alias("unique_event_ids"), (rows - unique).alias("duplicate_rows")]


def pipeline_health(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(
        *rows_and_events(),
        F.min("event_time").alias("earliest_event_time"),
        F.max("event_time").alias("latest_event_time"),
        F.max("produced_at").alias("latest_produced_at"),
        F.max("processed_at").alias("latest_processed_at"),
        F.max("ingested_at").alias("latest_ingested_at"),
        F.count_if("injected_late").alias("injected_late_rows"),
        F.count_if("is_late").alias("observed_late_rows"),
    )


def between(df: DataFrame, column: str, start: Column | None, end: Column | None) -> DataFrame:
    """Keep start <= column < end.  The bare column is compared, so files can be skipped by it."""
    if start is not None:
        df = df.filter(F.col(column) >= start)
    if end is not None:
        df = df.filter(F.col(column) < end)
    return df


def throughput_per_minute(
    telemetry: DataFrame, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Counts per ingest minute; ``start`` and ``end`` should be whole minutes."""
    rows = between(telemetry, "ingested_at", start, end)
    return rows.groupBy(start_of_minute(F.col("ingested_at")).alias("minute")).agg(
        *rows_and_events("rows_received"),
        F.count_if("injected_late").alias("injected_late_rows"),
        F.count_if("is_late").alias("observed_late_rows"),
    )


def latency_quantiles(
    telemetry: DataFrame,
    mode: str = "sketch",
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """p50, p95 and p99 of the four stage delays per ingest minute."""
    rows = between(telemetry, "ingested_at", start, end).withColumn("minute", start_of_minute(F.col("ingested_at")))
    delays = {name: elapsed_ms(F.col(a), F.col(b)) for name, (a, b) in STAGE_DELAYS.items()}
    wide = grouped_quantiles(rows, ["minute"], delays, mode=mode)
    return wide.select("minute", *[F.col(c).alias(f"{c}_ms") for c in wide.columns if c != "minute"])


def minutes_with_latency(telemetry: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """How many minutes of the range have latency data: a check for a live pipeline."""
    minutes = between(telemetry, "ingested_at", start, end).select(
        start_of_minute(F.col("ingested_at")).alias("minute")
    )
    return minutes.agg(F.count_distinct("minute").alias("latency_minutes"))


def data_quality(telemetry: DataFrame) -> DataFrame:
    claimed, observed = F.col("injected_late"), F.col("is_late")
    return telemetry.agg(
        *rows_and_events(),
        F.count_if("injected_duplicate").alias("injected_duplicate_rows"),
        F.count_if(claimed).alias("injected_late_rows"),
        F.count_if(observed).alias("observed_late_rows"),
        F.count_if(claimed & observed).alias("injected_and_observed_late_rows"),
        F.count_if(claimed & ~observed).alias("injected_not_observed_late_rows"),
        F.count_if(~claimed & observed).alias("unexpected_observed_late_rows"),
    )


def lateness_matrix(telemetry: DataFrame, mode: str = "sketch") -> DataFrame:
    """Row counts and lateness quantiles for each claimed/observed combination."""
    keys = ["injected_late", "is_late"]
    lateness = {"lateness_ms": F.col("lateness_ms")}
    return grouped_quantiles(telemetry, keys, lateness, mode=mode, count_as="n_rows", block=65_536).orderBy(*keys)


def anomaly_summary(telemetry: DataFrame, run_id: str) -> DataFrame:
    rows = telemetry.filter(F.col("producer_run_id") == run_id)
    return rows.agg(
        F.count_if("injected_duplicate").alias("duplicate_rows"),
        F.count_if("injected_late").alias("injected_late_rows"),
        F.count_if("is_late").alias("observed_late_rows"),
        F.count_if(F.col("tenant_id") == HOT_TENANT).alias("hot_rows"),
        F.count_if(F.col("watermark_at_arrival").isNotNull()).alias("watermark_rows"),
        F.count_if(reversed_timeline()).alias("reversed_timeline_rows"),
    )


def reversed_timeline() -> Column:
    """A row processed before it was produced, or stored before it was processed."""
    return (F.col("processed_at") < F.col("produced_at")) | (F.col("ingested_at") < F.col("processed_at"))


def rows_by_run(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("producer_run_id").agg(F.count(F.lit(1)).alias("n_rows"))


def tenant_counts(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_rows(telemetry: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` rows stored last, ties by run and sequence; the limit is the report."""
    order = [F.desc("ingested_at"), F.desc("producer_run_id"), F.desc("producer_sequence")]
    return telemetry.orderBy(*order).limit(n)


VIEWS = {
    "pipeline_health": pipeline_health,
    "throughput_per_minute": throughput_per_minute,
    "latency_quantiles": latency_quantiles,
    "data_quality": data_quality,
}


def register_views(telemetry: DataFrame) -> None:
    """Make the four views available to SQL, replacing older definitions."""
    for name, build in VIEWS.items():
        build(telemetry).createOrReplaceTempView(name)
