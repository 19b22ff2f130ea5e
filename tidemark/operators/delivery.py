"""Delivery accounting: attempts matched to acknowledgements, and what the match says per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import uniform

SEND_KEY = ["run_id", "producer_sequence"]


def delivery_log(attempts: DataFrame, callbacks: DataFrame, flushes: DataFrame | None = None) -> DataFrame:
    """Each attempt with its callback.

    An attempt without one is undelivered once its run was flushed, and pending until then: ``flushes`` holds
    run_id and flushed_ms, the moment up to which the sends of a run were flushed, one row for each run flushed
    at all.  Without ``flushes`` every run counts as ended and flushed.
    """
    answered = attempts.join(callbacks, SEND_KEY, "left")
    flushed = F.lit(True)
    if flushes is not None:
        answered = answered.join(flushes.select("run_id", "flushed_ms"), "run_id", "left")
        flushed = F.coalesce(F.col("enqueued_ms") <= F.col("flushed_ms"), F.lit(False))
    silent = F.when(flushed, "undelivered").otherwise("pending")
    status = F.when(F.col("failed").isNull(), silent).when(F.col("failed"), "failed").otherwise("acked")
    latency = F.greatest(F.lit(0), F.col("acked_ms") - F.col("enqueued_ms"))
    return answered.select(
        *attempts.columns,
        "partition",
        "offset",
        "acked_ms",
        status.alias("status"),
        F.when(F.col("acked_ms").isNotNull(), latency).alias("latency_ms"),
        F.coalesce("tx_retries", F.lit(0)).cast("long").alias("tx_retries"),
    )


def count_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def delivery_summary(log: DataFrame) -> DataFrame:
    """Counters of each run; retries are cumulative, so the largest report counts.

    pending sends are those that no counter has settled; a run with any is not reconciled.
    """
    totals = log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("attempted_bytes"),
        count_status("acked").alias("acked"),
        count_status("failed").alias("failed"),
        count_status("undelivered").alias("undelivered"),
        F.max("tx_retries").alias("tx_retries"),
        F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 3).alias("ack_latency_avg_ms"),
        F.round(F.coalesce(F.max("latency_ms"), F.lit(0)).cast("double"), 3).alias("ack_latency_max_ms"),
    )
    settled = F.col("acked") + F.col("failed") + F.col("undelivered")
    return totals.select(
        "*",
        F.greatest(F.lit(0), F.col("attempted") - settled).cast("long").alias("pending"),
        (F.col("attempted") == settled).alias("reconciled"),
    )


def run_gates(summary: DataFrame) -> DataFrame:
    """Whether a run was fully acknowledged, and whether it ended without a delivery failure."""
    clean = (F.col("failed") == 0) & (F.col("undelivered") == 0)
    return summary.select(
        "run_id",
        ((F.col("attempted") > 0) & (F.col("acked") == F.col("attempted")) & clean & F.col("reconciled")).alias(
            "fully_acked"
        ),
        clean.alias("succeeded"),
    )


def partition_distribution(log: DataFrame) -> DataFrame:
    """Acknowledged records and offset range of each partition of each run."""
    return (
        log.filter(F.col("status") == "acked")
        .groupBy("run_id", "partition")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("offset").alias("min_offset"),
            F.max("offset").alias("max_offset"),
        )
    )


def partition_maps(distribution: DataFrame) -> DataFrame:
    """The distribution as two maps per run; a run has at most as many entries as the topic has partitions."""
    entry = F.struct(
        F.col("partition").cast("string").alias("p"),
        F.col("records").alias("n"),
        F.struct(F.col("min_offset").alias("min"), F.col("max_offset").alias("max")).alias("r"),
    )
    rows = distribution.groupBy("run_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return rows.select(
        "run_id",
        F.map_from_arrays(F.col("e.p"), F.col("e.n")).alias("partition_counts"),
        F.map_from_arrays(F.col("e.p"), F.col("e.r")).alias("offset_ranges"),
    )


def interval_throughput(log: DataFrame, seconds: int = 5) -> DataFrame:
    """Attempts and outcomes per interval of each run, and their rates.

    An attempt counts where it was enqueued, an acknowledgement where it came back.
    """
    moments = F.array(
        F.struct(F.lit("attempted").alias("what"), F.col("enqueued_ms").alias("at")),
        F.struct(F.lit("acked").alias("what"), F.col("acked_ms").alias("at")),
        F.struct(
            F.lit("failed").alias("what"),
            F.when(F.col("status") == "failed", F.col("enqueued_ms")).alias("at"),
        ),
    )
    happened = (
        log.select("run_id", F.explode(moments).alias("m")).filter(F.col("m.at").isNotNull())
    ).select("run_id", "m.what", F.timestamp_millis("m.at").alias("at"))
    counted = happened.groupBy("run_id", F.window("at", f"{seconds} seconds").alias("w")).agg(
        *[F.count_if(F.col("what") == w).alias(f"interval_{w}") for w in ("attempted", "acked", "failed")]
    )
    return counted.select(
        "run_id",
        F.col("w.start").alias("interval_start"),
        "interval_attempted",
        "interval_acked",
        "interval_failed",
        F.round(F.col("interval_attempted") / seconds, 3).alias("attempted_per_second"),
        F.round(F.col("interval_acked") / seconds, 3).alias("acked_per_second"),
    )


def delivery_trace(log: DataFrame, rate: float, topic: str) -> DataFrame:
    """A repeatable sample of acknowledged sends with where they landed and how long it took."""
    chosen = uniform(F.col("producer_sequence"), 17) < F.lit(rate)
    return log.filter((F.col("status") == "acked") & chosen).select(
        "run_id",
        "producer_sequence",
        "event_id",
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        F.round(F.col("latency_ms").cast("double"), 3).alias("latency_ms"),
    )


def tx_retries(df: DataFrame, statistics: str = "statistics") -> DataFrame:
    """Retry count in each statistics text: the global number, or the sum over its brokers.

    A text that is not one JSON object has no count: NULL, which is not the same as no retries.
    """
    doc = F.try_parse_json(F.col(statistics))

    def numeric(value: Column) -> Column:
        plain = F.schema_of_variant(value).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")
        return F.when(plain, F.greatest(F.lit(0), F.try_variant_get(value, "$", "double").cast("long")))

    brokers = F.try_variant_get(doc, "$.brokers", "map<string,variant>")
    per_broker = F.transform(
        F.map_values(brokers),
        lambda b: F.coalesce(numeric(F.try_variant_get(b, "$.txretries", "variant")), F.lit(0).cast("long")),
    )
    total = F.aggregate(per_broker, F.lit(0).cast("long"), lambda acc, n: acc + n)
    none = F.when(F.startswith(F.schema_of_variant(doc), F.lit("OBJECT<")), F.lit(0).cast("long"))
    return df.withColumn(
        "tx_retries", F.coalesce(numeric(F.try_variant_get(doc, "$.txretries", "variant")), total, none)
    )


def reported_retries(df: DataFrame, statistics: str = "statistics") -> DataFrame:
    """The largest cumulative retry count each run reported; unreadable reports do not count."""
    return tx_retries(df, statistics).groupBy("run_id").agg(F.max("tx_retries").alias("tx_retries"))
