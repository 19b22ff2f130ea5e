"""Named queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PipelineConfig
from tidemark.functions import clock, lateness, numbers, text
from tidemark.functions.numbers import text_hash
from tidemark.operators import (
    delivery,
    dlq,
    duplicates,
    keyed,
    logs,
    metrics,
    placement,
    reconcile,
    skew,
    summaries,
    validate,
    views,
    watermark,
)
from tidemark.plans import datasets as data
from tidemark.plans import duck
from tidemark.schema import ARRIVAL_SCHEMA, HOT_TENANT, REQUIRED_FIELDS, SINK_FIELDS, SOURCE_TOPIC, TABLE_SCHEMA
from tidemark.session import checkpoint_root, materialize
from tidemark.sources import capture, file_index, table, topics
from tidemark.streaming import committed, progress, sinks, tenant_state
from tidemark.streaming.pipeline import Paths, drain, open_capture, start_pipeline
from tidemark.streaming.running_count import start_running_count

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    oracle: str | None


QUERIES: dict[str, Query] = {}

# A fixed moment inside the events, standing in for "now" where a query needs one.
NOW = datetime(2024, 1, 20)
FAILED_AT = "2026-08-23 12:00:00Z"
BLOCK = data.ARRIVAL_BLOCK


def report(df: DataFrame) -> DataFrame:
    """Timestamps leave as zone-free UTC values, so they read the same under any reader's zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


def query(name: str, oracle: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = Query(lambda spark, sf_dir: report(build(spark, sf_dir)), oracle)
        return build

    return register


def instant(when: datetime):
    return F.lit(when.isoformat(sep=" ") + "Z").cast("timestamp")


# ---------------------------------------------------------------- stored table


@query(
    "pipeline_health",
    duck.over_telemetry("""
SELECT count(*) AS total_rows, count(DISTINCT event_id) AS unique_event_ids,
  count(*) - count(DISTINCT event_id) AS duplicate_rows,
  min(event_time) AS earliest_event_time, max(event_time) AS latest_event_time,
  max(produced_at) AS latest_produced_at, max(processed_at) AS latest_processed_at,
  max(ingested_at) AS latest_ingested_at,
  count(*) FILTER (injected_late) AS injected_late_rows, count(*) FILTER (is_late) AS observed_late_rows
FROM telemetry"""),
)
def pipeline_health(spark, sf_dir):
    return views.pipeline_health(data.telemetry(spark, sf_dir))


@query(
    "throughput_per_minute",
    duck.over_telemetry("""
SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS rows_received,
  count(DISTINCT event_id) AS unique_event_ids, count(*) - count(DISTINCT event_id) AS duplicate_rows,
  count(*) FILTER (injected_late) AS injected_late_rows, count(*) FILTER (is_late) AS observed_late_rows
FROM telemetry GROUP BY 1"""),
)
def throughput_per_minute(spark, sf_dir):
    return views.throughput_per_minute(data.telemetry(spark, sf_dir))


def quantile_columns(name: str, value: str) -> str:
    return ", ".join(
        f"round(quantile_cont({value}, {p}), 3) AS {name}_p{round(p * 100)}_ms" for p in (0.5, 0.95, 0.99)
    )


def ms_between(a: str, b: str) -> str:
    return f"epoch_us({b}) // 1000 - epoch_us({a}) // 1000"


LATENCY_COLUMNS = ", ".join(quantile_columns(n, ms_between(a, b)) for n, (a, b) in views.STAGE_DELAYS.items())


@query(
    "latency_quantiles",
    duck.over_telemetry(f"SELECT date_trunc('minute', ingested_at) AS minute, {LATENCY_COLUMNS} FROM telemetry GROUP BY 1"),
)
def latency_quantiles(spark, sf_dir):
    return views.latency_quantiles(data.telemetry(spark, sf_dir), mode="exact")


@query("latency_quantiles_sketch")
def latency_quantiles_sketch(spark, sf_dir):
    return views.latency_quantiles(data.telemetry(spark, sf_dir), mode="sketch")


@query(
    "latency_summaries",
    duck.over_telemetry("""
SELECT date_trunc('hour', ingested_at) AS hour, count(*) AS n_rows, true AS p50_within, true AS p95_within, true AS p99_within
FROM telemetry GROUP BY 1"""),
)
def latency_summaries(spark, sf_dir):
    """Hourly quantiles from stored minute summaries: is each one's rank within the promised error?"""
    hour = F.date_trunc("hour", "minute")
    start, end = views.STAGE_DELAYS["end_to_end"]
    delay = {"end_to_end": clock.elapsed_ms(F.col(start), F.col(end))}
    rows = data.telemetry(spark, sf_dir).withColumn("minute", F.date_trunc("minute", "ingested_at"))
    stored = materialize(summaries.summarize(rows, ["minute"], delay), "minute-summaries")
    found = summaries.quantiles(summaries.merge(stored, {"hour": hour}, ["end_to_end"]), ["hour"], ["end_to_end"])
    off = summaries.rank_errors(rows.withColumn("hour", hour), ["hour"], "end_to_end", delay["end_to_end"], found)
    within = [(F.col(f"end_to_end_p{p}_error") <= summaries.RANK_ERROR).alias(f"p{p}_within") for p in (50, 95, 99)]
    return found.join(off, "hour").select("hour", "n_rows", *within)


@query(
    "latency_series",
    duck.over_telemetry(f"""
SELECT date_trunc('minute', ingested_at) AS minute, {quantile_columns('end_to_end', ms_between('produced_at', 'ingested_at'))}
FROM telemetry WHERE ingested_at >= TIMESTAMP '2024-01-19' AND ingested_at < TIMESTAMP '2024-01-20' GROUP BY 1 ORDER BY 1"""),
)
def latency_series(spark, sf_dir):
    day = views.latency_quantiles(
        data.telemetry(spark, sf_dir), mode="exact", start=instant(datetime(2024, 1, 19)), end=instant(NOW)
    )
    return day.select("minute", *[f"end_to_end_p{p}_ms" for p in (50, 95, 99)]).orderBy("minute")


@query(
    "latency_minutes_recent",
    duck.over_telemetry("""
SELECT count(DISTINCT date_trunc('minute', ingested_at)) AS latency_minutes
FROM telemetry WHERE ingested_at >= TIMESTAMP '2024-01-19 00:00:00'"""),
)
def latency_minutes_recent(spark, sf_dir):
    return views.minutes_with_latency(data.telemetry(spark, sf_dir), instant(datetime(2024, 1, 19)))


@query(
    "data_quality",
    duck.over_telemetry("""
SELECT count(*) AS total_rows, count(DISTINCT event_id) AS unique_event_ids,
  count(*) - count(DISTINCT event_id) AS duplicate_rows,
  count(*) FILTER (injected_duplicate) AS injected_duplicate_rows,
  count(*) FILTER (injected_late) AS injected_late_rows, count(*) FILTER (is_late) AS observed_late_rows,
  count(*) FILTER (injected_late AND is_late) AS injected_and_observed_late_rows,
  count(*) FILTER (injected_late AND NOT is_late) AS injected_not_observed_late_rows,
  count(*) FILTER (NOT injected_late AND is_late) AS unexpected_observed_late_rows
FROM telemetry"""),
)
def data_quality(spark, sf_dir):
    return views.data_quality(data.telemetry(spark, sf_dir))


@query(
    "lateness_matrix",
    duck.over_telemetry("""
SELECT injected_late, is_late, count(*) AS n_rows,
  round(quantile_cont(lateness_ms, 0.5), 3) AS lateness_ms_p50,
  round(quantile_cont(lateness_ms, 0.95), 3) AS lateness_ms_p95,
  round(quantile_cont(lateness_ms, 0.99), 3) AS lateness_ms_p99
FROM telemetry GROUP BY ALL ORDER BY ALL"""),
)
def lateness_matrix(spark, sf_dir):
    return views.lateness_matrix(data.telemetry(spark, sf_dir), mode="exact")


@query(
    "duplicate_events_for_run",
    duck.over_telemetry("""
SELECT event_id, count(*) AS n_rows, count(DISTINCT producer_sequence) AS sends,
  count(*) FILTER (injected_duplicate) AS intentional_copies
FROM telemetry WHERE producer_run_id = 'run-1' GROUP BY event_id"""),
)
def duplicate_events_for_run(spark, sf_dir):
    return duplicates.duplicate_events(data.telemetry(spark, sf_dir), "run-1")


@query(
    "first_events_of_run",
    duck.over_telemetry("""
SELECT event_id, count(*) AS n_rows, count(DISTINCT producer_sequence) AS sends,
  count(*) FILTER (injected_duplicate) AS intentional_copies
FROM telemetry WHERE producer_run_id = 'run-0' GROUP BY event_id ORDER BY event_id LIMIT 5"""),
)
def first_events_of_run(spark, sf_dir):
    return duplicates.first_events(duplicates.duplicate_events(data.telemetry(spark, sf_dir), "run-0"))


REPEATED = """
SELECT producer_run_id, event_id, count(*) AS n_rows, count(DISTINCT producer_sequence) AS sends,
  count(*) - count(DISTINCT producer_sequence) AS replay_copies,
  count(*) FILTER (injected_duplicate) AS intentional_copies
FROM telemetry GROUP BY ALL HAVING n_rows > 1"""


@query(
    "replay_duplicates",
    duck.over_telemetry(REPEATED + " ORDER BY n_rows DESC, producer_run_id, event_id LIMIT 20"),
)
def replay_duplicates(spark, sf_dir):
    return duplicates.top_repeated_events(data.telemetry(spark, sf_dir))


@query("repeated_events", duck.over_telemetry(REPEATED))
def repeated_events(spark, sf_dir):
    return duplicates.repeated_events(data.telemetry(spark, sf_dir))


@query(
    "replay_rank",
    duck.over_telemetry("""
SELECT producer_run_id, producer_sequence, event_id, ingested_at,
  row_number() OVER (PARTITION BY producer_run_id, producer_sequence ORDER BY ingested_at) AS replay_rank
FROM telemetry"""),
)
def replay_rank(spark, sf_dir):
    return duplicates.replay_rank(data.telemetry(spark, sf_dir))


@query(
    "dedup_sends",
    duck.over_telemetry("""
SELECT producer_run_id, producer_sequence, event_id, tenant_id, produced_at, ingested_at FROM telemetry
QUALIFY row_number() OVER (PARTITION BY producer_run_id, producer_sequence ORDER BY ingested_at) = 1"""),
)
def dedup_sends(spark, sf_dir):
    wanted = ["producer_run_id", "producer_sequence", "event_id", "tenant_id", "produced_at", "ingested_at"]
    return duplicates.without_replays(data.telemetry(spark, sf_dir).select(*wanted))


@query(
    "anomaly_summary",
    duck.over_telemetry("""
SELECT count(*) FILTER (injected_duplicate) AS duplicate_rows, count(*) FILTER (injected_late) AS injected_late_rows,
  count(*) FILTER (is_late) AS observed_late_rows, count(*) FILTER (tenant_id = 'tenant-hot') AS hot_rows,
  count(*) FILTER (watermark_at_arrival IS NOT NULL) AS watermark_rows,
  count(*) FILTER (processed_at < produced_at OR ingested_at < processed_at) AS reversed_timeline_rows
FROM telemetry WHERE producer_run_id = 'run-0'"""),
)
def anomaly_summary(spark, sf_dir):
    return views.anomaly_summary(data.telemetry(spark, sf_dir), "run-0")


@query("rows_by_run", duck.over_telemetry("SELECT producer_run_id, count(*) AS n_rows FROM telemetry GROUP BY 1"))
def rows_by_run(spark, sf_dir):
    return views.rows_by_run(data.telemetry(spark, sf_dir))


@query("tenant_counts", duck.over_telemetry("SELECT tenant_id, count(*) AS n_rows FROM telemetry GROUP BY 1"))
def tenant_counts(spark, sf_dir):
    return views.tenant_counts(data.telemetry(spark, sf_dir))


@query(
    "salted_tenant_counts",
    duck.over_telemetry("""
SELECT tenant_id, count(*) AS n_rows, count(DISTINCT event_id) AS unique_event_ids FROM telemetry GROUP BY 1"""),
)
def salted_tenant_counts(spark, sf_dir):
    return keyed.salted_counts(data.telemetry(spark, sf_dir))


LATEST = ["producer_run_id", "producer_sequence", "event_id", "tenant_id", "ingested_at", "is_late"]


@query(
    "latest_rows",
    duck.over_telemetry(f"""
SELECT {", ".join(LATEST)} FROM telemetry
ORDER BY ingested_at DESC, producer_run_id DESC, producer_sequence DESC LIMIT 5"""),
)
def latest_rows(spark, sf_dir):
    return views.latest_rows(data.telemetry(spark, sf_dir)).select(*LATEST)


@query(
    "pruned_month_scan",
    duck.over_telemetry("""
SELECT ym, tenant_id, count(*) AS n_rows, min(event_time) AS first_event, max(event_time) AS last_event
FROM telemetry WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20' GROUP BY ALL"""),
)
def pruned_month_scan(spark, sf_dir):
    chosen = table.between(stored_table(spark, sf_dir), datetime(2024, 1, 10), NOW)
    return chosen.groupBy("ym", "tenant_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event")
    )


def written_table(spark: SparkSession, sf_dir: str) -> str:
    """A new folder with the telemetry in the table's layout."""
    path = f"{checkpoint_root(spark)}/telemetry-table-{uuid.uuid4().hex}"
    table.write_rows(table.stored_form(data.telemetry(spark, sf_dir)), path, layout="cluster")
    return path


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry written in the table's layout to a new folder, and read back."""
    return table.read_table(spark, written_table(spark, sf_dir))


@query(
    "table_zone_map",
    duck.over_telemetry("""
SELECT ym, count(*) AS n_rows, min(event_time) AS min_event_time, max(event_time) AS max_event_time, min(tenant_id) AS min_tenant,
  max(tenant_id) AS max_tenant FROM telemetry GROUP BY 1"""),
)
def table_zone_map(spark, sf_dir):
    """What file footers say of each month of the stored table."""
    index = file_index.build(spark, written_table(spark, sf_dir))
    return index.groupBy("ym").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("min_event_time").alias("min_event_time"),
        F.max("max_event_time").alias("max_event_time"),
        F.min("min_tenant").alias("min_tenant"),
        F.max("max_tenant").alias("max_tenant"),
    )


@query(
    "indexed_range",
    duck.over_telemetry("""
SELECT event_id, count(*) AS n_rows FROM telemetry
WHERE tenant_id = 'tenant-003' AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-12' GROUP BY 1"""),
)
def indexed_range(spark, sf_dir):
    """Two days of one tenant, from the files whose footers allow it."""
    path = written_table(spark, sf_dir)
    found = file_index.read(spark, path, file_index.build(spark, path), datetime(2024, 1, 10), datetime(2024, 1, 12), "tenant-003")
    return found.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("table_files")
def table_files(spark, sf_dir):
    return table.recent_files(stored_table(spark, sf_dir))


# ------------------------------------------------------------------ validation

TYPED_COLUMNS = """schema_version, producer_run_id, producer_sequence, produced_at, event_id, tenant_id, device_id,
  metric_name, metric_value, event_time, region, firmware, injected_duplicate, injected_late"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(data.raw(spark, sf_dir))


@query(
    "validated_rows",
    duck.over_judged(f"SELECT {TYPED_COLUMNS}, epoch_us(event_time) // 1000 AS event_time_ms FROM typed"),
)
def validated_rows(spark, sf_dir):
    return validate.valid_rows(judged(spark, sf_dir))


def failed_at():
    return F.lit(FAILED_AT).cast("timestamp")


DLQ_SELECT = f"""
SELECT raw_payload, error_category, error_detail, '{SOURCE_TOPIC}' AS source_topic, '1.0.0' AS pipeline_version,
  '2026-08-23T12:00:00.000Z' AS failed_at FROM rejects"""


@query("dlq_records", duck.over_judged(DLQ_SELECT))
def dlq_records(spark, sf_dir):
    return dlq.envelopes(validate.invalid_rows(judged(spark, sf_dir)), failed_at())


@query(
    "dlq_encoded",
    duck.over_judged(f"""
SELECT '{{"raw_payload":' || CAST(to_json(raw_payload) AS VARCHAR) || ',"error_category":"' || error_category
  || '","error_detail":"' || error_detail || '","source_topic":"{SOURCE_TOPIC}","pipeline_version":"1.0.0"'
  || ',"failed_at":"2026-08-23T12:00:00.000Z"}}' AS value FROM rejects"""),
)
def dlq_encoded(spark, sf_dir):
    return dlq.encoded(dlq_records(spark, sf_dir))


@query("dlq_by_category", duck.over_judged("SELECT error_category, count(*) AS records FROM rejects GROUP BY 1"))
def dlq_by_category(spark, sf_dir):
    return dlq.by_category(validate.invalid_rows(judged(spark, sf_dir)))


@query(
    "dlq_head",
    duck.over_judged("""
SELECT src_partition, arrival, raw_payload, error_category FROM rejects ORDER BY src_partition, arrival LIMIT 20"""),
)
def dlq_head(spark, sf_dir):
    rejects = validate.invalid_rows(judged(spark, sf_dir), "value", "src_partition", "arrival")
    return dlq.head(rejects.drop("error_detail"), ["src_partition", "arrival"])


@query(
    "invalid_preview",
    duck.over_judged(f"""
SELECT arrival, error_category, error_detail, length(raw_payload) AS raw_payload_length,
  left(raw_payload, 160) AS raw_payload_preview
FROM rejects WHERE {duck.mix("arrival", 18)} / 2147483647.0::DOUBLE < 0.05::DOUBLE"""),
)
def invalid_preview(spark, sf_dir):
    return dlq.sampled_preview(validate.invalid_rows(judged(spark, sf_dir), "value", "arrival"), "arrival", 0.05)


@query(
    "validation_counters",
    duck.over_judged("""
SELECT count(*) AS records_seen, count(*) FILTER (error_category IS NULL) AS records_valid,
  count(*) FILTER (error_category IS NOT NULL) AS records_invalid,
  count(*) FILTER (error_category = 'invalid_json') AS invalid_invalid_json,
  count(*) FILTER (error_category = 'missing_field') AS invalid_missing_field,
  count(*) FILTER (error_category = 'invalid_type') AS invalid_invalid_type,
  count(*) FILTER (error_category = 'invalid_timestamp') AS invalid_invalid_timestamp
FROM judged"""),
)
def validation_counters(spark, sf_dir):
    return validate.validation_counters(judged(spark, sf_dir))


# ------------------------------------------------------- watermark and lateness


def offered(checked: DataFrame) -> DataFrame:
    return checked.select(
        "batch_id",
        "batch_ms",
        "src_partition",
        watermark.contributed_time(F.col("event_time_ms"), F.col("error")).alias("event_ms"),
    )


@query("arrival_watermark", duck.over_marks("SELECT batch_id, batch_ms, watermark_ms FROM marks"))
def arrival_watermark(spark, sf_dir):
    return watermark.arrival_watermark(offered(judged(spark, sf_dir)))


@query(
    "row_watermark",
    duck.over_row_marks("""
SELECT arrival, src_partition, watermark_ms, coalesce(event_ms <= watermark_ms, false) AS is_late FROM row_marks"""),
)
def row_watermark(spark, sf_dir):
    offer = watermark.contributed_time(F.col("event_time_ms"), F.col("error")).alias("event_ms")
    rows = judged(spark, sf_dir).select("arrival", "src_partition", F.col("batch_ms").alias("at_ms"), offer)
    marked = watermark.row_watermark(rows)
    return marked.select(
        "arrival", "src_partition", "watermark_ms", lateness.is_late(F.col("event_ms"), F.col("watermark_ms")).alias("is_late")
    )


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Checked once and stored typed: the watermarks and the rows both come from it, without the texts.
    checked = materialize(judged(spark, sf_dir).drop("value", "key"), "judged")
    eid = F.col("eid")
    processed = clock.from_epoch_ms(F.col("sent_ms") + 50 + eid % 400)
    valid = validate.valid_rows(checked, "batch_id", "eid", "sent_ms")
    return watermark.observe_batches(valid, watermark.arrival_watermark(offered(checked)), processed)


SINK_COLUMNS = f"{TYPED_COLUMNS}, processed_at, watermark_at_arrival, is_late, lateness_ms"


@query("observed_rows", duck.over_observed(f"SELECT {SINK_COLUMNS} FROM observed"))
def observed_rows(spark, sf_dir):
    return observed(spark, sf_dir).select(*SINK_FIELDS)


@query("late_rows", duck.over_observed(f"SELECT {SINK_COLUMNS} FROM observed WHERE is_late"))
def late_rows(spark, sf_dir):
    return watermark.late_rows(observed(spark, sf_dir))


@query(
    "observed_lateness_counts",
    duck.over_observed("""
SELECT injected_late, is_late, count(*) AS n_rows, CAST(sum(lateness_ms) AS BIGINT) AS total_lateness_ms
FROM observed GROUP BY ALL"""),
)
def observed_lateness_counts(spark, sf_dir):
    return observed(spark, sf_dir).groupBy("injected_late", "is_late").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("lateness_ms").alias("total_lateness_ms")
    )


# ---------------------------------------------------------------- streaming runs


def captured(spark: SparkSession, sf_dir: str) -> tuple[Paths, str]:
    """The raw sends captured by partition and offset in a new folder, for the streaming queries to read."""
    root = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    rows = data.raw(spark, sf_dir).selectExpr("key", "value", "src_partition", "arrival AS offset")
    capture.write_capture(rows, f"{root}/arrivals")
    return Paths(root), f"{root}/arrivals"


def in_thirds(spark: SparkSession, folder: str) -> PipelineConfig:
    """Settings under which a batch takes a third of all offsets, so that every stream here has several batches."""
    whole = topics.end_offset_sum(spark.read.parquet(folder)).first()[0]
    return PipelineConfig(trigger="0 seconds", max_offsets_per_trigger=whole // 3 + 1)


def run_pipeline(spark: SparkSession, sf_dir: str) -> Paths:
    """The whole capture through the job, rows and dead letters in committed batches."""
    paths, folder = captured(spark, sf_dir)
    config = in_thirds(spark, folder)
    stream = open_capture(spark, folder, paths, config)
    rows_sink = sinks.committed_table_sink(paths.table, config)
    dlq_sink = sinks.committed_dlq_sink(paths.dead_letters, config)
    drain(start_pipeline(spark, stream, paths, config, rows_sink, dlq_sink))
    return paths


def streamed_table(spark: SparkSession, paths: Paths) -> DataFrame:
    return committed.read_committed(spark, paths.table, TABLE_SCHEMA)


def streamed_letters(spark: SparkSession, paths: Paths) -> DataFrame:
    return dlq.decoded(committed.read_committed(spark, paths.dead_letters, "value string"))


@query("streamed_rows", duck.over_judged(f"SELECT {TYPED_COLUMNS} FROM typed"))
def streamed_rows(spark, sf_dir):
    return streamed_table(spark, run_pipeline(spark, sf_dir)).select(*REQUIRED_FIELDS)


@query(
    "streamed_reconciliation",
    duck.over_judged("""
SELECT count(*) AS attempted, count(*) AS captured, count(*) FILTER (error_category IS NULL) AS stored,
  count(*) FILTER (error_category IS NOT NULL) AS rejected, true AS captured_all, true AS accounted_all FROM judged"""),
)
def streamed_reconciliation(spark, sf_dir):
    paths = run_pipeline(spark, sf_dir)
    return reconcile.reconcile(
        data.attempts(spark, sf_dir),
        spark.read.schema(ARRIVAL_SCHEMA).parquet(f"{paths.root}/arrivals"),
        streamed_table(spark, paths),
        streamed_letters(spark, paths),
    )


@query(
    "streamed_dlq",
    duck.over_judged(f"""
SELECT raw_payload, error_category, error_detail, '{SOURCE_TOPIC}' AS source_topic FROM rejects"""),
)
def streamed_dlq(spark, sf_dir):
    letters = streamed_letters(spark, run_pipeline(spark, sf_dir))
    return letters.select("raw_payload", "error_category", "error_detail", "source_topic")


@query(
    "streamed_lag",
    duck.over_admitted("""
SELECT src_partition, past AS end_offset, CAST(done AS BIGINT) AS committed_offset, CAST(past - done AS BIGINT) AS lag FROM taken"""),
)
def streamed_lag(spark, sf_dir):
    """What is left of each source partition when the job is stopped after its first batch."""
    paths, folder = captured(spark, sf_dir)
    config = in_thirds(spark, folder)
    # Without a trigger interval a run takes what is admitted at its start, and ends.
    run = start_pipeline(spark, open_capture(spark, folder, paths, config), paths, config, available_now=True)
    run.awaitTermination()
    progress.store_samples(paths.metrics, "last-progress", progress.progress_samples(run.lastProgress))
    done = progress.committed_offsets(progress.read_samples(spark, paths.metrics))
    return topics.consumer_lag(capture.captured_ends(spark, folder), done)


@query(
    "streamed_tenant_numbers",
    duck.over_judged("""
SELECT tenant_id, producer_sequence, row_number() OVER (PARTITION BY tenant_id ORDER BY arrival) AS tenant_record_count FROM typed"""),
)
def streamed_tenant_numbers(spark, sf_dir):
    paths, folder = captured(spark, sf_dir)
    config = in_thirds(spark, folder)
    out = f"{paths.root}/numbered"

    def keep(rows: DataFrame, batch_id: int) -> None:
        kept = rows.select("tenant_id", "producer_sequence", "tenant_record_count")
        committed.write_batch(kept, out, batch_id, config.sink_rows, config.sink_interval_ms, config.sink_retries)

    stream = open_capture(spark, folder, paths, config)
    drain(start_running_count(spark, stream, f"{paths.root}/checkpoints/numbers", keep, config.trigger))
    return committed.read_committed(spark, out, "tenant_id string, producer_sequence long, tenant_record_count long")


@query(
    "streamed_batches",
    duck.over_admitted("""
SELECT j.error_category IS NULL AS valid, j.arrival < t.done AS first_batch, count(*) AS records
FROM judged j JOIN taken t USING (src_partition) GROUP BY ALL"""),
)
def streamed_batches(spark, sf_dir):
    """How many rows and dead letters the first batch committed, and how many all later ones."""
    paths = run_pipeline(spark, sf_dir)

    def counted(path: str, valid: bool) -> DataFrame:
        by_batch = committed.commits(spark, path).groupBy((F.col("batch_id") == 0).alias("first_batch"))
        return by_batch.agg(F.sum("n_rows").alias("records")).withColumn("valid", F.lit(valid)).filter("records > 0")

    both = counted(paths.table, True).unionByName(counted(paths.dead_letters, False))
    return both.select("valid", "first_batch", "records")


@query(
    "hot_state_value",
    duck.over_judged("""
SELECT tenant_id, count(*) AS tenant_record_count FROM typed WHERE tenant_id = 'tenant-hot' GROUP BY 1"""),
)
def hot_state_value(spark, sf_dir):
    paths, folder = captured(spark, sf_dir)
    checkpoint = paths.tenant_state(0)
    config = in_thirds(spark, folder)
    drain(
        tenant_state.start_tenant_state(
            spark, open_capture(spark, folder, paths, config), checkpoint, f"{checkpoint}-output",
            trigger=config.trigger, partitions=spark.sparkContext.defaultParallelism,
        )
    )
    return tenant_state.state_value(spark, checkpoint)


# --------------------------------------------------------- keyed counts and skew


def tenant_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.raw(spark, sf_dir).select(F.col("key").alias("tenant_id"), "arrival", "src_partition")


RUNNING = "row_number() OVER (PARTITION BY key ORDER BY arrival) AS tenant_record_count"


@query(
    "running_tenant_count",
    duck.over_raw(f"SELECT key AS tenant_id, arrival, src_partition, {RUNNING} FROM raw"),
)
def running_tenant_count(spark, sf_dir):
    return keyed.running_tenant_count(
        tenant_arrivals(spark, sf_dir), ["arrival"], F.expr(f"arrival div {BLOCK}")
    )


@query(
    "hot_tenant_milestones",
    duck.over_raw(f"""
SELECT tenant_id, arrival, src_partition, tenant_record_count
FROM (SELECT key AS tenant_id, arrival, src_partition, {RUNNING} FROM raw)
WHERE tenant_id = 'tenant-hot' AND regexp_full_match(CAST(tenant_record_count AS VARCHAR), '10*')"""),
)
def hot_tenant_milestones(spark, sf_dir):
    rows = tenant_arrivals(spark, sf_dir).filter(F.col("tenant_id") == HOT_TENANT)
    counted = keyed.running_tenant_count(rows, ["arrival"], F.expr(f"arrival div {BLOCK}"))
    return keyed.hot_milestones(counted)


@query(
    "source_partition_skew",
    duck.over_raw("""
SELECT src_partition, tenant_id, records,
  CAST(sum(records) OVER (PARTITION BY src_partition) AS BIGINT) AS partition_records,
  round(records / sum(records) OVER (), 6) AS share,
  round(sum(records) OVER (PARTITION BY src_partition) / sum(records) OVER (), 6) AS partition_share
FROM (SELECT src_partition, key AS tenant_id, count(*) AS records FROM raw GROUP BY ALL)"""),
)
def source_partition_skew(spark, sf_dir):
    return skew.source_partition_skew(data.raw(spark, sf_dir))


@query(
    "key_partition_invariant",
    duck.over_raw("""
SELECT key AS tenant_id, count(DISTINCT src_partition) AS partitions, count(DISTINCT src_partition) = 1 AS single_partition
FROM raw GROUP BY 1"""),
)
def key_partition_invariant(spark, sf_dir):
    return skew.key_partition_invariant(data.raw(spark, sf_dir))


TENANT_HASH = "('0x' || left(md5(tenant_id), 7))::BIGINT"


@query(
    "partition_load_before_after",
    duck.over_arrivals("""
SELECT 'as_read' AS stage, CAST(src_partition AS INTEGER) AS partition_index, count(*) AS records FROM arrivals GROUP BY 2
UNION ALL SELECT 'by_key', CAST(('0x' || left(md5(key), 7))::BIGINT % 4 AS INTEGER), count(*) FROM arrivals GROUP BY 2"""),
)
def partition_load_before_after(spark, sf_dir):
    arrived = data.arrivals(spark, sf_dir)
    return skew.partition_load(arrived, "key", 4, F.col("src_partition"), text_hash(F.col("key")))


@query(
    "keyed_load",
    duck.over_telemetry(f"""
SELECT CAST({TENANT_HASH} % 4 AS INTEGER) AS subtask, count(*) AS records,
  count(*) FILTER (tenant_id = 'tenant-hot') AS hot_records FROM telemetry GROUP BY 1"""),
)
def keyed_load(spark, sf_dir):
    return skew.keyed_load(data.telemetry(spark, sf_dir), hashed=text_hash(F.col("tenant_id")))


@query(
    "hot_owner_check",
    duck.over_telemetry(f"""
SELECT CAST(sum(n) AS BIGINT) AS records, count(*) FILTER (hot > 0) AS owners,
  CAST(coalesce(max(CASE WHEN hot > 0 THEN n END), 0) AS BIGINT) AS owner_records,
  count(*) FILTER (hot > 0) = 1 AS single_owner,
  2 * coalesce(max(CASE WHEN hot > 0 THEN n END), 0) > sum(n) AS owner_has_majority
FROM (SELECT {TENANT_HASH} % 4 AS subtask,
        count(*) AS n, count(*) FILTER (tenant_id = 'tenant-hot') AS hot FROM telemetry GROUP BY 1)"""),
)
def hot_owner_check(spark, sf_dir):
    return skew.hot_owner_check(keyed_load(spark, sf_dir))


# The tenants of the table, cut and placed as operators/placement.py says, one item after the other.
PLACED = f"""
WITH RECURSIVE counts AS (SELECT tenant_id, count(*) AS n FROM telemetry GROUP BY 1),
whole AS (SELECT sum(n) AS total FROM counts),
items AS (
  SELECT 'k' || tenant_id AS item, n, CAST(ceil(n * 4 / total) AS BIGINT) AS pieces FROM counts, whole WHERE n * 64 >= total
  UNION ALL SELECT 'b' || {TENANT_HASH} % 64, CAST(sum(n) AS BIGINT), 1 FROM counts, whole WHERE n * 64 < total GROUP BY 1
),
cut AS (SELECT item, p AS piece, n // pieces + CASE WHEN p < n % pieces THEN 1 ELSE 0 END AS records
  FROM items, unnest(range(pieces)) u(p)),
turns AS (SELECT *, row_number() OVER (ORDER BY records DESC, item, piece) AS turn FROM cut),
steps AS (
  SELECT CAST(0 AS BIGINT) AS turn, [0::BIGINT, 0, 0, 0] AS loads, CAST(0 AS BIGINT) AS owner
  UNION ALL
  SELECT t.turn, list_transform(s.loads, lambda x, i: CASE WHEN i = list_position(s.loads, list_min(s.loads)) THEN x + t.records ELSE x END),
    list_position(s.loads, list_min(s.loads)) - 1
  FROM steps s JOIN turns t ON t.turn = s.turn + 1
)
SELECT t.item, CAST(t.piece AS INTEGER) AS piece, t.records, CAST(s.owner AS INTEGER) AS owner
FROM turns t JOIN steps s USING (turn)"""


@query("placement_plan", duck.over_telemetry(PLACED.replace("WITH RECURSIVE", ",", 1)).replace("WITH ", "WITH RECURSIVE ", 1))
def placement_plan(spark, sf_dir):
    return placement.plan(data.telemetry(spark, sf_dir), "tenant_id", 4, text_hash)


@query("placed_load")
def placed_load(spark, sf_dir):
    """Records of each owner once every row was given its own; event hashes deal the rows of a split tenant."""
    rows = data.telemetry(spark, sf_dir).select("tenant_id", "event_id")
    owned = placement.with_owner(rows, placement_plan(spark, sf_dir), "tenant_id", "event_id", 4, text_hash)
    return owned.groupBy("owner").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("tenant_id").alias("tenants"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.metric_samples(spark, sf_dir)


# Events lie minutes apart in the given tables, so ranges here are hours: one, four, and a day.
HOUR = 3_600
QUARTER = 900


def window_start(seconds: int):
    return F.timestamp_seconds(F.floor(F.unix_seconds("ts") / F.lit(seconds)) * F.lit(seconds))


def duck_window(seconds: int) -> str:
    return f"make_timestamp((epoch_us(ts) // {seconds * 1_000_000}) * {seconds * 1_000_000})"


@query(
    "subtask_coverage",
    duck.over_metrics(f"""
SELECT name, {duck_window(6 * HOUR)} AS window_start, count(DISTINCT subtask) AS reported,
  concat_ws(',', CASE WHEN count(*) FILTER (subtask = 0) = 0 THEN '0' END, CASE WHEN count(*) FILTER (subtask = 1) = 0 THEN '1' END,
    CASE WHEN count(*) FILTER (subtask = 2) = 0 THEN '2' END, CASE WHEN count(*) FILTER (subtask = 3) = 0 THEN '3' END) AS missing
FROM samples WHERE subtask IS NOT NULL GROUP BY ALL"""),
)
def subtask_coverage(spark, sf_dir):
    readings = samples(spark, sf_dir).select(
        "name", window_start(6 * HOUR).alias("window_start"), metrics.label("subtask_index").cast("int").alias("subtask")
    )
    return skew.subtask_coverage(readings.filter("subtask IS NOT NULL"), ["name", "window_start"])


@query(
    "shuffle_check",
    duck.over_metrics(f"""
SELECT {duck_window(24 * HOUR)} AS window_start,
  coalesce(max(CASE WHEN name = '{data.LOCAL_BYTES}' THEN value END), 0) > 0 AS local_moving,
  count(*) FILTER (name = '{data.REMOTE_BYTES}' AND value <> 0) = 0 AS remote_silent
FROM samples WHERE name IN ('{data.LOCAL_BYTES}', '{data.REMOTE_BYTES}') GROUP BY 1"""),
)
def shuffle_check(spark, sf_dir):
    name = F.col("name")
    recent = samples(spark, sf_dir).filter(name.isin(data.LOCAL_BYTES, data.REMOTE_BYTES)).select(
        window_start(24 * HOUR).alias("window_start"),
        F.when(name == data.LOCAL_BYTES, F.col("value")).alias("local_recent"),
        F.when(name == data.REMOTE_BYTES, F.col("value")).alias("remote_recent"),
    )
    return skew.shuffle_check(recent, ["window_start"])


EVIDENCE_OF = {
    data.KEYED_TOTAL: "keyed_records",
    data.HOT_STATE: "hot_state",
    data.LOCAL_BYTES: "local_recent",
    data.REMOTE_BYTES: "remote_recent",
}


def evidence(spark: SparkSession, sf_dir: str, seconds: int = 24 * HOUR) -> DataFrame:
    """Per window: the largest value each subtask reported for each kind of evidence."""
    name = F.col("name")
    kind = F.coalesce(*[F.when(name == metric, F.lit(k)) for metric, k in EVIDENCE_OF.items()])
    readings = (
        samples(spark, sf_dir)
        .filter(name.isin(*EVIDENCE_OF))
        .groupBy(
            window_start(seconds).alias("window_start"),
            kind.alias("reading"),
            metrics.label("subtask_index").cast("int").alias("subtask"),
        )
        .agg(F.max("value").alias("value"))
    )
    return skew.evidence_maps(readings, "window_start")


def duck_reported(kind: str) -> str:
    return f"list_sort(list(subtask) FILTER (kind = '{kind}'))"


def duck_list(items: str) -> str:
    return f"""'[' || array_to_string(list_transform({items}, lambda x: '''' || x || ''''), ', ') || ']'"""


def duck_map(kind: str, keep: str = "true") -> str:
    entries = f"list('''' || subtask || ''': ' || CAST(value AS VARCHAR) ORDER BY subtask) FILTER (kind = '{kind}' AND {keep})"
    return f"'{{' || coalesce(array_to_string({entries}, ', '), '') || '}}'"


DUCK_COVERAGE = ",\n    ".join(
    f"CASE WHEN coalesce({duck_reported(kind)}, []) <> [0, 1, 2, 3] THEN '{skew.EVIDENCE_TITLE[kind]} subtasks are ' || "
    f"""{duck_list(f"coalesce({duck_reported(kind)}, [])")} || ', expected [''0'', ''1'', ''2'', ''3'']' END"""
    for kind in skew.EVIDENCE
)


@query(
    "verification_errors",
    duck.over_metrics(f"""
, readings AS (
  SELECT {duck_window(24 * HOUR)} AS window_start, CASE name WHEN '{data.KEYED_TOTAL}' THEN 'keyed_records'
      WHEN '{data.HOT_STATE}' THEN 'hot_state' WHEN '{data.LOCAL_BYTES}' THEN 'local_recent'
      ELSE 'remote_recent' END AS kind, CAST(subtask AS INTEGER) AS subtask, max(value) AS value
  FROM samples WHERE name IN ({", ".join("'" + n + "'" for n in EVIDENCE_OF)}) GROUP BY ALL
),
summed AS (
  SELECT *, sum(CASE WHEN kind = 'keyed_records' THEN value END) OVER (PARTITION BY window_start) AS keyed_total,
    max(CASE WHEN kind = 'keyed_records' THEN value END) OVER (PARTITION BY window_start, subtask) AS own_keyed
  FROM readings
)
SELECT window_start, concat_ws(' | ',
    {DUCK_COVERAGE},
    CASE WHEN count(*) FILTER (kind = 'hot_state' AND value > 0) <> 1
      THEN 'expected exactly one positive tenant-hot state gauge, found ' || count(*) FILTER (kind = 'hot_state' AND value > 0)
        || ' (' || {duck_list("coalesce(list(subtask ORDER BY subtask) FILTER (kind = 'hot_state' AND value > 0), [])")} || ')' END,
    CASE WHEN count(*) FILTER (kind = 'hot_state' AND value > 0 AND coalesce(own_keyed, 0) > keyed_total / 2) = 0
      THEN 'expected the tenant-hot owner to process a majority of records; found ' || {duck_map("keyed_records")} END,
    CASE WHEN count(*) FILTER (kind = 'local_recent' AND value > 0) = 0
      THEN 'recent local shuffle rates contain no positive byte rate' END,
    CASE WHEN count(*) FILTER (kind = 'remote_recent' AND value <> 0) > 0
      THEN 'recent remote shuffle rates are not zero: ' || {duck_map("remote_recent", "value <> 0")} END) AS errors
FROM summed GROUP BY window_start"""),
)
def verification_errors(spark, sf_dir):
    checked = skew.verification_errors(evidence(spark, sf_dir))
    return checked.select("window_start", F.array_join("errors", " | ").alias("errors"))


# ------------------------------------------------------------- delivery accounting


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delivery_log(data.attempts(spark, sf_dir), data.callbacks(spark, sf_dir), data.flushes(spark, sf_dir))


@query(
    "delivery_log",
    duck.over_delivery("""
SELECT run_id, producer_sequence, event_id, payload_bytes, enqueued_ms, "partition", "offset", acked_ms, status,
  latency_ms, tx_retries FROM delivery"""),
)
def delivery_log(spark, sf_dir):
    return delivered(spark, sf_dir)


SUMMARY = """
SELECT run_id, count(*) AS attempted, CAST(sum(payload_bytes) AS BIGINT) AS attempted_bytes,
  count(*) FILTER (status = 'acked') AS acked, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'undelivered') AS undelivered, max(tx_retries) AS tx_retries,
  round(coalesce(avg(latency_ms), 0), 3) AS ack_latency_avg_ms,
  round(CAST(coalesce(max(latency_ms), 0) AS DOUBLE), 3) AS ack_latency_max_ms,
  count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'pending') = 0 AS reconciled
FROM delivery GROUP BY 1"""


@query("delivery_summary", duck.over_delivery(SUMMARY))
def delivery_summary(spark, sf_dir):
    return delivery.delivery_summary(delivered(spark, sf_dir))


@query(
    "run_gates",
    duck.over_delivery("""
SELECT run_id, count(*) > 0 AND bool_and(status = 'acked') AS fully_acked, count(*) FILTER (status IN ('failed', 'undelivered')) = 0 AS succeeded
FROM delivery GROUP BY 1"""),
)
def run_gates(spark, sf_dir):
    return delivery.run_gates(delivery_summary(spark, sf_dir))


@query(
    "partition_distribution",
    duck.over_delivery("""
SELECT run_id, "partition", count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset
FROM delivery WHERE status = 'acked' GROUP BY ALL"""),
)
def partition_distribution(spark, sf_dir):
    return delivery.partition_distribution(delivered(spark, sf_dir))


@query(
    "interval_throughput",
    duck.over_delivery("""
, moments AS (
  SELECT run_id, 'attempted' AS what, enqueued_ms AS moment FROM delivery
  UNION ALL SELECT run_id, 'acked', acked_ms FROM delivery WHERE acked_ms IS NOT NULL
  UNION ALL SELECT run_id, 'failed', enqueued_ms FROM delivery WHERE status = 'failed'
)
SELECT run_id, make_timestamp((moment // 5000) * 5000000) AS interval_start,
  count(*) FILTER (what = 'attempted') AS interval_attempted, count(*) FILTER (what = 'acked') AS interval_acked,
  count(*) FILTER (what = 'failed') AS interval_failed,
  round(count(*) FILTER (what = 'attempted') / 5, 3) AS attempted_per_second,
  round(count(*) FILTER (what = 'acked') / 5, 3) AS acked_per_second
FROM moments GROUP BY ALL"""),
)
def interval_throughput(spark, sf_dir):
    return delivery.interval_throughput(delivered(spark, sf_dir))


@query(
    "delivery_trace_sample",
    duck.over_delivery(f"""
SELECT run_id, producer_sequence, event_id, '{SOURCE_TOPIC}' AS topic, "partition", "offset",
  round(CAST(latency_ms AS DOUBLE), 3) AS latency_ms
FROM delivery WHERE status = 'acked' AND {duck.mix("producer_sequence", 17)} / 2147483647.0::DOUBLE < 0.01::DOUBLE"""),
)
def delivery_trace_sample(spark, sf_dir):
    return delivery.delivery_trace(delivered(spark, sf_dir), 0.01, SOURCE_TOPIC)


RETRIES = """
SELECT run_id, eid, CAST(CASE user_id % 6 WHEN 0 THEN v WHEN 1 THEN v + v % 7 WHEN 2 THEN v WHEN 4 THEN v ELSE 0 END AS BIGINT) AS tx_retries FROM statistics"""


@query("tx_retries", duck.query(RETRIES, duck.BASE, duck.STATISTICS))
def tx_retries(spark, sf_dir):
    return delivery.tx_retries(data.client_statistics(spark, sf_dir)).drop("statistics")


@query(
    "reported_retries",
    duck.query(f"SELECT run_id, max(tx_retries) AS tx_retries FROM ({RETRIES}) GROUP BY 1", duck.BASE, duck.STATISTICS),
)
def reported_retries(spark, sf_dir):
    return delivery.reported_retries(data.client_statistics(spark, sf_dir))


# ------------------------------------------------------------------ reconciliation


@query(
    "reconciliation",
    duck.over_judged("""
SELECT count(*) AS attempted, count(*) AS captured, count(*) FILTER (error_category IS NULL) AS stored,
  count(*) FILTER (error_category IS NOT NULL) AS rejected, true AS captured_all, true AS accounted_all FROM judged"""),
)
def reconciliation(spark, sf_dir):
    return reconcile.reconcile_validated(data.attempts(spark, sf_dir), judged(spark, sf_dir))


@query(
    "observation_gates",
    duck.over_telemetry("""
SELECT producer_run_id, count(*) AS n_rows, count(DISTINCT producer_sequence) AS unique_sends,
  count(*) FILTER (injected_duplicate) > 0 AND count(*) FILTER (injected_late) > 0 AND count(*) FILTER (is_late) > 0
    AND count(*) FILTER (tenant_id = 'tenant-hot') > 0 AND count(*) FILTER (watermark_at_arrival IS NOT NULL) > 0 AS anomalies_seen,
  count(*) FILTER (processed_at < produced_at OR ingested_at < processed_at) = 0 AS timeline_ordered,
  count(*) >= count(DISTINCT producer_sequence) AS rows_cover_sends
FROM telemetry GROUP BY 1"""),
)
def observation_gates(spark, sf_dir):
    return reconcile.observation_gates(data.telemetry(spark, sf_dir))


@query(
    "no_loss",
    duck.over_telemetry("""
SELECT producer_run_id, s.sends, t.n_rows, t.unique_sends, t.unique_sends = s.sends AS no_loss
FROM (SELECT producer_run_id, count(*) AS sends FROM sends GROUP BY 1) s
JOIN (SELECT producer_run_id, count(*) AS n_rows, count(DISTINCT producer_sequence) AS unique_sends FROM telemetry GROUP BY 1) t
  USING (producer_run_id)"""),
)
def no_loss(spark, sf_dir):
    return reconcile.no_loss(data.telemetry(spark, sf_dir), data.sends(spark, sf_dir))


# ------------------------------------------------------------------------ offsets


@query(
    "end_offset_sum",
    duck.over_arrivals("""
SELECT CAST(sum(e) AS BIGINT) AS end_offset_sum FROM (SELECT max("offset") + 1 AS e FROM arrivals GROUP BY src_partition)"""),
)
def end_offset_sum(spark, sf_dir):
    return topics.end_offset_sum(data.arrivals(spark, sf_dir))


@query(
    "consumer_lag",
    duck.over_arrivals("""
SELECT src_partition, max("offset") + 1 AS end_offset,
  coalesce(max("offset") FILTER (batch_ms < 5000000) + 1, 0) AS committed_offset,
  max("offset") + 1 - coalesce(max("offset") FILTER (batch_ms < 5000000) + 1, 0) AS lag
FROM arrivals GROUP BY 1"""),
)
def consumer_lag(spark, sf_dir):
    arrived = data.arrivals(spark, sf_dir)
    done = topics.end_offsets(arrived.filter(F.col("batch_ms") < 5_000_000))
    return topics.consumer_lag(
        topics.end_offsets(arrived), done.withColumnRenamed("end_offset", "committed_offset")
    )


# ------------------------------------------------------------------------- metrics

CHANGES = """
, stepped AS (
  SELECT *, lag(value) OVER (PARTITION BY name, labels_key ORDER BY ts) AS previous
  FROM series WHERE name LIKE 'pipeline_%_total'
),
steps AS (
  SELECT *, CASE WHEN value < previous THEN value ELSE value - previous END AS step FROM stepped WHERE previous IS NOT NULL
),
changes AS (
  SELECT name, labels_key, {window} AS window_start, round(sum(step), 6) AS increase, round(sum(step) / {seconds}, 6) AS rate
  FROM steps GROUP BY ALL
)
"""
# Moments of a 15-minute grid whose look-back holds a sample.
MOMENTS = """generate_series(
    CAST(ceil(epoch_us(ts) / 900000000.0::DOUBLE) AS BIGINT) * 900,
    CAST(ceil((epoch_us(ts) + {seconds} * 1000000::BIGINT) / 900000000.0::DOUBLE) AS BIGINT) * 900 - 900, 900)"""


def duck_changes(select: str, seconds: int) -> str:
    return duck.over_metrics(CHANGES.format(window=duck_window(seconds), seconds=f"{seconds}.0::DOUBLE") + select)


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.select_series(samples(spark, sf_dir), "pipeline_.*_total")


@query("counter_rate", duck_changes("SELECT name, labels_key, window_start, increase, rate FROM changes", HOUR))
def counter_rate(spark, sf_dir):
    return metrics.counter_change(counters(spark, sf_dir), HOUR)


@query(
    "counter_increase",
    duck_changes("SELECT name, labels_key, window_start, increase FROM changes WHERE increase > 0", 4 * HOUR),
)
def counter_increase(spark, sf_dir):
    return metrics.counters_increased(counters(spark, sf_dir), 4 * HOUR)


@query(
    "counter_rate_sliding",
    duck_changes(
        f"""
, spread AS (SELECT name, labels_key, step, unnest({MOMENTS.format(seconds=HOUR)}) AS at_s FROM steps)
SELECT name, labels_key, make_timestamp(at_s * 1000000) AS at, round(sum(step), 6) AS increase,
  round(round(sum(step), 6) / {HOUR}.0::DOUBLE, 6) AS rate FROM spread GROUP BY ALL""",
        HOUR,
    ),
)
def counter_rate_sliding(spark, sf_dir):
    return metrics.counter_change(counters(spark, sf_dir), HOUR, every=QUARTER)


@query(
    "rate_by_job",
    duck_changes(
        f"""
SELECT name, job, {duck_window(HOUR)} AS window_start, round(sum(step) / {HOUR}.0::DOUBLE, 6) AS sum_rate FROM steps GROUP BY ALL""",
        HOUR,
    ),
)
def rate_by_job(spark, sf_dir):
    return metrics.rate_by(counters(spark, sf_dir), ["job"], HOUR)


@query(
    "max_over_time_sliding",
    duck.over_metrics(f"""
, spread AS (SELECT name, labels_key, value, unnest({MOMENTS.format(seconds=4 * HOUR)}) AS at_s
  FROM series WHERE name LIKE 'pipeline_shuffle_%')
SELECT name, labels_key, make_timestamp(at_s * 1000000) AS at, max(value) AS max_value FROM spread GROUP BY ALL"""),
)
def max_over_time_sliding(spark, sf_dir):
    chosen = metrics.select_series(samples(spark, sf_dir), "pipeline_shuffle_.*")
    return metrics.max_over_time(chosen, 4 * HOUR, every=QUARTER)


@query(
    "gauge_deriv",
    duck.over_metrics(f"""
SELECT name, labels_key, {duck_window(4 * HOUR)} AS window_start,
  round(regr_slope(value, epoch_us(ts) / 1000000.0::DOUBLE - epoch_us({duck_window(4 * HOUR)}) / 1000000.0::DOUBLE), 6) AS slope
FROM series WHERE name = '{data.PENDING}' AND NOT isnan(value) GROUP BY 1, 2, 3 HAVING count(*) > 1"""),
)
def gauge_deriv(spark, sf_dir):
    return metrics.slope(metrics.select_series(samples(spark, sf_dir), data.PENDING), 4 * HOUR)


@query(
    "max_over_time",
    duck.over_metrics(f"""
SELECT name, labels_key, {duck_window(4 * HOUR)} AS window_start, max(value) AS max_value
FROM series WHERE name LIKE 'pipeline_shuffle_%' GROUP BY ALL"""),
)
def max_over_time(spark, sf_dir):
    return metrics.max_over_time(metrics.select_series(samples(spark, sf_dir), "pipeline_shuffle_.*"), 4 * HOUR)


@query(
    "sum_by_label",
    duck.over_metrics("""
SELECT name, ts, CAST(subtask AS VARCHAR) AS subtask_index, sum(value) AS sum_value, max(value) AS max_value
FROM samples WHERE NOT isnan(value) GROUP BY ALL"""),
)
def sum_by_label(spark, sf_dir):
    return metrics.aggregate_by(samples(spark, sf_dir), ["subtask_index"])


@query(
    "regex_series",
    duck.over_metrics("""
SELECT name, job, count(*) AS samples FROM samples
WHERE regexp_full_match(name, '(?:up|pipeline_.*_count)') AND regexp_full_match(job, '(?:broker|stream-.+)') GROUP BY ALL"""),
)
def regex_series(spark, sf_dir):
    chosen = metrics.select_series(samples(spark, sf_dir), "up|pipeline_.*_count", job="broker|stream-.+")
    return chosen.groupBy("name", metrics.label("job").alias("job")).agg(F.count(F.lit(1)).alias("samples"))


@query(
    "instant_vector",
    duck.over_metrics(f"""
SELECT CAST(subtask AS VARCHAR) AS subtask, max(ts) AS ts, arg_max(value, ts) AS value FROM series
WHERE name = '{data.PENDING}' AND subtask IS NOT NULL GROUP BY subtask, labels_key HAVING NOT isnan(arg_max(value, ts))"""),
)
def instant_vector(spark, sf_dir):
    return metrics.instant_vector(samples(spark, sf_dir), data.PENDING)


@query(
    "sum_or_zero",
    duck.over_metrics("""
SELECT 'down' AS what, coalesce(sum(1 - value), 0.0)::DOUBLE AS total FROM samples WHERE name = 'up'
UNION ALL SELECT 'failed', coalesce(sum(value), 0.0)::DOUBLE FROM samples WHERE name = 'pipeline_failed_queries_total'"""),
)
def sum_or_zero(spark, sf_dir):
    """How often a target was down, and the failures of a metric that nothing reports."""
    down = metrics.select_series(samples(spark, sf_dir), data.UP).withColumn("value", 1 - F.col("value"))
    failed = metrics.select_series(samples(spark, sf_dir), "pipeline_failed_queries_total")
    named = [metrics.sum_or_zero(rows).select(F.lit(what).alias("what"), "total") for what, rows in (("down", down), ("failed", failed))]
    return named[0].unionByName(named[1])


@query(
    "watermark_lag",
    duck.over_metrics(f"""
SELECT ts, CAST(subtask AS VARCHAR) AS subtask, round(max((epoch_us(ts) // 1000 - value) / 1000), 3) AS lag_seconds
FROM samples WHERE name = '{data.INPUT_WATERMARK}' GROUP BY ALL"""),
)
def watermark_lag(spark, sf_dir):
    return metrics.watermark_lag(metrics.select_series(samples(spark, sf_dir), data.INPUT_WATERMARK))


@query(
    "alerts_held",
    duck.over_metrics("""
, flagged AS (
  SELECT name, labels_key, ts, value = 0 AS holds,
    sum(CASE WHEN value = 0 AND NOT silent THEN 0 ELSE 1 END) OVER (PARTITION BY name, labels_key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS span
  FROM (SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY name, labels_key ORDER BY ts)) > 43200000000, false) AS silent
    FROM series WHERE name = 'up')
)
SELECT name, labels_key, min(ts) AS active_from, min(ts) + INTERVAL 1 HOUR AS fires_at, max(ts) AS active_to, count(*) AS samples
FROM flagged WHERE holds GROUP BY name, labels_key, span
HAVING epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000 >= 3600"""),
)
def alerts_held(spark, sf_dir):
    up = metrics.select_series(samples(spark, sf_dir), data.UP)
    return metrics.alerts_held(up, F.col("value") == 0, HOUR, stale_seconds=12 * HOUR)


@query(
    "missing_targets",
    duck.over_metrics(f"""
, latest AS (
  SELECT {duck_window(12 * HOUR)} AS window_start, job, arg_max(value, ts) AS value FROM samples WHERE name = 'up' GROUP BY 1, 2
)
SELECT window_start, count(*) FILTER (value = 1) AS targets_up,
  concat_ws(',', {", ".join(f"CASE WHEN count(*) FILTER (job = '{j}' AND value = 1) = 0 THEN '{j}' END" for j in data.JOBS)}) AS missing
FROM latest GROUP BY 1"""),
)
def missing_targets(spark, sf_dir):
    return metrics.target_health(metrics.select_series(samples(spark, sf_dir), data.UP), data.JOBS, 12 * HOUR)


@query(
    "forbidden_labels",
    duck.over_metrics("""
SELECT name, count(*) AS samples, count(*) FILTER (runtime_id IS NOT NULL) AS leaky_samples FROM samples GROUP BY 1"""),
)
def forbidden_labels(spark, sf_dir):
    return metrics.forbidden_labels(samples(spark, sf_dir))


# ---------------------------------------------------------------------------- logs


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.log_lines(spark, sf_dir)


@query("log_labels", duck.over_logs("SELECT eid, service, level, component FROM log_docs"))
def log_labels(spark, sf_dir):
    return logs.with_labels(logs.parse_lines(lines(spark, sf_dir))).select("eid", "service", "level", "component")


@query(
    "log_query",
    duck.over_logs("""
SELECT eid, service, CAST(json_extract_string(raw, '$.raw_payload_length') AS BIGINT) AS raw_payload_length FROM log_docs
WHERE service = 'stream-executor' AND json_extract_string(raw, '$.message') = 'invalid_record_routed_to_dlq'"""),
)
def log_query(spark, sf_dir):
    found = logs.search(lines(spark, sf_dir), service="stream-executor", message=data.REJECT_MESSAGE)
    return found.select("eid", "service", logs.number("raw_payload_length").alias("raw_payload_length"))


@query(
    "log_query_escaped",
    duck.over_logs("""
SELECT eid, service, json_extract_string(raw, '$.message') AS message FROM log_docs
WHERE json_extract_string(raw, '$.message') IN ('said "stop"', 'café open')"""),
)
def log_query_escaped(spark, sf_dir):
    written = lines(spark, sf_dir)
    found = [logs.search(written, message=m) for m in ('said "stop"', "café open")]
    return found[0].unionByName(found[1]).select("eid", "service", logs.text("message").alias("message"))


@query(
    "final_run_log",
    duck.over_logs("""
, finals AS (
  SELECT json_extract_string(raw, '$.producer_run_id') AS producer_run_id, eid,
    CAST(json_extract_string(raw, '$.attempted') AS BIGINT) AS attempted, CAST(json_extract_string(raw, '$.acked') AS BIGINT) AS acked,
    CAST(json_extract_string(raw, '$.failed') AS BIGINT) AS failed, CAST(json_extract_string(raw, '$.undelivered') AS BIGINT) AS undelivered,
    json_extract_string(raw, '$.reconciled') = 'true' AS reconciled
  FROM log_docs WHERE json_extract_string(raw, '$.event') = 'producer_final'
)
SELECT producer_run_id, attempted, acked, failed, undelivered, reconciled,
  attempted > 0 AND acked = attempted AND failed = 0 AND undelivered = 0 AND reconciled AS gate
FROM finals QUALIFY row_number() OVER (PARTITION BY producer_run_id ORDER BY eid DESC) = 1"""),
)
def final_run_log(spark, sf_dir):
    return logs.final_run_log(lines(spark, sf_dir), "eid")


@query(
    "log_levels",
    duck.over_logs("""
SELECT service, level, count(*) AS n_lines FROM log_docs
WHERE CAST(rtrim(json_extract_string(raw, '$.timestamp'), 'Z') AS TIMESTAMP) >= TIMESTAMP '2024-01-19' GROUP BY ALL"""),
)
def log_levels(spark, sf_dir):
    return logs.level_counts(lines(spark, sf_dir), instant(datetime(2024, 1, 19)))


@query(
    "log_tail_matches",
    duck.over_logs("""
, newest AS (SELECT * FROM log_lines ORDER BY eid DESC LIMIT 5000)
SELECT eid, service, raw, count(*) OVER () AS matched FROM newest WHERE contains(raw, 'keyed_state_milestone')
ORDER BY eid DESC LIMIT 20"""),
)
def log_tail_matches(spark, sf_dir):
    return logs.tail_matches(lines(spark, sf_dir), [F.desc("eid")], data.MILESTONE_MESSAGE)


@query(
    "savepoint_paths",
    duck.over_logs("SELECT eid, 'file:///ckpt/sp-' || eid AS path FROM log_lines WHERE eid % 10 = 6"),
)
def savepoint_paths(spark, sf_dir):
    found = lines(spark, sf_dir).select("eid", text.last_savepoint_path(F.col("raw")).alias("path"))
    return found.filter("path IS NOT NULL")


@query(
    "log_encode",
    duck.over_telemetry("""
SELECT producer_sequence, ingested_at, '{"event":"stored","level":"INFO","tenant_id":"' || tenant_id || '"}' AS raw FROM telemetry"""),
)
def log_encode(spark, sf_dir):
    rows = data.telemetry(spark, sf_dir).withColumns({"event": F.lit("stored"), "level": F.lit("INFO")})
    return logs.encode_lines(rows, ["tenant_id", "level", "event"], "producer_sequence", "ingested_at")


# ---------------------------------------------------------------- scalar functions


@query(
    "clock_functions",
    duck.over_telemetry(f"""
SELECT producer_sequence, ingested_at, date_trunc('minute', ingested_at) AS minute, strftime(event_time, '%Y%m') AS ym,
  epoch_us(event_time) // 1000 AS event_ms, {ms_between("event_time", "produced_at")} AS age_ms,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_iso_ms, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_iso_us,
  round(metric_value, 1) AS rounded, isfinite(metric_value) AS finite,
  regexp_full_match(CAST(producer_sequence AS VARCHAR), '10*') AS milestone
FROM telemetry"""),
)
def clock_functions(spark, sf_dir):
    event = F.col("event_time")
    return data.telemetry(spark, sf_dir).select(
        "producer_sequence",
        "ingested_at",
        clock.start_of_minute(F.col("ingested_at")).alias("minute"),
        clock.year_month(event).alias("ym"),
        clock.epoch_ms(event).alias("event_ms"),
        clock.elapsed_ms(event, F.col("produced_at")).alias("age_ms"),
        clock.iso_ms(event).alias("event_iso_ms"),
        clock.iso_us(event).alias("event_iso_us"),
        F.round("metric_value", 1).alias("rounded"),
        numbers.is_finite(F.col("metric_value")).alias("finite"),
        numbers.is_decimal_milestone(F.col("producer_sequence")).alias("milestone"),
    )


@query(
    "bounded_details",
    duck.over_raw("""
SELECT arrival, CASE WHEN length(d) > 256 THEN left(d, 253) || '...' ELSE d END AS detail
FROM (SELECT arrival, trim(replace(replace(value, ',"', chr(13) || chr(10)), chr(13) || chr(10), ' ')) AS d FROM raw)"""),
)
def bounded_details(spark, sf_dir):
    broken = F.replace(F.col("value"), F.lit(',"'), F.lit("\r\n"))
    return data.raw(spark, sf_dir).select("arrival", text.bounded_detail(broken).alias("detail"))


def queries() -> dict[str, Build]:
    return {name: q.build for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in QUERIES.items() if q.oracle}
