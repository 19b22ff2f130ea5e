"""The streaming job: validate arrivals, stamp lateness, store rows, send rejects to the dead-letter sink."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.operators import dlq, validate, watermark
from tidemark.session import configure
from tidemark.sources import capture
from tidemark.streaming import committed, sinks
from tidemark.streaming.progress import store_samples
from tidemark.streaming.state import WatermarkState


@dataclass(frozen=True)
class Paths:
    """Folders of one deployment, all on storage that every executor can reach."""

    root: str

    @property
    def table(self) -> str:
        return f"{self.root}/telemetry"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead-letters"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoints/pipeline"

    @property
    def watermark(self) -> str:
        return f"{self.root}/checkpoints/watermark"

    @property
    def previews(self) -> str:
        return f"{self.root}/reject-previews"

    @property
    def position(self) -> str:
        return f"{self.root}/checkpoints/position/pipeline.json"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def tenant_state(self, generation: int) -> str:
        return f"{self.root}/checkpoints/tenant-state-{generation}"


def system_clock() -> int:
    return int(time.time() * 1_000)


@dataclass
class BatchWriter:
    """Handles one micro-batch: one scan of it, two outputs, and the next watermark state."""

    state: WatermarkState
    rows_sink: sinks.Sink
    dlq_sink: sinks.Sink
    config: PipelineConfig
    clock_ms: Callable[[], int] = system_clock
    metrics_path: str | None = None
    preview_path: str | None = None

    def __call__(self, checked: DataFrame, batch_id: int) -> None:
        now_ms = self.clock_ms()
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = self.state.after(batch_id - 1)
            mark = self.state.watermark(before, now_ms, self.config.out_of_order_ms, self.config.idle_ms)
            late = Observation(f"late-{batch_id}")
            observed = watermark.observe(
                validate.valid_rows(checked), F.lit(mark).cast("long"), event_ms="event_time_ms"
            ).observe(late, F.count_if("is_late").alias("records_late"))
            self.rows_sink(observed, batch_id)
            self.dlq_sink(
                dlq.envelopes(validate.invalid_rows(checked), source_topic=self.config.source_topic), batch_id
            )
            if self.preview_path and self.config.preview_rate > 0:
                key = (F.col("offset") * 65_536 + F.col("src_partition")).alias("position")
                sample = dlq.sampled_preview(
                    validate.invalid_rows(checked, "value", key), "position", self.config.preview_rate
                )
                sample.write.mode("overwrite").json(f"{self.preview_path}/batch_id={batch_id}")
            offered = checked.select(
                "src_partition",
                watermark.contributed_time(F.col("event_time_ms"), F.col("error")).alias("event_ms"),
            )
            self.state.advance(before, offered, batch_id, now_ms, mark)
            if self.metrics_path:
                at = datetime.fromtimestamp(now_ms / 1_000, timezone.utc)
                sample = (at, "records_late", {"batch_id": str(batch_id)}, float(late.get["records_late"]))
                store_samples(self.metrics_path, f"late-{batch_id}", [sample])
        finally:
            checked.unpersist()


def start_pipeline(
    spark: SparkSession,
    arrivals: DataFrame,
    paths: Paths,
    config: PipelineConfig | None = None,
    rows_sink: sinks.Sink | None = None,
    dlq_sink: sinks.Sink | None = None,
    available_now: bool = False,
    clock_ms: Callable[[], int] = system_clock,
) -> StreamingQuery:
    """Start the job on a stream of arrivals (key, value, src_partition, offset).

    Validation is stateless, so nothing is ever dropped for being late.  Offsets are checkpointed
    once per batch; a batch cut short by a failure runs again and its rows may be stored twice,
    unless ``config.idempotent`` gives each batch its own folder.
    """
    configure(spark)
    committed.enable(spark)
    config = config or PipelineConfig()
    if rows_sink is None:
        make = sinks.idempotent_table_sink if config.idempotent else sinks.table_sink
        rows_sink = make(paths.table)
    writer = BatchWriter(
        WatermarkState(spark, paths.watermark),
        rows_sink,
        dlq_sink or (sinks.idempotent_dlq_sink if config.idempotent else sinks.dlq_file_sink)(paths.dead_letters),
        config,
        clock_ms,
        paths.metrics,
        paths.previews,
    )
    checked = validate.validate(arrivals).observe("validation", *validate.outcome_counters())
    stream = checked.writeStream.foreachBatch(writer).option("checkpointLocation", paths.checkpoint)
    timed = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=config.trigger)
    return timed.queryName("pipeline").start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a query work off all that waits, in as many batches as its limits make of it, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def open_capture(spark: SparkSession, path: str, paths: Paths, config: PipelineConfig) -> DataFrame:
    """Captured arrivals as the job's source, under the configured limit for a batch."""
    return capture.captured_topic(spark, path, paths.position, config.max_offsets_per_trigger)


def distinct_sends(observed: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream with repeated sends removed, for a side table.

    Keys are remembered for the watermark delay only and later rows are dropped, so this is never
    put in the path of the main table.
    """
    return observed.withWatermark("produced_at", delay).dropDuplicatesWithinWatermark(
        ["producer_run_id", "producer_sequence"]
    )
