"""Writers for one micro-batch.  Each is a function (rows, batch_id) and delivers at least once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.config import PipelineConfig
from tidemark.operators import dlq
from tidemark.schema import SINK_FIELDS
from tidemark.sources import table
from tidemark.streaming import committed

Sink = Callable[[DataFrame, int], None]


def table_sink(path: str, layout: str = "rebalance") -> Sink:
    """Append to the month-partitioned table; a replayed batch is appended again."""

    def write(rows: DataFrame, batch_id: int) -> None:
        table.write_rows(table.stored_form(rows), path, layout=layout)

    return write


def idempotent_table_sink(path: str, layout: str = "rebalance") -> Sink:
    """Write each batch to its own folder, so a replay replaces what the first attempt wrote."""

    def write(rows: DataFrame, batch_id: int) -> None:
        stored = table.stored_form(rows)
        target = f"{path}/batch_id={batch_id}"
        table.write_rows(stored, target, mode="overwrite", layout=layout)

    return write


def committed_table_sink(path: str, config: PipelineConfig) -> Sink:
    """Files of bounded size and age, retried, that count once the whole batch is there; a replay replaces it."""

    def write(rows: DataFrame, batch_id: int) -> None:
        committed.write_batch(
            table.stored_form(rows), path, batch_id, config.sink_rows, config.sink_interval_ms, config.sink_retries
        )

    return write


def committed_dlq_sink(path: str, config: PipelineConfig) -> Sink:
    """The envelopes as JSON text, under the same promise."""

    def write(envelopes: DataFrame, batch_id: int) -> None:
        committed.write_batch(
            dlq.encoded(envelopes), path, batch_id, config.sink_rows, config.sink_interval_ms, config.sink_retries
        )

    return write


def jdbc_sink(url: str, target: str, config: PipelineConfig, properties: dict[str, str]) -> Sink:
    """Insert the named columns into a database table; the database adds its own ingest clock."""

    def write(rows: DataFrame, batch_id: int) -> None:
        writer = rows.select(*SINK_FIELDS).write.format("jdbc").mode("append").options(**properties)
        writer.option("url", url).option("dbtable", target).option("batchsize", config.jdbc_batch_size).save()

    return write


def dlq_file_sink(path: str) -> Sink:
    """Append the envelopes as JSON lines."""

    def write(envelopes: DataFrame, batch_id: int) -> None:
        dlq.encoded(envelopes).write.mode("append").text(path)

    return write


def idempotent_dlq_sink(path: str) -> Sink:
    """Write each batch's envelopes to its own folder, so a replay replaces them."""

    def write(envelopes: DataFrame, batch_id: int) -> None:
        dlq.encoded(envelopes).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def dlq_topic_sink(servers: str, topic: str) -> Sink:
    """Send the envelopes to a topic, value only; needs the Kafka package on the cluster."""

    def write(envelopes: DataFrame, batch_id: int) -> None:
        writer = dlq.encoded(envelopes).write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("topic", topic).save()

    return write


def read_dlq_files(spark, path: str) -> DataFrame:
    return dlq.decoded(spark.read.text(path).select("value"))
