"""The job's own measurements as metric samples, kept as files of a table on shared storage."""

from __future__ import annotations

import ast
import json
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.schema import METRIC_SCHEMA

Sample = tuple[datetime, str, dict[str, str], float]


def store_samples(path: str, name: str, samples: list[Sample]) -> None:
    """Write the samples of one batch as one file; the same name again replaces it."""
    store, base = fs.FileSystem.from_uri(path)
    store.create_dir(base, recursive=True)
    lines = [
        json.dumps({"ts": at.astimezone(timezone.utc).isoformat(), "name": key, "labels": labels, "value": value})
        for at, key, labels, value in samples
    ]
    with store.open_output_stream(f"{base}/{name}.json") as out:
        out.write("".join(line + "\n" for line in lines).encode())


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(path)


def end_offsets(source) -> dict[str, int]:
    """Where a source stood after the batch, by partition; empty for sources without such offsets."""
    try:
        held = ast.literal_eval(source.endOffset)  # reported as the text of a dict
    except (TypeError, ValueError, SyntaxError):
        return {}
    # A broker's topics are one level above their partitions.
    if isinstance(held, dict) and held and all(isinstance(v, dict) for v in held.values()):
        held = {f"{topic}-{p}": n for topic, parts in held.items() for p, n in parts.items()}
    return {p: n for p, n in held.items() if isinstance(n, int)} if isinstance(held, dict) else {}


def committed_offsets(samples: DataFrame) -> DataFrame:
    """(src_partition, committed_offset) of the last report of each partition of a source."""
    part = F.col("labels")["src_partition"]
    last = samples.filter(F.col("name") == "source_end_offset").groupBy(part.cast("int").alias("src_partition"))
    return last.agg(F.max_by("value", "ts").cast("long").alias("committed_offset"))


def progress_samples(progress) -> list[Sample]:
    """All measurements of one progress report."""
    at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    labels = {"query": progress.name or ""}
    values = {
        "batch_input_rows": progress.numInputRows,
        "input_rows_per_second": progress.inputRowsPerSecond,
        "processed_rows_per_second": progress.processedRowsPerSecond,
        "batch_duration_ms": progress.batchDuration,
    }
    samples = [(at, "phase_duration_ms", {**labels, "phase": part}, float(ms)) for part, ms in progress.durationMs.items()]
    for name, row in progress.observedMetrics.items():
        for key, value in row.asDict().items():
            values[f"{name}_{key}"] = value
    samples += [(at, name, labels, float(value)) for name, value in values.items() if value is not None]
    for number, source in enumerate(progress.sources):
        samples += [
            (at, "source_end_offset", {**labels, "source": str(number), "src_partition": partition}, float(offset))
            for partition, offset in end_offsets(source).items()
        ]
        samples += [(at, f"source_{key}", labels, float(value)) for key, value in source.metrics.items()]
    return samples


class ProgressSamples(StreamingQueryListener):
    """Stores the samples of every progress report under a folder; nothing is kept on the driver."""

    def __init__(self, path: str) -> None:
        self.path = path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception is not None:
            failed = (datetime.now(timezone.utc), "query_failures", {}, 1.0)
            store_samples(self.path, f"failure-{event.runId}", [failed])

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        store_samples(self.path, f"progress-{progress.runId}-{progress.batchId}", progress_samples(progress))

    def as_table(self, spark: SparkSession) -> DataFrame:
        return read_samples(spark, self.path)
