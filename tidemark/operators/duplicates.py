"""Intentional duplicates, recovery replays, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix import running_number

SEND = ("producer_run_id", "producer_sequence")


def _copies():
    rows, sends = F.count(F.lit(1)), F.count_distinct(F.col("producer_sequence"))
    return rows.alias("n_rows"), sends.alias("sends"), (rows - sends).alias("replay_copies")


def duplicate_events(telemetry: DataFrame, run_id: str) -> DataFrame:
    """Rows, sends and intentional copies of each event of one run."""
    rows, sends, _ = _copies()
    return (
        telemetry.filter(F.col("producer_run_id") == run_id)
        .groupBy("event_id")
        .agg(rows, sends, F.count_if("injected_duplicate").alias("intentional_copies"))
    )


def first_events(per_event: DataFrame, n: int = 5) -> DataFrame:
    return per_event.orderBy("event_id").limit(n)


def repeated_events(telemetry: DataFrame) -> DataFrame:
    """Every event stored more than once, split into replay and intentional copies."""
    return (
        telemetry.groupBy("producer_run_id", "event_id")
        .agg(*_copies(), F.count_if("injected_duplicate").alias("intentional_copies"))
        .filter("n_rows > 1")
    )


def top_repeated_events(telemetry: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most repeated events, ties by run and event; the limit is the report."""
    return repeated_events(telemetry).orderBy(F.desc("n_rows"), "producer_run_id", "event_id").limit(n)


def replay_rank(telemetry: DataFrame, chunk_ms: int = 60_000) -> DataFrame:
    """Number the stored copies of each send in storage order.

    The number is carried across time chunks, so a send replayed without end still does not become
    one task's work.
    """
    rows = telemetry.select(*SEND, "event_id", "ingested_at")
    block = F.floor(F.unix_millis("ingested_at") / F.lit(chunk_ms))
    return running_number(rows, list(SEND), ["ingested_at", "event_id"], block, "replay_rank")


def without_replays(telemetry: DataFrame) -> DataFrame:
    """One row per send: the copy stored first, deterministically."""
    rest = [c for c in telemetry.columns if c not in (*SEND, "ingested_at")]
    first = F.min(F.struct("ingested_at", *rest)).alias("first")
    return telemetry.groupBy(*SEND).agg(first).select(*SEND, "first.*").select(*telemetry.columns)
