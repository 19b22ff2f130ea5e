"""Arrival watermarks per source partition, and the lateness verdict they give.

Definition, batch by batch: each source partition contributes the largest event time it delivered
in *preceding* batches, as long as it delivered something within ``idle_ms`` of this batch.  The
watermark is the smallest contribution minus the allowed disorder, and never moves back.  It is NULL
until a preceding batch exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import from_epoch_ms
from tidemark.functions.lateness import is_late, lateness_ms, usable_watermark
from tidemark.operators.prefix import Running, blocked_running, running_number
from tidemark.schema import REQUIRED_FIELDS
from tidemark.session import materialize

OUT_OF_ORDER_MS = 10_000
IDLE_MS = 30_000
BATCH_BLOCK = 4_096
ROW_BLOCK = 65_536


def contributed_time(event_time_ms: Column, error: Column, ignore_invalid: bool = False) -> Column:
    """The event time a record offers to the watermark: zero for rejects, which never advance it."""
    return F.when(error.isNull(), event_time_ms).otherwise(F.lit(None if ignore_invalid else 0).cast("long"))


def arrival_watermark(
    arrivals: DataFrame,
    event_ms: str = "event_ms",
    out_of_order_ms: int = OUT_OF_ORDER_MS,
    idle_ms: int = IDLE_MS,
) -> DataFrame:
    """One row per batch: ``batch_id, batch_ms, watermark_ms``.

    ``arrivals`` needs ``batch_id``, ``batch_ms`` (rising with batch_id), ``src_partition`` and the
    event time column.  Rows are reduced to one per (batch, partition) before anything is ordered,
    and the reduced tables are stored between steps: the arrivals are read once, and no step repeats
    the ones before it.
    """
    per_cell = materialize(
        arrivals.groupBy("batch_id", "src_partition").agg(
            F.max(event_ms).alias("mx"), F.max("batch_ms").alias("batch_ms")
        ),
        "watermark-cells",
    )
    batches = running_number(
        per_cell.groupBy("batch_id").agg(F.max("batch_ms").alias("batch_ms")),
        [],
        ["batch_id"],
        F.expr(f"batch_id div {BATCH_BLOCK}"),
        "idx",
    )
    # The last batch that still counts a partition seen in this one as active.  Only batches within
    # idle_ms matter, so each batch is also shown to the window of the time bucket before its own.
    bucket = F.floor(F.col("batch_ms") / F.lit(idle_ms))
    horizon = Window.partitionBy("_bucket").orderBy("batch_ms").rangeBetween(Window.currentRow, idle_ms)
    steps = materialize(
        batches.withColumn("_home", bucket)
        .withColumn("_bucket", F.explode(F.array(F.col("_home"), F.col("_home") - 1)))
        .withColumn("until", F.max("idx").over(horizon))
        .filter(F.col("_bucket") == F.col("_home"))
        .select("batch_id", "batch_ms", "idx", "until"),
        "watermark-steps",
    )
    block = F.expr(f"idx div {BATCH_BLOCK}")
    seen = blocked_running(
        per_cell.select("batch_id", "src_partition", "mx").join(steps, "batch_id"),
        ["src_partition"],
        ["idx"],
        block,
        {"reached": Running("max", F.col("mx"))},
    ).filter(F.col("reached").isNotNull())
    # A partition's value holds from the next batch to its next appearance or until it goes idle.
    # Appearances are matched up inside a block; overlap at block ends is settled by the maximum.
    next_seen = F.lead("idx").over(Window.partitionBy("src_partition", block).orderBy("idx"))
    held = (
        seen.withColumn("last", F.least(F.coalesce(next_seen, F.col("until")), F.col("until")))
        .filter(F.col("last") > F.col("idx"))
        .select("src_partition", "reached", F.explode(F.sequence(F.col("idx") + 1, F.col("last"))).alias("idx"))
    )
    lowest = (
        held.groupBy("idx", "src_partition")
        .agg(F.max("reached").alias("reached"))
        .groupBy("idx")
        .agg((F.min("reached") - F.lit(out_of_order_ms)).alias("low"))
    )
    lows = materialize(steps.join(lowest, "idx", "left"), "watermark-lows")
    return blocked_running(
        lows, [], ["idx"], block, {"watermark_ms": Running("max", F.col("low"))}
    ).select("batch_id", "batch_ms", "watermark_ms")


def row_watermark(
    arrivals: DataFrame,
    order: str = "arrival",
    at_ms: str = "at_ms",
    event_ms: str = "event_ms",
    out_of_order_ms: int = OUT_OF_ORDER_MS,
    idle_ms: int = IDLE_MS,
    block_rows: int = ROW_BLOCK,
) -> DataFrame:
    """``arrivals`` with ``watermark_ms``: the watermark each row met, set by the rows before it alone.

    Each source partition offers the largest event time it has delivered before the row, if it delivered anything
    within ``idle_ms`` of the row's ``at_ms``.  The watermark is the least offer minus the allowed disorder and never
    moves back.  ``order`` is a dense, unique arrival number.

    Every block of ``block_rows`` arrivals is one window, whatever partition its rows are from, so neither a hot
    partition nor the whole stream is in one task.  A source partition costs two columns; how many there are is a
    property of the topic, not of its contents.
    """
    partitions = sorted(r[0] for r in arrivals.select("src_partition").distinct().collect())
    if not partitions:
        return arrivals.withColumn("watermark_ms", F.lit(None).cast("long"))
    mine = {p: F.col("src_partition") == p for p in partitions}
    seen = {f"_reached_{p}": Running("max", F.when(here, F.col(event_ms)), False) for p, here in mine.items()}
    seen |= {f"_last_{p}": Running("max", F.when(here, F.col(at_ms)), False) for p, here in mine.items()}
    block = F.floor(F.col(order) / F.lit(block_rows))
    carried = blocked_running(arrivals, [], [order], block, seen)
    offers = [F.when(F.col(at_ms) - F.col(f"_last_{p}") <= idle_ms, F.col(f"_reached_{p}")) for p in partitions]
    low = F.array_min(F.array_compact(F.array(*offers)))
    lows = carried.select(*[F.col(c) for c in arrivals.columns], (low - F.lit(out_of_order_ms)).alias("_low"))
    return blocked_running(lows, [], [order], block, {"watermark_ms": Running("max", F.col("_low"))}).drop("_low")


def observe(
    rows: DataFrame,
    watermark_ms: Column,
    processed_at: Column | None = None,
    event_ms: str = "event_time_ms",
) -> DataFrame:
    """Add processed_at, watermark_at_arrival, is_late and lateness_ms.  No row is dropped."""
    clock = F.current_timestamp() if processed_at is None else processed_at
    event = F.col(event_ms)
    return rows.select(
        "*",
        clock.alias("processed_at"),
        from_epoch_ms(usable_watermark(watermark_ms)).alias("watermark_at_arrival"),
        is_late(event, watermark_ms).alias("is_late"),
        lateness_ms(event, watermark_ms).alias("lateness_ms"),
    )


def observe_batches(
    valid: DataFrame, watermarks: DataFrame, processed_at: Column | None = None, *extra: str
) -> DataFrame:
    """Stamp each valid row with the watermark of the batch that delivered it.

    The watermark table has one row per batch; Spark broadcasts it when its measured size allows and
    joins by shuffle otherwise.
    """
    stamped = valid.join(watermarks.select("batch_id", "watermark_ms"), "batch_id", "left")
    return observe(stamped, F.col("watermark_ms"), processed_at).select(
        *extra, *REQUIRED_FIELDS, "processed_at", "watermark_at_arrival", "is_late", "lateness_ms"
    )


def late_rows(observed: DataFrame) -> DataFrame:
    return observed.filter("is_late")
