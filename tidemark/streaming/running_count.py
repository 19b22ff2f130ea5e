"""Every valid record with the number it has among its tenant's, in the stream itself.

The count has two levels.  Inside a micro-batch a tenant's records are cut into blocks of consecutive offsets; a
record's number is its place in the block plus the sizes of the tenant's blocks before.  To that comes the tenant's
total of the batches before, from a table of one row per tenant.  So a tenant with most of the records is counted by
as many tasks as it has blocks, and the result does not depend on how the stream was cut into batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import validate
from tidemark.operators.prefix import running_number
from tidemark.session import configure
from tidemark.streaming import committed
from tidemark.streaming.sinks import Sink
from tidemark.streaming.state import TenantTotals

BLOCK = 65_536


def number(valid: DataFrame, totals: DataFrame, block_offsets: int = BLOCK) -> DataFrame:
    """``valid`` with tenant_record_count; needs tenant_id, src_partition and offset, and the totals before."""
    # Blocks in the order of (source partition, offset), also for a tenant that moved to another partition.
    block = F.struct("src_partition", F.floor(F.col("offset") / F.lit(block_offsets)))
    placed = running_number(valid, ["tenant_id"], ["src_partition", "offset"], block, "_place")
    before = totals.filter("tenant_id IS NOT NULL").select("tenant_id", "total")
    counted = placed.join(before, "tenant_id", "left")
    return counted.withColumn("tenant_record_count", F.col("_place") + F.coalesce("total", F.lit(0))).drop("_place", "total")


@dataclass
class NumberWriter:
    """Numbers one micro-batch, passes its records on, and keeps the new totals."""

    state: TenantTotals
    sink: Sink
    block_offsets: int = BLOCK

    def __call__(self, valid: DataFrame, batch_id: int) -> None:
        valid = valid.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = self.state.after(batch_id - 1)
            self.sink(number(valid, before, self.block_offsets), batch_id)
            self.state.advance(before, valid, batch_id)
        finally:
            valid.unpersist()


def start_running_count(
    spark: SparkSession,
    arrivals: DataFrame,
    checkpoint: str,
    sink: Sink,
    trigger: str = "10 seconds",
    block_offsets: int = BLOCK,
) -> StreamingQuery:
    """Number the valid records of a stream of arrivals and hand each batch to ``sink``.

    A batch that is run again starts from the totals it started from before, so its numbers are the same;
    an idempotent sink then holds every number once.
    """
    configure(spark)
    committed.enable(spark)
    valid = validate.valid_rows(validate.validate(arrivals), "src_partition", "offset")
    writer = NumberWriter(TenantTotals(spark, f"{checkpoint}/totals"), sink, block_offsets)
    stream = valid.writeStream.foreachBatch(writer).option("checkpointLocation", f"{checkpoint}/query")
    return stream.trigger(processingTime=trigger).queryName("running-count").start()
