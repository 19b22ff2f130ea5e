"""What the job has to remember between batches, as small tables on shared storage.

Batch N reads the rows of batch N-1 and writes its own to another slot, so a replay of batch N
starts from the same rows and comes to the same result.  The arrival watermark keeps one row per source
partition: its largest event time, when it last delivered, and the watermark.  The running count keeps one
row per tenant.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SLOTS = 4


@dataclass(frozen=True)
class BatchState:
    """The rows of one finished batch, and where slots are kept."""

    spark: SparkSession
    path: str

    schema: ClassVar[str]
    #: The column that is NULL only in the row that says that the batch was finished.
    key: ClassVar[str]
    what: ClassVar[str]

    def slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % SLOTS}"

    def after(self, batch_id: int) -> DataFrame:
        """The state as the given batch left it; empty before the first batch.

        Every stored state has a row without a key, which says that the batch was finished.
        Without it the state would silently start again, so the query stops instead.
        """
        if batch_id < 0:
            return self.spark.createDataFrame([], self.schema)
        try:
            rows = self.spark.read.schema(self.schema).parquet(self.slot(batch_id)).filter(F.col("batch_id") == batch_id)
            finished = not rows.filter(F.col(self.key).isNull()).isEmpty()
        except AnalysisException:
            finished = False
        if not finished:
            raise RuntimeError(f"the {self.what} of batch {batch_id} is missing in {self.path}")
        return rows

    def store(self, rows: DataFrame, batch_id: int, files: int = 1) -> None:
        """Keep ``rows`` as the state after this batch, in place of what an earlier attempt left."""
        finished = self.spark.range(1).select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
        whole = rows.unionByName(finished).withColumn("batch_id", F.lit(batch_id).cast("long"))
        whole.coalesce(files).write.mode("overwrite").parquet(self.slot(batch_id))


@dataclass(frozen=True)
class WatermarkState(BatchState):
    schema = "batch_id long, src_partition int, max_ms long, seen_ms long, watermark_ms long"
    key = "src_partition"
    what = "watermark state"

    def watermark(self, before: DataFrame, now_ms: int, out_of_order_ms: int, idle_ms: int) -> int | None:
        """The watermark for a batch arriving now: one number from a table of one row per partition."""
        active = F.when(F.lit(now_ms) - F.col("seen_ms") <= idle_ms, F.col("max_ms"))
        row = before.agg(
            (F.min(active) - F.lit(out_of_order_ms)).alias("low"), F.max("watermark_ms").alias("old")
        ).first()
        known = [value for value in (row["low"], row["old"]) if value is not None]
        return max(known) if known else None

    def advance(
        self, before: DataFrame, arrivals: DataFrame, batch_id: int, now_ms: int, watermark_ms: int | None
    ) -> None:
        """Store the state after this batch; ``arrivals`` holds src_partition and event_ms."""
        now_seen = arrivals.groupBy("src_partition").agg(
            F.max("event_ms").alias("max_ms"), F.lit(now_ms).cast("long").alias("seen_ms")
        )
        merged = (
            before.filter("src_partition IS NOT NULL")
            .select("src_partition", "max_ms", "seen_ms")
            .unionByName(now_seen)
            .groupBy("src_partition")
            .agg(F.max("max_ms").alias("max_ms"), F.max("seen_ms").alias("seen_ms"))
        )
        # The finishing row carries the watermark even where no partition has delivered yet.
        finished = self.spark.range(1).selectExpr(
            "CAST(NULL AS int) AS src_partition", "CAST(NULL AS bigint) AS max_ms", "CAST(NULL AS bigint) AS seen_ms"
        )
        merged.unionByName(finished).select(
            F.lit(batch_id).cast("long").alias("batch_id"),
            "src_partition",
            "max_ms",
            "seen_ms",
            F.lit(watermark_ms).cast("long").alias("watermark_ms"),
        ).coalesce(1).write.mode("overwrite").parquet(self.slot(batch_id))


@dataclass(frozen=True)
class TenantTotals(BatchState):
    """How many valid records of each tenant the batches so far have had."""

    schema = "batch_id long, tenant_id string, total long"
    key = "tenant_id"
    what = "running count"

    def advance(self, before: DataFrame, valid: DataFrame, batch_id: int) -> None:
        counted = valid.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("total"))
        old = before.filter("tenant_id IS NOT NULL").select("tenant_id", "total")
        self.store(old.unionByName(counted).groupBy("tenant_id").agg(F.sum("total").alias("total")), batch_id)
