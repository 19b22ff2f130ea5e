"""Running record count per tenant in managed state, as a query beside the main one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import validate
from tidemark.schema import HOT_TENANT
from tidemark.session import ROCKSDB_PROVIDER

STATE_NAME = "tenant_record_count"
OUTPUT = "tenant_id string, previous long, total long"


class TenantCounter(StatefulProcessor):
    """Adds the pre-counted records of a batch to the tenant's total."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState(STATE_NAME, "n bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.total.update((int(initialState["n"].sum()),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        previous = int(self.total.get()[0]) if self.total.exists() else 0
        total = previous + sum(int(chunk["n"].sum()) for chunk in rows)
        if total == previous:  # a tenant with a carried total and no record in the first batch
            return
        self.total.update((total,))
        yield pd.DataFrame({"tenant_id": [key[0]], "previous": [previous], "total": [total]})

    def close(self) -> None:
        pass


def count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count records per tenant within each Arrow batch, before anything is shuffled."""
    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by("tenant_id").aggregate([("tenant_id", "count")])
        counted = counted.rename_columns(["tenant_id", "n"]).cast(
            pa.schema([("tenant_id", pa.string()), ("n", pa.int64())])
        )
        yield from counted.to_batches()


def tenant_totals(valid: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """For each batch and tenant seen in it: the count before and after.

    ``carried`` (tenant_id, n) are totals that a query with another checkpoint left; counting goes on from them.

    A hot tenant reaches its state owner as one row per Arrow batch instead of one per record.
    Processing has no event-time mode, so late records count like any other.
    """
    partial = valid.select("tenant_id").mapInArrow(count_chunks, "tenant_id string, n long")
    return partial.groupBy("tenant_id").transformWithStateInPandas(
        statefulProcessor=TenantCounter(), outputStructType=OUTPUT, outputMode="Append", timeMode="None",
        initialState=None if carried is None else carried.groupBy("tenant_id"),
    )


def milestones(totals: DataFrame, tenant: str = HOT_TENANT) -> DataFrame:
    """The counts 1, 10, 100, ... that the hot tenant passed in each batch."""
    powers = F.array(*[F.lit(10**k) for k in range(19)])
    passed = F.filter(powers, lambda n: (n > F.col("previous")) & (n <= F.col("total")))
    return totals.filter(F.col("tenant_id") == tenant).select(
        "tenant_id", F.explode(passed).alias("tenant_record_count"), F.lit(STATE_NAME).alias("state_name")
    )


def start_tenant_state(
    spark: SparkSession, arrivals: DataFrame, checkpoint: str, output: str, available_now: bool = False,
    trigger: str = "10 seconds", partitions: int | None = None, carried: DataFrame | None = None,
) -> StreamingQuery:
    """Keep the totals of valid records and append each batch's changes to ``output``.

    ``carried`` is read in the first batch of a new checkpoint alone, whose source then has to begin where the
    query that left those totals stopped.

    ``partitions`` is how many tasks share the state.  It is fixed when a checkpoint is first used,
    and taken from the session's shuffle partitions when not given.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    totals = tenant_totals(validate.valid_rows(validate.validate(arrivals)), carried)
    stream = totals.writeStream.format("json").option("path", output).option("checkpointLocation", checkpoint)
    timed = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=trigger)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # A query takes its own copy of the settings when it starts.
        if partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        return timed.outputMode("append").queryName("tenant-state").start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def stored_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(tenant_id, n) of all tenants, read from the state store of a stopped query."""
    rows = spark.read.format("statestore").option("stateVarName", STATE_NAME).load(checkpoint)
    return rows.select(F.col("key.tenant_id").alias("tenant_id"), F.col("value.n").alias("n"))


def state_value(spark: SparkSession, checkpoint: str, tenant: str = HOT_TENANT) -> DataFrame:
    """The stored total of one tenant, read from the state store."""
    stored = stored_totals(spark, checkpoint).filter(F.col("tenant_id") == tenant)
    return stored.withColumnRenamed("n", "tenant_record_count")
