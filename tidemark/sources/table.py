"""The stored telemetry table: layout, pruned scans, file report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import now_ms, truncate_ms, year_month
from tidemark.schema import TABLE_SCHEMA, TABLE_SORT_KEY

CLOCKS = ("produced_at", "event_time", "processed_at", "watermark_at_arrival", "ingested_at")


def stored_form(rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The rows as the table keeps them: millisecond clocks, the ingest clock and the month."""
    stamped = rows if "ingested_at" in rows.columns else rows.withColumn("ingested_at", ingested_at or now_ms())
    cut = stamped.withColumns({name: truncate_ms(F.col(name)) for name in CLOCKS})
    return cut.withColumn("ym", year_month(F.col("event_time"))).select(*TABLE_SCHEMA.fieldNames())


def write_rows(rows: DataFrame, path: str, mode: str = "append", layout: str = "as_is") -> None:
    """Write rows under month folders, each file sorted by the table's key.

    ``as_is`` keeps the partitions the rows come in and shuffles nothing.  ``rebalance`` lets adaptive
    execution merge small ones and split large ones into files of its advisory size, as suits
    micro-batches read by many tasks.  ``cluster`` range-partitions by month and key, for large
    backfills: the key is unique enough to split a hot tenant or month.
    """
    key = ["ym", *TABLE_SORT_KEY]
    placements = {
        "as_is": lambda: rows,
        "rebalance": lambda: rows.hint("rebalance"),
        "cluster": lambda: rows.repartitionByRange(*key),
    }
    if layout not in placements:
        raise ValueError(f"layout must be one of {sorted(placements)}")
    placements[layout]().sortWithinPartitions(*key).write.mode(mode).partitionBy("ym").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(path)


def between(table: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= event_time < end.  The month bounds let Spark skip whole folders."""
    return table.filter(
        F.col("ym").between(start.strftime("%Y%m"), end.strftime("%Y%m"))
        & (F.col("event_time") >= F.lit(start.isoformat(sep=" ") + "Z").cast("timestamp"))
        & (F.col("event_time") < F.lit(end.isoformat(sep=" ") + "Z").cast("timestamp"))
    )


def recent_files(table: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` files written last with their rows and bytes; the limit is the report."""
    meta = F.col("_metadata")
    return (
        table.select(
            "ym",
            meta["file_name"].alias("file_name"),
            meta["file_size"].alias("bytes_on_disk"),
            meta["file_modification_time"].alias("modification_time"),
        )
        .groupBy("ym", "file_name", "bytes_on_disk", "modification_time")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("modification_time"), "file_name")
        .limit(n)
    )
