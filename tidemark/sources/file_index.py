"""A zone map of the stored table, read from file footers alone.

One row for each file: its month, rows, bytes, and the smallest and largest event time and tenant.  Files are listed by
Spark and their footers read in tasks; no row of data is.  Ranges of the sort key then name the files that can hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import TABLE_SCHEMA

INDEX = (
    "path string, ym string, n_rows long, bytes long, min_event_time timestamp, max_event_time timestamp,"
    " min_tenant string, max_tenant string"
)
_ZONES = ("event_time", "tenant_id")
FILES_PER_TASK = 256


def _bounds(footer: pq.FileMetaData, column: str) -> tuple:
    """The least and greatest value of a column; both None where a row group does not say."""
    names = [footer.schema.column(i).path for i in range(len(footer.schema))]
    found = [footer.row_group(g).column(names.index(column)).statistics for g in range(footer.num_row_groups)]
    if not found or any(s is None or not s.has_min_max for s in found):
        return None, None
    return min(s.min for s in found), max(s.max for s in found)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as data:
                footer = pq.ParquetFile(data).metadata
            month = next((p[3:] for p in path.split("/") if p.startswith("ym=")), None)
            times, tenants = (_bounds(footer, c) for c in _ZONES)
            times = [t.replace(tzinfo=timezone.utc) if t is not None and t.tzinfo is None else t for t in times]
            made.append((path, month, footer.num_rows, size, *times, *tenants))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.timestamp("us", "UTC")] * 2, pa.string(), pa.string()]
        names = [c.split()[0] for c in INDEX.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], names)


def build(spark: SparkSession, path: str) -> DataFrame:
    """The index of the table under ``path``."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    ).select("path", "length")
    tasks = max(1, -(-listed.count() // FILES_PER_TASK))
    return listed.repartition(tasks, "path").mapInArrow(_footers, INDEX)


def holding(index: DataFrame, start: datetime, end: datetime, tenant: str | None = None) -> DataFrame:
    """The files that can hold rows with start <= event_time < end, of one tenant if named.

    A file without bounds is kept: it can hold anything.
    """
    low, high = (F.lit(t.isoformat(sep=" ") + "Z").cast("timestamp") for t in (start, end))
    can = F.coalesce((F.col("min_event_time") < high) & (F.col("max_event_time") >= low), F.lit(True))
    if tenant is not None:
        can &= F.coalesce(F.lit(tenant).between(F.col("min_tenant"), F.col("max_tenant")), F.lit(True))
    return index.filter(can)


def read(spark: SparkSession, path: str, index: DataFrame, start: datetime, end: datetime, tenant: str | None = None) -> DataFrame:
    """Rows of the range; only files that can hold some are opened."""
    files = [r["path"] for r in holding(index, start, end, tenant).select("path").collect()]
    if not files:
        return spark.createDataFrame([], TABLE_SCHEMA)
    rows = spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(*files)
    low, high = (F.lit(t.isoformat(sep=" ") + "Z").cast("timestamp") for t in (start, end))
    rows = rows.filter((F.col("event_time") >= low) & (F.col("event_time") < high))
    return rows if tenant is None else rows.filter(F.col("tenant_id") == tenant)
