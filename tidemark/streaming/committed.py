"""A table whose rows count only once their batch is committed, for sinks that may be run again.

``write_batch`` sends the rows of one micro-batch to files of at most ``rows`` rows; a file is also closed when
``interval_ms`` have passed since its first row, or when its rows fill ``FILE_BYTES`` in memory, which is all that
a task holds of them for a retry.  A file that cannot be written is tried again ``retries`` times.
When all tasks have ended, one small file under ``commits`` names the files of the batch.  It is put in
place whole, and a batch that is run again replaces it, so

* a task or job that fails leaves files that no commit names, and no half batch;
* a batch that is replayed after a crash is there once, whatever the first attempt had written.

``read_committed`` reads the rows whose file is named.  The list of files is a table that Spark joins; it is never
on the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.utils import AnalysisException

FORMAT = "committed_rows"
FILE_BYTES = 32 << 20
COMMITS = "batch_id long, file string, n_rows long"


@dataclass
class Wrote(WriterCommitMessage):
    files: list[tuple[str, int]]


def with_retries(work: Callable[[], None], retries: int, pause_s: float = 0.2) -> None:
    """Do ``work``; after an I/O error wait, twice as long each time, and do it again, ``retries`` times at most."""
    for attempt in range(retries + 1):
        try:
            return work()
        except OSError:
            if attempt == retries:
                raise
            time.sleep(pause_s * 2**attempt)


def chunks(
    batches: Iterator[pa.RecordBatch],
    rows: int,
    interval_ms: int,
    clock: Callable[[], float] = time.monotonic,
    max_bytes: int = FILE_BYTES,
) -> Iterator[pa.Table]:
    """The rows in tables of at most ``rows`` rows; what has waited ``interval_ms`` goes with the next that come.

    A table also ends with the batch that brings it to ``max_bytes``.
    """
    held: list[pa.RecordBatch] = []
    n, size, since = 0, 0, clock()
    for batch in batches:
        while batch.num_rows:
            if not held:
                since = clock()
            part = batch.slice(0, rows - n)
            held.append(part)
            n += part.num_rows
            size += part.nbytes
            batch = batch.slice(part.num_rows)
            if n == rows or size >= max_bytes or (clock() - since) * 1_000 >= interval_ms:
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.batch_id = options["path"], int(options["batchId"])
        self.rows, self.interval_ms, self.retries = (int(options[k]) for k in ("rows", "intervalMs", "retries"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(f"{base}/data", recursive=True)
        files = []
        for table in chunks(iterator, self.rows, self.interval_ms):
            # A new name for each attempt: nothing that was written before is touched.
            name = f"{self.batch_id:012d}-{uuid.uuid4().hex}.parquet"
            with_retries(lambda t=table, n=name: pq.write_table(t, f"{base}/data/{n}", filesystem=store), self.retries)
            files.append((name, table.num_rows))
        return Wrote(files)

    def commit(self, messages: list[Wrote | None]) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(f"{base}/commits", recursive=True)
        named = [f for m in messages if m for f in m.files]
        lines = "".join(json.dumps({"batch_id": self.batch_id, "file": f, "n_rows": n}) + "\n" for f, n in named)

        def put() -> None:
            with store.open_output_stream(f"{base}/commits/_{self.batch_id}") as out:
                out.write(lines.encode())
            store.move(f"{base}/commits/_{self.batch_id}", f"{base}/commits/{self.batch_id}.json")

        with_retries(put, self.retries)

    def abort(self, messages: list[Wrote | None]) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m for f, _ in m.files):
            store.delete_file(f"{base}/data/{name}")


class CommittedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return CommittedWriter(self.options)


def enable(spark: SparkSession) -> None:
    """Make the format known; a stream works in a copy of the session as it is when the stream starts."""
    spark.dataSource.register(CommittedRows)


def write_batch(rows: DataFrame, path: str, batch_id: int, max_rows: int, interval_ms: int, retries: int) -> None:
    """Store the rows of a batch under ``path`` and commit them together; the session must know the format."""
    writer = rows.write.format(FORMAT).mode("append").option("batchId", str(batch_id))
    writer.option("rows", str(max_rows)).option("intervalMs", str(interval_ms)).option("retries", str(retries)).save(path)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, file, n_rows) of every committed file."""
    try:
        return spark.read.schema(COMMITS).json(f"{path}/commits")
    except AnalysisException:  # nothing has been committed
        return spark.createDataFrame([], COMMITS)


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of committed batches."""
    try:
        stored = spark.read.schema(schema).parquet(f"{path}/data")
    except AnalysisException:
        return spark.createDataFrame([], schema)
    named = commits(spark, path).select(F.col("file").alias("_file"))
    rows = stored.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return rows.join(named, "_file", "left_semi").select(*stored.columns)
