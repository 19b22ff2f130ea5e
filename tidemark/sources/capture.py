"""Captured arrivals as a topic: partitions, offsets, and a limit on what one batch takes.

``write_capture`` lays arrivals out as Parquet folders, one for each source partition, in files sorted by offset.
The format ``captured_topic`` reads them as a stream.  Its offset is the next offset of each source partition, so
progress reports and restarts speak of partitions as they do for a broker's topic.

* Only footers are read to learn which offsets a file holds; each footer is read once.
* Files are made of small row groups.  A task opens those that can hold its offsets and streams them in batches of
  bounded rows and bytes, so its memory depends neither on the size of files nor on that of row groups.
* ``maxOffsetsPerTrigger`` is shared out in proportion to what each partition has waiting, one at least.
* A range of offsets is cut into tasks of ``rowsPerTask`` offsets, so a hot partition is read by many tasks.
* ``startingOffsets``, as JSON, says where a new query begins in the partitions it names; others begin at their first.
* A batch that was planned is read again from the same offsets after a restart.  How far batches were planned is
  kept in ``position``, a file on shared storage, because Spark asks for the next end without saying where it is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.schema import ARRIVAL_SCHEMA

FORMAT = "captured_topic"
ROWS_PER_TASK = 250_000
FILE_ROWS = 1_000_000
ROW_GROUP_ROWS = 16_384
BATCH_ROWS = 8_192
BATCH_BYTES = 4 << 20
STREAM_BYTES = 1 << 20
_FOLDER = "src_partition="


def write_capture(arrivals: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Store arrivals (key, value, src_partition, offset) by partition and offset, for ``captured_stream``."""
    placed = arrivals.select(*ARRIVAL_SCHEMA.fieldNames()).repartitionByRange("src_partition", "offset")
    placed = placed.sortWithinPartitions("src_partition", "offset")
    writer = placed.write.option("maxRecordsPerFile", file_rows).option("parquet.block.row.count.limit", ROW_GROUP_ROWS)
    writer.partitionBy("src_partition").mode("append").parquet(path)


def offsets_in(footer: pq.FileMetaData) -> tuple[int, int] | None:
    """The first offset in a file and the one after its last, from the footer's statistics."""
    at = footer.schema.names.index("offset")
    spans = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups)]
    spans = [s for s in spans if s is not None and s.has_min_max]
    return (min(s.min for s in spans), max(s.max for s in spans) + 1) if spans else None


def groups_with(footer: pq.FileMetaData, start: int, end: int) -> list[int]:
    """The row groups of a file that can hold offsets from ``start`` up to ``end``; one without bounds can."""
    at = footer.schema.names.index("offset")
    spans = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups)]
    return [i for i, s in enumerate(spans) if s is None or not s.has_min_max or (s.min < end and s.max >= start)]


def rows_at_once(group: pq.RowGroupMetaData) -> int:
    """How many rows of a row group make a batch of about ``BATCH_BYTES`` at most."""
    return max(1, min(BATCH_ROWS, BATCH_BYTES * group.num_rows // max(1, group.total_byte_size)))


def admitted(at: dict[int, int], ends: dict[int, int], limit: int | None) -> dict[int, int]:
    """The end of the next batch: all that waits, or ``limit`` offsets in proportion to it, one at least of each."""
    waiting = {p: max(0, end - at.get(p, 0)) for p, end in ends.items()}
    total = sum(waiting.values())
    if limit is None or total <= limit:
        return {**at, **{p: max(end, at.get(p, 0)) for p, end in ends.items()}}
    take = {p: min(n, max(1, limit * n // total)) for p, n in waiting.items()}
    return {p: at.get(p, 0) + take.get(p, 0) for p in {*at, *ends}}


class Range(InputPartition):
    def __init__(self, files: list[str], src_partition: int, start: int, end: int) -> None:
        self.files, self.src_partition, self.start, self.end = files, src_partition, start, end


class CapturedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.position = options["path"], options["position"]
        limit = options.get("maxOffsetsPerTrigger")
        self.limit = int(limit) if limit else None
        self.per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        if self.per_task < 1 or (self.limit is not None and self.limit < 1):
            raise ValueError("maxOffsetsPerTrigger and rowsPerTask must be positive")
        self.starting = {int(p): int(n) for p, n in json.loads(options.get("startingOffsets", "{}")).items()}
        self.files: dict[str, tuple[int, int, int] | None] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        self._look()
        first: dict[int, int] = {}
        for partition, start, _ in filter(None, self.files.values()):
            first[partition] = min(start, first.get(partition, start))
        first |= self.starting
        return {str(p): n for p, n in sorted(first.items())}

    def latestOffset(self) -> dict:  # noqa: N802
        self._look()
        ends: dict[int, int] = {}
        for partition, _, end in filter(None, self.files.values()):
            ends[partition] = max(end, ends.get(partition, 0))
        at = self._planned() or {int(p): n for p, n in self.initialOffset().items()}
        planned = admitted(at, ends, self.limit)
        if planned != self._planned():
            self._plan(planned)
        return {str(p): n for p, n in sorted(planned.items())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._look()
        tasks: list[InputPartition] = []
        for name, stop in end.items():
            first = start.get(name, 0)
            for lo in range(first, stop, self.per_task):
                hi = min(stop, lo + self.per_task)
                files = [f for f, held in self.files.items() if held and held[0] == int(name) and held[1] < hi and held[2] > lo]
                if files:
                    tasks.append(Range(sorted(files), int(name), lo, hi))
        return tasks

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        names = ARRIVAL_SCHEMA.fieldNames()
        for path in partition.files:
            with store.open_input_file(path) as data:
                # With a buffer size, pages are read as they are needed instead of whole column chunks.
                file = pq.ParquetFile(data, buffer_size=STREAM_BYTES, pre_buffer=False)
                for group in groups_with(file.metadata, partition.start, partition.end):
                    size = rows_at_once(file.metadata.row_group(group))
                    for batch in file.iter_batches(size, [group], ["key", "value", "offset"], use_threads=False):
                        offset = batch.column("offset")
                        wanted = pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end))
                        kept = batch.filter(wanted)
                        if kept.num_rows:
                            source = pa.array([partition.src_partition] * kept.num_rows, pa.int32())
                            columns = {n: source if n == "src_partition" else kept.column(n) for n in names}
                            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    def commit(self, end: dict) -> None:
        pass

    def _look(self) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        for info in store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
            if info.path in self.files or not info.base_name.endswith(".parquet") or info.base_name.startswith(("_", ".")):
                continue
            # Files that a write has not finished are in a folder of another name.
            folder = info.path.rsplit("/", 2)[-2]
            if not folder.startswith(_FOLDER) or "_temporary" in info.path:
                continue
            with store.open_input_file(info.path) as data:
                held = offsets_in(pq.ParquetFile(data).metadata)
            self.files[info.path] = (int(folder.removeprefix(_FOLDER)), *held) if held else None

    def _planned(self) -> dict[int, int]:
        store, path = fs.FileSystem.from_uri(self.position)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return {}
        with store.open_input_stream(path) as held:
            return {int(p): n for p, n in json.loads(held.read().decode()).items()}

    def _plan(self, planned: dict[int, int]) -> None:
        store, path = fs.FileSystem.from_uri(self.position)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        # Written whole beside it, then put in its place.
        with store.open_output_stream(f"{path}.next") as out:
            out.write(json.dumps({str(p): n for p, n in planned.items()}).encode())
        store.move(f"{path}.next", path)


class CapturedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return ARRIVAL_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return CapturedReader(self.options)


def captured_topic(
    spark: SparkSession,
    path: str,
    position: str,
    max_offsets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    starting: dict[str, int] | None = None,
) -> DataFrame:
    """The arrivals under ``path`` as a stream with offsets; ``position`` is a file of its own for each query."""
    spark.dataSource.register(CapturedTopic)
    reader = spark.readStream.format(FORMAT).option("position", position).option("rowsPerTask", str(rows_per_task))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    if starting:
        reader = reader.option("startingOffsets", json.dumps(starting))
    return reader.load(path)


def captured_ends(spark: SparkSession, path: str) -> DataFrame:
    """(src_partition, end_offset) of a capture."""
    from tidemark.sources.topics import end_offsets

    return end_offsets(spark.read.schema(ARRIVAL_SCHEMA).parquet(path).select("src_partition", "offset"))
