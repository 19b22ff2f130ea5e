"""Deterministic sharded WARC archives: range-sorted records, rolled files, committed by manifest.

The same rows give the same files, byte for byte, however Spark splits and retries the work:

* Shards are ranges of ids.  Their bounds come from the ids with the smallest hashes, a sample that
  depends on the ids alone.  Within a shard records are sorted by id and digest.
* A file is closed when its compressed size reaches ``roll_bytes``; each record is a gzip member of its
  own.  Record ids, dates, block and payload digests are made from the record.
* A task writes under a temporary name of its own attempt.  Spark's commit of the manifest table picks
  one attempt of each task; only files that it lists are moved to their final names, which can be
  repeated after a failure, and only they are read.

The folder must be one that all executors can reach: a shared mount or an object store that
``pyarrow.fs`` knows.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

LEAST_REVISIT = 100
SHARD_BYTES = 16 << 20
ROLL_BYTES = 4 << 20
TASK_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
PER_SHARD = 20
LEVEL = 5
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def _head(fields: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(name + b": " + value + b"\r\n" for name, value in fields)


def record(page_id: int | None, url: bytes | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; with a payload it is a response, without one a revisit of ``refers_to``."""
    block = b"HTTP/1.1 200 OK\r\n" + _head([(b"Content-Type", b"text/html; charset=utf-8"), (b"Content-Length", b"%d" % size)]) + b"\r\n"
    kind = b"response" if payload is not None else b"revisit"
    name = lambda page: b"<urn:uuid:%s>" % str(uuid.uuid5(_NAMESPACE, f"{page}/{digest}")).encode()
    block += payload or b""
    fields = [(b"WARC-Type", kind), (b"WARC-Record-ID", name(page_id)), (b"WARC-Date", date.encode())]
    if url is not None:
        fields.append((b"WARC-Target-URI", _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url)))
    if page_id is not None:
        fields.append((b"X-Page-Id", b"%d" % page_id))
    if payload is None:
        fields += [
            (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            (b"WARC-Refers-To", name(refers_to)),
            (b"X-Refers-To-Page-Id", b"%d" % refers_to),
        ]
    fields += [
        (b"WARC-Payload-Digest", b"sha256:" + digest.encode()),
        (b"WARC-Block-Digest", b"sha256:" + hashlib.sha256(block).hexdigest().encode()),
        (b"Content-Type", b"application/http;msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    return b"WARC/1.1\r\n" + _head(fields) + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The files of one task's attempt; ``done`` lists name, temporary path, bytes, records, digest."""

    def __init__(self, root: str, roll_bytes: int):
        self.fs, self.root = fs.FileSystem.from_uri(root)
        self.folder = f"{self.root}/_attempts/{uuid.uuid4().hex}"
        self.roll_bytes, self.shard, self.seq, self.out, self.done = roll_bytes, None, 0, None, []

    def write(self, shard: int, data: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.size >= self.roll_bytes):
            self.close()
        if shard != self.shard:
            self.shard, self.seq = shard, 0
        if self.out is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.name = f"pages-{shard:07d}-{self.seq:05d}.warc.gz"
            self.out, self.size, self.records, self.digest = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0, 0, hashlib.sha256()
            self.seq += 1
        packed = _member(data)
        self.out.write(packed)
        self.digest.update(packed)
        self.size += len(packed)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, f"{self.folder}/{self.name}", self.size, self.records, self.digest.hexdigest()))
            self.out = None


def _write(root: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, page, first, written = _Files(root, roll_bytes), object(), {}, set()
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                shard, page_id, tag, digest, size, url, payload, refers_to = (c[i].as_py() for c in columns)
                if page_id != page:
                    page, first, written = page_id, {}, set()
                if tag == 0:
                    first[digest] = refers_to
                    continue
                to = first.get(digest)
                if to is None and size >= LEAST_REVISIT and page_id is not None and digest in written:
                    to = page_id  # a repeated row
                written.add(digest)
                files.write(shard, record(page_id, url, payload if to is None else None, digest, size, to))
        files.close()
        names = ["name", "temporary", "bytes", "records", "sha256"]
        columns = list(zip(*files.done)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _promote(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                there, made = store.get_file_info([f"{base}/{name}", temporary])
                if made.type != fs.FileType.NotFound:
                    store.move(temporary, f"{base}/{name}")
                elif there.type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{name} is in the manifest but neither under its final nor its temporary name")
            yield batch.select(["name"])

    return run


def _bounds(pages: DataFrame, id_col: str, n_shards: int) -> np.ndarray:
    """Ascending ids at which a new shard begins, from the ids with the smallest hashes."""
    picked = pages.select(F.col(id_col).cast("long").alias("i")).filter("i IS NOT NULL").distinct().orderBy(F.xxhash64("i"), "i")
    ids = np.sort(np.array([r["i"] for r in picked.limit(PER_SHARD * n_shards).collect()], dtype=np.int64))
    return ids[PER_SHARD::PER_SHARD]


def write(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write a record for every row under the new folder ``root`` and return the manifest table.

    A null html is an empty payload.  Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more the
    one with the smallest id is a response and the others revisit it; among rows that repeat that id
    one is the response.  Rows without an id come first; they revisit a row with an id where one has the
    payload, and are responses otherwise.  A null url leaves the target out; blanks and control
    characters in one are percent-encoded.  An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("binary").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.length("payload").cast("long")})
    light = scratch.keep(rows.select("page_id", "digest", "size"), "digests")
    total = light.agg(F.coalesce(F.sum(F.col("size") + 512), F.lit(0)).alias("n")).first()["n"]
    n_shards = max(1, math.ceil(total / shard_bytes))
    bounds = _bounds(light, "page_id", n_shards)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(np.iinfo(np.int64).min).astype("int64"), side="right").astype("int32"))

    repeated = (
        light.filter(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
    )
    revisits = (
        light.join(repeated.select("digest", "first"), "digest")
        .filter("page_id IS NULL OR page_id <> first")
        .select("page_id", F.lit(0).alias("tag"), "digest", "size", F.lit(None).cast("binary").alias("url"), F.lit(None).cast("binary").alias("payload"), "first")
    )
    whole = rows.select("page_id", F.lit(1).alias("tag"), "digest", "size", "url", "payload", F.lit(None).cast("long").alias("first"))
    sorted_ = (
        whole.unionByName(revisits)
        .withColumn("shard", shard("page_id"))
        .repartition(n_shards, "shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "tag", "digest", "url")
        .select("shard", "page_id", "tag", "digest", "size", "url", "payload", "first")
    )
    listed = sorted_.mapInArrow(_write(root, roll_bytes), "name string, temporary string, bytes long, records long, sha256 string")
    listed.write.parquet(f"{root}/_manifest")
    manifest = spark.read.schema(listed.schema).parquet(f"{root}/_manifest")
    _spread(manifest).mapInArrow(_promote(root), "name string").count()
    scratch.drop(light)
    store, base = fs.FileSystem.from_uri(root)
    if store.get_file_info(f"{base}/_attempts").type != fs.FileType.NotFound:
        store.delete_dir(f"{base}/_attempts")  # what attempts that were not committed have left
    return manifest


def _spread(manifest: DataFrame) -> DataFrame:
    """The names in the manifest, dealt so that a task gets ``TASK_BYTES`` of archives on average; their
    rows are too small for Spark to tell that they stand for work."""
    whole = manifest.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files")).first()
    tasks = max(1, min(whole["files"], -(-(whole["bytes"] or 0) // TASK_BYTES)))
    return manifest.select("name", "temporary").repartition(tasks, "name")


def members(stream) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time."""
    rest = b""
    while rest or (rest := stream.read(1 << 20)):
        unpack, parts = zlib.decompressobj(31), []
        while True:
            parts.append(unpack.decompress(rest))
            if unpack.eof:
                rest = unpack.unused_data
                break
            if not (rest := stream.read(1 << 20)):
                raise ValueError("an archive ends inside a record")
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """A record's fields, with the payload of a response; wrong lengths and digests are errors."""
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = body[: int(fields[b"Content-Length"])]
    if len(body) != len(block) + 4 or b"sha256:" + hashlib.sha256(block).hexdigest().encode() != fields[b"WARC-Block-Digest"]:
        raise ValueError(f"record {fields.get(b'WARC-Record-ID')} has a wrong length or block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields.get(b'WARC-Record-ID')} has a wrong payload digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number(b"X-Page-Id"),
        "url": fields[b"WARC-Target-URI"].decode("utf-8", "replace") if b"WARC-Target-URI" in fields else None,
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number(b"X-Refers-To-Page-Id"),
        "payload": payload if kind == "response" else None,
    }


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(root: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        schema = _READ if with_payload else _READ.remove(len(_READ) - 1)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = parse(data)
                        if not with_payload:
                            del row["payload"]
                        rows.append(row)
                        size += len(data) if with_payload else 300
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest under ``root`` lists; every digest is checked."""
    manifest = _spread(spark.read.parquet(f"{root}/_manifest"))
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return manifest.mapInArrow(_read(root, with_payload), schema + (", payload binary" if with_payload else ""))
