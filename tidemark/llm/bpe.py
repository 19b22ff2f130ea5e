"""Byte-level BPE encoding and decoding over whole documents.

Pre-tokens of a text do not depend on what lies before them once a boundary is right, so a text can be
cut anywhere if the pieces overlap: each piece finds its own boundaries, and the first boundary that a
piece and its successor both have is where one takes over from the other.

* Texts of at most ``long_chars`` characters are one piece and are encoded where they are read; no row
  of them moves.  Longer texts become pieces of ``step`` characters plus an overlap, are dealt to all
  tasks, pre-tokenised and encoded there, and their ids are stitched per text.
* Where two neighbours share no boundary in the overlap (a run of letters longer than it), the stitcher
  goes on pre-tokenising from the last boundary that is sure, so the result is exact for every text.
* Pre-tokens never reach over a blank that follows a non-blank.  Short texts are cut there, and a
  bounded table per task remembers the ids of such a unit, so frequent words are merged once.

Decoding concatenates the raw bytes of the ids.  No special tokens are known in either direction.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_CHARS = 1 << 15
STEP = 1 << 14
OVERLAP = 1 << 10
REMEMBERED = 150_000
BATCH_BYTES = 1 << 21
VOCABULARY = "byte_bpe_50k.tiktoken"

_UNIT = re.compile(r"(?<=\S)(?= )")
_TABLES: dict[tuple[str, str], Pieces] = {}


def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pieces(dict):
    """Packed int32 ids of each unit of text met so far; emptied when it has ``REMEMBERED`` units."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        super().__init__()
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens={})
        self.merge = encoding._core_bpe.encode_single_piece
        self.pattern = regex.compile(pattern)

    def __missing__(self, unit: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(unit):
            ids += self.merge(piece.encode())
        packed = np.array(ids, dtype=np.int32).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(unit) <= 64:
            self[unit] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _UNIT.split(text))) if text else b""

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
        """Start of each pre-token, its number of ids, and all ids."""
        starts, ids = [], []
        for found in self.pattern.finditer(text):
            starts.append(found.start())
            ids.append(self[found.group()])
        counts = np.fromiter((len(x) // 4 for x in ids), dtype=np.int64, count=len(ids))
        return np.array(starts, dtype=np.int64), counts, b"".join(ids)


def pieces(path: str, pattern: str) -> Pieces:
    if (path, pattern) not in _TABLES:
        _TABLES[path, pattern] = Pieces(path, pattern)
    return _TABLES[path, pattern]


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(x) // 4 for x in packed], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def _encode_short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path, pattern)
        for batch in batches:
            rows, size, packed, first = batch.num_rows, 0, [], 0
            column = batch.column(1)
            for i in range(rows):
                packed.append(table.encode(column[i].as_py()))
                size += len(packed[-1])
                if size > BATCH_BYTES or i == rows - 1:
                    ids = batch.column(0).slice(first, len(packed))
                    yield pa.RecordBatch.from_arrays([ids, _id_lists(packed)], ["id", "ids"])
                    size, packed, first = 0, [], i + 1

    return run


def _encode_chunks(path: str, pattern: str, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                starts, counts, ids = table.boundaries(row.column(3)[0].as_py())
                starts += step * row.column(2)[0].as_py()
                made = [pa.array([x], pa.binary()) for x in (starts.tobytes(), counts.tobytes(), ids)]
                yield pa.RecordBatch.from_arrays([*row.columns, *made], ["row", "id", "k", "chunk", "starts", "counts", "ids"])

    return run


def stitch(chunks: list[tuple[str, np.ndarray, np.ndarray, bytes]], step: int, overlap: int, table: Pieces) -> bytes:
    """The ids of a text from its overlapping chunks (text, starts, id counts, packed ids), in order."""
    out: list[bytes] = []
    text, starts, counts, ids = chunks[0]
    base = 0  # where ``text`` begins
    for k, (more, starts_2, counts_2, ids_2) in enumerate(chunks[1:], 1):
        begin = k * step
        # every start of this piece is sure; only where its last pre-token ends is not
        common = np.intersect1d(starts[starts >= begin], starts_2, assume_unique=True)
        if len(common):
            cut, cut_2 = np.searchsorted(starts, common[0]), np.searchsorted(starts_2, common[0])
            out.append(ids[: 4 * int(counts[:cut].sum())])
            text, base = more, begin
            starts, counts, ids = starts_2[cut_2:], counts_2[cut_2:], ids_2[4 * int(counts_2[:cut_2].sum()) :]
        else:
            sure = int(starts[-1])
            out.append(ids[: 4 * int(counts[:-1].sum())])
            text = text[sure - base :] + more[base + len(text) - begin :]
            base = sure
            starts, counts, ids = table.boundaries(text)
            starts = starts + base
    out.append(ids)
    return b"".join(out)


def _stitch_groups(path: str, pattern: str, step: int, overlap: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["k"])
        chunks = [(r["chunk"], np.frombuffer(r["starts"], np.int64), np.frombuffer(r["counts"], np.int64), r["ids"]) for r in rows]
        ids = stitch(chunks, step, overlap, pieces(path, pattern))
        return pa.Table.from_arrays([pa.array([rows[0]["id"]], pa.int64()), _id_lists([ids])], ["id", "ids"])

    return run


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    long_chars: int = LONG_CHARS,
    step: int = STEP,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(id, ids array<int>) for every row.

    A null or empty text has no ids; null ids, repeated ids and repeated rows are kept as they are, one
    result row for each input row; an empty table gives an empty result; other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= long_chars).mapInArrow(_encode_short(path, pattern), "id long, ids array<int>")
    cut = (
        rows.filter(F.length("text") > long_chars)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("k", F.explode(F.expr(f"sequence(0, (length(text) - 1) div {step})")))
        .selectExpr("row", "id", "cast(k AS int) AS k", f"substring(text, cast(k * {step} + 1 AS int), {step + overlap}) AS chunk")
        .repartition("row", "k")
    )
    made = cut.mapInArrow(
        _encode_chunks(path, pattern, step), "row long, id long, k int, chunk string, starts binary, counts binary, ids binary"
    )
    long = made.groupBy("row").applyInArrow(_stitch_groups(path, pattern, step, overlap), "id long, ids array<int>")
    return short.unionByName(long).withColumnRenamed("id", id_col)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = vocabulary(path)
        tokens = [token for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        lengths = np.array([len(x) for x in tokens], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        for batch in batches:
            column = batch.column(1)
            for first in range(0, batch.num_rows, 64):
                part = column.slice(first, 64)
                ends = np.zeros(len(part) + 1, dtype=np.int64)
                np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False), out=ends[1:])
                ids = part.flatten().to_numpy(zero_copy_only=False)
                n = lengths[ids]
                after = np.concatenate([[0], np.cumsum(n)])
                data = flat[np.repeat(begins[ids] - after[:-1], n) + np.arange(after[-1])]
                offsets = pa.py_buffer(after[ends].astype(np.int32).tobytes())
                texts = pa.Array.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, 64) for c in batch.columns[:1]), texts, *(c.slice(first, 64) for c in batch.columns[2:])], [batch.schema.names[0], "bytes", *batch.schema.names[2:]])

    return run


def decode(encoded: DataFrame, id_col: str = "doc_id", path: str | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, bytes, ...) of (id, ids): the raw bytes of the ids, one after the other; null ids give no bytes.

    ``keep`` names further columns, computed from the encoded rows, that pass through unchanged.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = encoded.select(id_col, "ids", *[c.alias(name) for name, c in (keep or {}).items()])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids" and f.name != id_col)
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, bytes binary" + (f", {kinds}" if kinds else "")
    return rows.mapInArrow(_decode(path), schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (decimal ids joined by one blank), decoded_sha256 (decoded bytes).

    ``with_ids`` adds the ids themselves as ``token_ids``.
    """
    encoded = encode(docs, id_col, text_col, path)
    digest = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256)
    keep = {"n_tokens": F.size("ids").cast("long"), "ids_sha256": digest} | ({"token_ids": F.col("ids")} if with_ids else {})
    back = decode(encoded, id_col, path, keep)
    return back.select(id_col, *keep, F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))
