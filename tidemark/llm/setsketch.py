"""Near-duplicate groups by SetSketch registers, banded, estimated by likelihood, verified exactly.

A text is the set of its distinct word shingles.  Register i of its sketch is
``floor(1 - log_b(h_i))``, cut to 0..65535, where h_i is the smallest of exponentially distributed
hashes of the set's members with rate ``RATE``: truncated, exponentially spaced minima, of which the
larger one of two sets is that of their union.  With a base b near 1 two registers agree with about the
sets' Jaccard similarity.

1. Texts with equal sets (compared by size and 128 bits of digest) are linked to their smallest id, and
   only that one goes on, so copies are never paired.
2. ``BANDS`` bands of ``ROWS`` registers give buckets.  At a similarity of 0.8 a pair shares no bucket
   with probability (1 - 0.8**5)**32 = 3e-6; shared buckets are kept whatever their size.
3. A bucket of m texts is not paired m * m times.  In each of ``ROUNDS`` rounds every bucket that still
   spans several components names a hub from the largest one, at random among the texts that meet most
   others, and every text outside is tried against the hubs it shares most buckets with; what links is one component from then on.  Pairs inside a component are not needed.
   What is left are buckets whose texts are in several components.  Their texts' shingles are ordered by
   frequency, rarest first.  Two sets of sizes n and m with the similarity in reach have a shingle in
   common at places i and j of that order with 1 + min(n - i, m - j) >= the overlap they need; and where the
   members of a set are counted in ``CELLS`` cells, at least as many shingles are in one set alone as there are
   cells in which one count is odd and the other even.  Texts of different components are paired where neither
   forbids it, which misses no link; texts of one origin that are too far apart do not come out as pairs.
4. A trial estimates the similarity from the registers and the known set sizes by maximum likelihood.
   Only pairs that are e**20 times less likely at the threshold than at their estimate are given up;
   all others are verified on the full sets in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words
from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch

BANDS = 32
ROWS = 5
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
TOP = 65_535
ROUNDS = 3
HUBS_TRIED = 3
SURE = 20.0
CELLS = 512
PARITY = [f"p{i}" for i in range(CELLS // 64)]
_RNG = np.random.Generator(np.random.PCG64(7))
_MASKS = _RNG.integers(0, 2**32, size=(REGISTERS, 1), dtype=np.uint32)
_FACTORS = _RNG.integers(0, 2**32, size=(REGISTERS, 1), dtype=np.uint32) | np.uint32(1)
_BAND_STEPS = _RNG.integers(0, 2**64, size=(BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SEEDS = _RNG.integers(0, 2**64, size=BANDS, dtype=np.uint64)


def registers(members: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes, as uint16."""
    low = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(low), 1024):
        np.minimum(least, ((low[None, at : at + 1024] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One int64 key for each band of each row of registers."""
    grouped = regs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return words.mix((grouped * _BAND_STEPS).sum(axis=2) + _BAND_SEEDS).view(np.int64)


def likelihood(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Most likely similarity of each pair, and how much less likely (log) the threshold is."""
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.concatenate([np.linspace(0, 1, 101) * most, np.minimum(threshold, most)], axis=1)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    same = np.maximum(1 - up - down, 1e-12)
    value = more * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + (a.shape[1] - more - less) * np.log(same)
    best = value[:, :-1].argmax(axis=1)
    rows = np.arange(len(best))
    return grid[rows, best], value[rows, best] - value[:, -1]


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, low, high, regs = [], [], [], []
            for _, hashes in words.texts(batch.column(1)):
                members = words.shingles(hashes, k)
                size.append(len(members))
                low.append(int(np.add.reduce(members).view(np.int64)) if len(members) else 0)
                high.append(int(np.bitwise_xor.reduce(words.mix(members * np.uint64(3) + np.uint64(1))).view(np.int64)) if len(members) else 0)
                regs.append(registers(members).tobytes() if len(members) else None)
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(regs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "low", "high", "regs"])

    return run


def _rows_of(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys = band_keys(_rows_of(part.column(2), np.uint16))
            ids, n = (np.repeat(part.column(i).to_numpy(), BANDS) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(keys.ravel())], ["id", "n", "key"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [words.shingles(hashes, k) for _, hashes in words.texts(batch.column(1))]
            columns = [batch.column(0), pa.array([registers(m).tobytes() for m in members], pa.binary()), pa.array([m.tobytes() for m in members], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "regs", "members"])

    return run


def _likely(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n = [part.column(i).to_numpy().astype(float) for i in (2, 3)]
                guess, behind = likelihood(_rows_of(part.column(4), np.uint16), _rows_of(part.column(5), np.uint16), *n, threshold)
                keep = pa.array((guess >= threshold) | (behind <= SURE))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(keep)

    return run


def _verified(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                inter = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(den * inter >= num * (len(one) + len(two) - inter))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def links_of(pairs: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The candidate pairs (a, b, n_a, n_b) that are links, verified on the full sets."""

    def with_both(rows: DataFrame, column: str) -> DataFrame:
        one = sets.select(F.col("id").alias("a"), F.col(column).alias("x"))
        two = sets.select(F.col("id").alias("b"), F.col(column).alias("y"))
        return rows.join(one, "a").join(two, "b")

    regs = with_both(pairs, "regs").select("a", "b", "n_a", "n_b", "x", "y")
    likely = scratch.keep(regs.mapInArrow(_likely(num / den), "a long, b long"), "likely")
    links = scratch.keep(
        with_both(likely, "members").select("a", "b", "x", "y").mapInArrow(_verified(num, den), "a long, b long"), "links"
    )
    scratch.drop(pairs, likely)
    return links


def _sizes_allow(num: int, den: int):
    return (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)


def _hub_pairs(members: DataFrame, label: DataFrame, seed: int, num: int, den: int) -> DataFrame:
    placed = members.join(label, "id", "left").select("key", "id", "n", "class", F.coalesce("component_id", "id").alias("c"))
    central = F.struct(-F.col("class"), F.xxhash64("id", "key", F.lit(seed)))
    hub = F.min_by(F.struct("id", "n", "c"), central).alias("hub")
    parts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"), hub)
    largest = F.max_by("hub", F.struct(F.col("m"), F.xxhash64("c", F.lit(seed)))).alias("hub")
    open_ = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), largest).filter("parts > 1")
    tries = (
        placed.join(open_.select("key", "hub"), "key")
        .select(F.col("id").alias("a"), F.col("n").alias("n_a"), "c", "hub")
        .filter("c <> hub.c")
        .select("a", "n_a", F.col("hub.id").alias("b"), F.col("hub.n").alias("n_b"))
        .filter(_sizes_allow(num, den))
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    best = Window.partitionBy("a").orderBy(F.desc("shared"), "b")  # at most one row a band in each
    return tries.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= HUBS_TRIED).drop("place", "shared")


def _each_member(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in part.column(2)]
            ids, c = (np.repeat(part.column(i).to_numpy(), [len(s) for s in sets]) for i in (0, 1))
            n = np.repeat([len(s) for s in sets], [len(s) for s in sets])
            columns = [pa.array(ids), pa.array(c), pa.array(n, pa.int64()), pa.array(np.concatenate(sets))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "c", "n", "member"])


def _parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        odd = np.zeros((batch.num_rows, CELLS), dtype=bool)
        for row, v in enumerate(batch.column(1)):
            cells = np.frombuffer(v.as_buffer(), dtype=np.uint64) & np.uint64(CELLS - 1)
            odd[row] = np.bincount(cells.astype(np.int64), minlength=CELLS) & 1
        packed = np.packbits(odd, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in packed.T)], ["id", *PARITY])


def _open_pairs(members: DataFrame, sets: DataFrame, label: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Pairs of texts in different components of one bucket that may be linked."""
    placed = scratch.keep(members.join(label, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c")), "placed")
    count = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    main = count.groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    ready = placed.join(main.select("key", "main"), "key")
    texts = scratch.keep(ready.groupBy("id", "c").agg(F.max(F.col("c") != F.col("main")).alias("outside")), "open-texts")
    each = texts.join(sets, "id").select("id", "c", "members").mapInArrow(_each_member, "id long, c long, n long, member long")
    each = scratch.keep(each, "open-members")
    often = scratch.keep(each.groupBy("member").agg(F.count(F.lit(1)).alias("often")), "often")
    parity = texts.join(sets, "id").select("id", "members").mapInArrow(_parity, ", ".join(f"{c} long" for c in ["id", *PARITY]))
    parity = scratch.keep(parity, "parity")
    rank = Window.partitionBy("id", "n").orderBy("often", "member")  # the members of one set
    first = F.col("n") - F.ceil(F.col("n") * num / F.lit(den)) + 1
    prefix = each.join(often, "member").withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= first).drop("often")
    prefix = scratch.keep(prefix.join(parity, "id"), "prefixes")
    outside = prefix.join(texts.filter("outside").select("id"), "id", "left_semi")
    one = outside.select("member", F.col("id").alias("a"), F.col("c").alias("c_a"), F.col("n").alias("n_a"), F.col("place").alias("i"), *[F.col(p).alias(f"{p}_a") for p in PARITY])
    two = prefix.select("member", F.col("id").alias("b"), F.col("c").alias("c_b"), F.col("n").alias("n_b"), F.col("place").alias("j"), *[F.col(p).alias(f"{p}_b") for p in PARITY])
    reach = F.lit(1) + F.least(F.col("n_a") - F.col("i"), F.col("n_b") - F.col("j"))
    enough = reach * (num + den) >= (F.col("n_a") + F.col("n_b")) * num
    alone = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in PARITY), F.lit(0))
    near = alone * (num + den) <= (F.col("n_a") + F.col("n_b")) * (den - num)
    pairs = one.join(two, "member").filter((F.col("c_a") != F.col("c_b")) & enough & near & _sizes_allow(num, den))
    ordered = pairs.select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    )
    made = scratch.keep(ordered.distinct(), "open-pairs")
    scratch.drop(placed, texts, each, prefix, often, parity)
    return made


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Texts are linked when ``den`` * |intersection| >= ``num`` * |union| of their ``k``-word shingle sets
    (k > 0, num / den > 0.5).  A text of fewer than k words is one shingle of all its words; one without
    words, empty or null, has an empty set and is linked with nothing.  component_id is the smallest id
    that links reach; kept means id = component_id.  Rows that repeat an id are one node of the graph.
    A row with a null id takes no part: its component_id is null and it is kept.  An empty table gives
    an empty result; columns other than the two are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession, "near-groups")
    sketch = scratch.keep(rows.mapInArrow(_sketch(k), "id long, n long, low long, high long, regs binary"), "sketches")
    named = sketch.filter("n > 0 AND id IS NOT NULL")
    same = ["n", "low", "high"]
    groups = scratch.keep(
        named.groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("regs").alias("regs")),
        "sets",
    )
    copies = named.select("id", *same).join(groups.filter("copies > 1").select("rep", *same), same)
    links = [scratch.keep(copies.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")), "copies")]
    banded = groups.select(F.col("rep").alias("id"), "n", "regs").mapInArrow(_bands, "id long, n long, key long")
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    bucketed = scratch.keep(banded.join(shared, "key"), "buckets")
    # texts that meet many others are near the middle of their group; classes are powers of the root of 2
    company = bucketed.groupBy("id").agg(F.floor(2 * F.log2(F.sum("m"))).alias("class"))
    members = scratch.keep(bucketed.drop("m").join(company, "id"), "members")
    scratch.drop(bucketed)
    sizes = scratch.keep(sketch.select("id", "n"), "sizes")
    scratch.drop(groups, sketch)
    wanted = members.select("id").distinct()
    sets = scratch.keep(
        rows.join(wanted, "id", "left_semi").mapInArrow(_sets(k), "id long, regs binary, members binary"), "member-sets"
    )
    label = docs.sparkSession.createDataFrame([], "id long, component_id long")
    for seed in range(1, ROUNDS + 1):
        pairs = scratch.keep(_hub_pairs(members, label, seed, num, den), "hub-pairs")
        links.append(links_of(pairs, sets, num, den, scratch))
        before, label = label, _labels(links[1:], scratch)
        scratch.drop(before)
    links.append(links_of(_open_pairs(members, sets, label, num, den, scratch), sets, num, den, scratch))
    scratch.drop(label, members, sets)
    label = _labels(links, scratch)
    scratch.drop(*links)
    return (
        sizes.select("id", F.col("n").alias("n_shingles"))
        .join(label, "id", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def _labels(links: list[DataFrame], scratch: Scratch) -> DataFrame:
    whole = links[0]
    for more in links[1:]:
        whole = whole.unionByName(more)
    return components(whole, scratch)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, with all columns; texts move once more."""
    gone = near_groups(docs, id_col, text_col, k, num, den).filter("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
