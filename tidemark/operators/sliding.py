"""Ranges that overlap, without a copy of each sample for every range that holds it.

An evaluation at a moment looks back over (at - seconds, at].  Time is cut into cells of the greatest common
divisor of ``seconds`` and the distance of the moments, so a range is a whole number of cells, and samples are
reduced to one row per series and cell before anything else.  Cells are grouped into blocks as long as a range.
A range then is the head of the block its moment lies in and the tail of the block before, and both are running
aggregates inside a block.  A cell goes to two blocks however many moments a range has, and a task never holds more
of a series than two blocks: seconds / cell rows each, whatever the number of samples.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One aggregate over a range: ``sum`` or ``max`` of a column.

    ``tail`` is what a cell is worth in the block after its own, as a column over the measures of the cell, where
    that differs: sums that count time from the start of a block.
    """

    kind: str
    value: Column
    tail: Column | None = None


_AGGREGATE = {"sum": F.sum, "max": F.max}


def cell_of(seconds: int, every: int) -> int:
    """Length of a cell, in seconds."""
    return gcd(seconds, every)


def seconds_into_block(seconds: int, every: int, ts: str = "ts") -> Column:
    """Time of a sample from the start of its block, in seconds."""
    block = F.floor((_cell(ts, cell_of(seconds, every)) - 1) / F.lit(seconds // cell_of(seconds, every)))
    return (F.unix_micros(ts) - block * F.lit(seconds * 1_000_000)) / F.lit(1e6)


def _cell(ts: str, length: int) -> Column:
    """Number of the cell that holds a moment; cell c ends at c * length, which belongs to it."""
    return F.ceil(F.unix_micros(ts) / F.lit(length * 1_000_000))


def over_ranges(
    samples: DataFrame, keys: list[str], measures: dict[str, Measure], seconds: int, every: int, ts: str = "ts"
) -> DataFrame:
    """One row per key and moment whose range holds a sample: keys, at, and the measures over the range.

    Moments are the multiples of ``every`` seconds.  Samples without a time take no part; keys may be NULL, and a
    measure is NULL where all its values are.
    """
    length = cell_of(seconds, every)
    width, stride = seconds // length, every // length
    number = _cell(ts, length)
    cells = (
        samples.filter(F.col(ts).isNotNull())
        .groupBy(*keys, number.alias("_cell"))
        .agg(*[_AGGREGATE[m.kind](m.value).alias(name) for name, m in measures.items()])
        # cell c covers (c - 1, c], so the cells 1 ... width make block 0
        .withColumn("_block", F.floor((F.col("_cell") - 1) / F.lit(width)))
        .withColumn("_place", F.col("_cell") - 1 - F.col("_block") * F.lit(width))
    )
    group = [*keys, "_block"]
    plain = [F.col(name) for name in measures]
    moved = [(F.col(name) if m.tail is None else m.tail).alias(name) for name, m in measures.items()]
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in cells.select(*measures).schema.fields]
    head = cells.select(*group, "_place", F.lit("head").alias("_part"), *plain)
    tail = cells.select(*keys, (F.col("_block") + 1).alias("_block"), "_place", F.lit("tail").alias("_part"), *moved)
    # A moment is a place at which a range can end: every stride-th cell of the blocks that a cell reaches.
    first = F.pmod(-(F.col("_block") * F.lit(width) + 1), F.lit(stride))
    ends = F.when(first < width, F.sequence(first, F.lit(width - 1).cast("long"), F.lit(stride).cast("long")))
    reached = head.select(*group).unionByName(tail.select(*group)).distinct()
    moments = reached.select(*group, F.explode(ends).alias("_place"), F.lit("end").alias("_part"), *empty)

    onward = Window.partitionBy(*group).orderBy("_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    backward = Window.partitionBy(*group).orderBy(F.col("_place").desc()).rangeBetween(Window.unboundedPreceding, -1)
    in_head, in_tail = F.col("_part") == "head", F.col("_part") == "tail"
    seen = F.coalesce(F.count_if(in_head).over(onward), F.lit(0)) + F.coalesce(F.count_if(in_tail).over(backward), F.lit(0))

    def over_range(name: str, measure: Measure) -> Column:
        use = _AGGREGATE[measure.kind]
        before = use(F.when(in_head, F.col(name))).over(onward)
        after = use(F.when(in_tail, F.col(name))).over(backward)
        if measure.kind == "max":
            return F.greatest(before, after)
        return F.coalesce(before + after, before, after)

    joined = head.unionByName(tail).unionByName(moments).select(
        *group, "_place", "_part", seen.alias("_seen"), *[over_range(n, m).alias(n) for n, m in measures.items()]
    )
    at = F.timestamp_seconds((F.col("_block") * F.lit(width) + F.col("_place") + 1) * F.lit(length))
    return joined.filter("_part = 'end' AND _seen > 0").select(*keys, at.alias("at"), *measures)
