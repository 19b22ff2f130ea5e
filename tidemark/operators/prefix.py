"""Running aggregates that never gather a whole key in one task.

A plain ``sum(...) over (partition by key order by t)`` sends every row of a key to one task.  Here
each key is cut into blocks of consecutive rows: the window runs inside a (key, block), a small
table of block totals gives what came before each block, and the two are joined on (key, block).
Both sides are partitioned by (key, block), so the rows themselves are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 65_536

_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}
_COMBINE = {
    "sum": lambda before, local: F.coalesce(before, F.lit(0)) + F.coalesce(local, F.lit(0)),
    "max": lambda before, local: F.greatest(before, local),
    "min": lambda before, local: F.least(before, local),
}


@dataclass(frozen=True)
class Running:
    """One running measure: sum, max or min of a column over rows up to the current one."""

    kind: str
    value: Column
    include_current: bool = True


def blocked_running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column,
    measures: dict[str, Running],
) -> DataFrame:
    """Add running measures per key.

    ``block`` must not decrease along ``order`` and should hold a bounded number of rows for one
    key, such as a dense number divided by a block size.  ``order`` must be unique within a key, and
    key columns must not be NULL.
    """
    stamped = df.withColumn("_block", block)
    group = [*keys, "_block"]
    inside = Window.partitionBy(*group).orderBy(*order)
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    preceding = inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier_blocks = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )

    local = stamped.select(
        "*",
        *[
            _AGGREGATE[m.kind](m.value).over(up_to if m.include_current else preceding).alias(f"_local_{name}")
            for name, m in measures.items()
        ],
    )
    totals = stamped.groupBy(*group).agg(
        *[_AGGREGATE[m.kind](m.value).alias(f"_total_{name}") for name, m in measures.items()]
    )
    before = totals.select(
        *group,
        *[
            _AGGREGATE[m.kind](F.col(f"_total_{name}")).over(earlier_blocks).alias(f"_before_{name}")
            for name, m in measures.items()
        ],
    )
    joined = local.join(before, group, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            _COMBINE[m.kind](F.col(f"_before_{name}"), F.col(f"_local_{name}")).alias(name)
            for name, m in measures.items()
        ],
    )


def running_number(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column,
    name: str = "n",
) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return blocked_running(df, keys, order, block, {name: Running("sum", F.lit(1).cast("long"))})

