"""Quantiles per group, exact or sketched, with the rows reduced before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix import Running, blocked_running

PROBABILITIES = (0.50, 0.95, 0.99)
SKETCH_ACCURACY = 10_000


def grouped_quantiles(
    df: DataFrame,
    keys: list[str],
    measures: dict[str, Column],
    probabilities: tuple[float, ...] = PROBABILITIES,
    mode: str = "sketch",
    digits: int = 3,
    count_as: str | None = None,
    block: int | None = None,
) -> DataFrame:
    """One row per group with columns ``<measure>_p<percent>``, after a row count if one is named.

    ``sketch`` keeps a bounded summary per group and is meant for large inputs.  ``exact``
    interpolates between order statistics; the values are counted first, so a group costs as many
    rows as it has distinct whole-millisecond values, however many records it holds.  With ``block``
    these are not brought together either: ranks are carried over ranges of that many values, which
    suits a few groups with very many values.
    """
    if mode == "sketch":
        ps = F.array(*[F.lit(p) for p in probabilities])
        counted = [F.count(F.lit(1)).alias(count_as)] if count_as else []
        wide = df.groupBy(*keys).agg(
            *counted,
            *[F.percentile_approx(m, ps, F.lit(SKETCH_ACCURACY)).alias(name) for name, m in measures.items()],
        )
        picked = {(name, i): F.col(name)[i].cast("double") for name in measures for i in range(len(probabilities))}
    elif mode == "exact":
        wide = _exact(df, keys, measures, probabilities, count_as, block)
        picked = {(name, i): F.col(f"_{m}_{i}") for m, name in enumerate(measures) for i in range(len(probabilities))}
    else:
        raise ValueError("mode must be 'sketch' or 'exact'")
    return wide.select(
        *keys,
        *([count_as] if count_as else []),
        *[
            F.round(picked[name, i], digits).alias(f"{name}_p{round(p * 100)}")
            for name in measures
            for i, p in enumerate(probabilities)
        ],
    )


def _exact(
    df: DataFrame,
    keys: list[str],
    measures: dict[str, Column],
    probabilities: tuple[float, ...],
    count_as: str | None,
    block: int | None,
) -> DataFrame:
    """Count equal values, find the quantiles of the counted values, and set the measures side by side."""
    each = [F.struct(F.lit(i).alias("m"), value.cast("long").alias("v")) for i, value in enumerate(measures.values())]
    counted = (
        df.select(*keys, F.explode(F.array(*each)).alias("x"))
        .groupBy(*keys, F.col("x.m").alias("m"), F.col("x.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if block:
        per_measure = _by_rank(counted, [*keys, "m"], probabilities, block)
    else:
        ps = F.array(*[F.lit(p) for p in probabilities])
        per_measure = counted.groupBy(*keys, "m").agg(
            F.percentile("v", ps, F.col("n")).alias("q"), F.sum("n").alias("n")
        )
    rows = [F.max("n").alias(count_as)] if count_as else []
    return per_measure.groupBy(*keys).agg(
        *rows,
        *[
            F.max(F.when(F.col("m") == m, F.col("q")[i])).alias(f"_{m}_{i}")
            for m in range(len(each))
            for i in range(len(probabilities))
        ],
    )


def _by_rank(counted: DataFrame, group: list[str], probabilities: tuple[float, ...], block: int) -> DataFrame:
    """Quantiles from running counts over the distinct values of each group."""
    known = counted.filter(F.col("v").isNotNull())
    totals = counted.groupBy(*group).agg(
        F.sum("n").alias("n_all"), F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("n_known")
    )
    ranked = blocked_running(
        known, group, ["v"], F.expr(f"floor(v / {block})"), {"up_to": Running("sum", F.col("n"))}
    ).join(totals, group)

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("up_to") > rank, F.col("v"))).cast("double")

    bounds = []
    for i, p in enumerate(probabilities):
        place = F.lit(p) * (F.col("n_known") - 1)
        bounds += [value_at(F.floor(place)).alias(f"lo_{i}"), value_at(F.ceil(place)).alias(f"hi_{i}")]
    found = ranked.groupBy(*group).agg(*bounds, F.max("n_all").alias("n"), F.max("n_known").alias("n_known"))

    def between(i: int, p: float) -> Column:
        place = F.lit(p) * (F.col("n_known") - 1)
        low, high = F.col(f"lo_{i}"), F.col(f"hi_{i}")
        return low + (high - low) * (place - F.floor(place))

    nothing = F.lit(None).cast("array<double>").alias("q")
    return found.select(*group, "n", F.array(*[between(i, p) for i, p in enumerate(probabilities)]).alias("q")).unionByName(
        totals.filter("n_known IS NULL").select(*group, F.col("n_all").alias("n"), nothing)
    )
