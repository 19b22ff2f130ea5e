"""Quantile summaries that are stored per minute and merged to any longer span.

A summary is a KLL sketch of whole-millisecond values: of bounded size whatever it has seen, and merging two gives
the summary of both, so a day's quantiles come from 1,440 stored rows and not from the day's records.  The rank of a
quantile read from it is off by at most ``RANK_ERROR`` of the rows with high probability; ``rank_errors`` measures it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import PROBABILITIES

SIZE = 800
RANK_ERROR = 0.01


def summarize(rows: DataFrame, keys: list[str], measures: dict[str, Column], size: int = SIZE) -> DataFrame:
    """Per group: n_rows and one sketch for each measure; a NULL value is counted and not summarised."""
    sketches = [F.kll_sketch_agg_bigint(value.cast("long"), F.lit(size)).alias(name) for name, value in measures.items()]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def merge(summaries: DataFrame, span: dict[str, Column], measures: list[str]) -> DataFrame:
    """Summaries of longer spans from those of shorter ones."""
    merged = [F.kll_merge_agg_bigint(name).alias(name) for name in measures]
    return summaries.groupBy(*[c.alias(k) for k, c in span.items()]).agg(F.sum("n_rows").alias("n_rows"), *merged)


def quantiles(summaries: DataFrame, keys: list[str], measures: list[str], probabilities=PROBABILITIES) -> DataFrame:
    """Columns ``<measure>_p<percent>`` of each summary; NULL where a measure had no value."""
    return summaries.select(
        *keys,
        "n_rows",
        *[
            F.when(
                F.kll_sketch_get_n_bigint(name) > 0, F.kll_sketch_get_quantile_bigint(name, F.lit(float(p)))
            ).alias(f"{name}_p{round(p * 100)}")
            for name in measures
            for p in probabilities
        ],
    )


def rank_errors(
    rows: DataFrame, keys: list[str], name: str, value: Column, found: DataFrame, probabilities=PROBABILITIES
) -> DataFrame:
    """Per group: how far the rank of each found quantile is from the one asked for, as a share of the rows.

    Equal values have a range of ranks; the error is the distance to that range.
    """
    columns = [f"{name}_p{round(p * 100)}" for p in probabilities]
    counts = []
    for c in columns:
        counts += [F.count_if(F.col("_v") < F.col(c)).alias(f"{c}_below"), F.count_if(F.col("_v") <= F.col(c)).alias(f"{c}_upto")]
    known = rows.select(*keys, value.cast("long").alias("_v")).filter("_v IS NOT NULL")
    ranked = known.join(found.select(*keys, *columns), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts)
    return ranked.select(
        *keys,
        *[
            F.greatest(F.lit(0.0), F.col(f"{c}_below") / F.col("n") - p, F.lit(p) - F.col(f"{c}_upto") / F.col("n")).alias(f"{c}_error")
            for c, p in zip(columns, probabilities, strict=True)
        ],
    )
