"""Per-key counts: running numbers, milestones, and salted totals for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_decimal_milestone
from tidemark.operators.prefix import running_number
from tidemark.schema import HOT_TENANT


def running_tenant_count(
    rows: DataFrame, order: list[str], block: Column, key: str = "tenant_id"
) -> DataFrame:
    """Each row with how many rows of its tenant have arrived so far, itself included.

    ``block`` cuts a tenant's arrivals into bounded runs, so a tenant holding most rows is still
    spread over the cluster.
    """
    return running_number(rows, [key], order, block, "tenant_record_count")


def hot_milestones(counted: DataFrame, tenant: str = HOT_TENANT) -> DataFrame:
    """The rows at which the hot tenant's count reached 1, 10, 100, ..."""
    return counted.filter((F.col("tenant_id") == tenant) & is_decimal_milestone(F.col("tenant_record_count")))


def salted_counts(rows: DataFrame, key: str = "tenant_id", spread_by: str = "event_id", salts: int = 64) -> DataFrame:
    """Count and distinct-event count per key in two stages.

    The salt is taken from the event id, so an event falls in one salt and the distinct counts of
    the salts add up exactly.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    partial = rows.groupBy(key, salt.alias("salt")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(spread_by).alias("u")
    )
    return partial.groupBy(key).agg(F.sum("n").alias("n_rows"), F.sum("u").alias("unique_event_ids"))


def by_tenant(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Place all rows of a tenant in one partition, as keyed state needs it."""
    return rows.repartition(partitions, "tenant_id") if partitions else rows.repartition("tenant_id")
