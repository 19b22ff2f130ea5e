"""Reconciliation of what was sent, captured, stored and rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.views import reversed_timeline
from tidemark.schema import HOT_TENANT

STAGES = ("attempted", "captured", "stored", "rejected")


def stage_totals(*counts: DataFrame) -> DataFrame:
    """One-row tables of stage counts side by side, without a join; an absent stage counts zero."""
    tagged = counts[0]
    for part in counts[1:]:
        tagged = tagged.unionByName(part, allowMissingColumns=True)
    for name in set(STAGES) - set(tagged.columns):
        tagged = tagged.withColumn(name, F.lit(None).cast("long"))
    return tagged.agg(*[F.coalesce(F.sum(s), F.lit(0)).cast("long").alias(s) for s in STAGES])


def judge_totals(totals: DataFrame) -> DataFrame:
    return totals.select(
        "*",
        (F.col("captured") == F.col("attempted")).alias("captured_all"),
        (F.col("stored") + F.col("rejected") == F.col("attempted")).alias("accounted_all"),
    )


def reconcile(attempted: DataFrame, captured: DataFrame, stored: DataFrame, rejected: DataFrame) -> DataFrame:
    """Every attempt was captured, and every captured record was stored or rejected."""
    tables = {"attempted": attempted, "captured": captured, "stored": stored, "rejected": rejected}
    return judge_totals(stage_totals(*[t.agg(F.count(F.lit(1)).alias(name)) for name, t in tables.items()]))


def reconcile_validated(attempted: DataFrame, validated: DataFrame) -> DataFrame:
    """The same check on validated arrivals, in one pass over them."""
    outcome = validated.agg(
        F.count(F.lit(1)).alias("captured"),
        F.count_if("is_valid").alias("stored"),
        F.count_if(~F.col("is_valid")).alias("rejected"),
    )
    return judge_totals(stage_totals(attempted.agg(F.count(F.lit(1)).alias("attempted")), outcome))


def observation_gates(telemetry: DataFrame) -> DataFrame:
    """Per run: each anomaly was seen at least once, no timeline runs backwards, nothing was lost."""
    per_run = telemetry.groupBy("producer_run_id").agg(
        F.count_if("injected_duplicate").alias("duplicates"),
        F.count_if("injected_late").alias("claimed_late"),
        F.count_if("is_late").alias("observed_late"),
        F.count_if(F.col("tenant_id") == HOT_TENANT).alias("hot"),
        F.count_if(F.col("watermark_at_arrival").isNotNull()).alias("marked"),
        F.count_if(reversed_timeline()).alias("reversed"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("producer_sequence").alias("unique_sends"),
    )
    seen = [F.col(c) > 0 for c in ("duplicates", "claimed_late", "observed_late", "hot", "marked")]
    all_seen = seen[0]
    for condition in seen[1:]:
        all_seen = all_seen & condition
    return per_run.select(
        "producer_run_id",
        "n_rows",
        "unique_sends",
        all_seen.alias("anomalies_seen"),
        (F.col("reversed") == 0).alias("timeline_ordered"),
        (F.col("n_rows") >= F.col("unique_sends")).alias("rows_cover_sends"),
    )


def no_loss(telemetry: DataFrame, sent: DataFrame) -> DataFrame:
    """Per run: unique stored sends equal the sends made, even where replays stored more rows."""
    stored = telemetry.groupBy("producer_run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("producer_sequence").alias("unique_sends")
    )
    made = sent.groupBy("producer_run_id").agg(F.count(F.lit(1)).alias("sends"))
    return made.join(stored, "producer_run_id", "left").select(
        "producer_run_id",
        "sends",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("unique_sends", F.lit(0)).alias("unique_sends"),
        (F.coalesce("unique_sends", F.lit(0)) == F.col("sends")).alias("no_loss"),
    )
