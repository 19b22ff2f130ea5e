"""Evidence of key skew, from captured arrivals and from metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import HOT_TENANT


def source_partition_skew(arrivals: DataFrame) -> DataFrame:
    """Records and share of each source partition, per tenant within it and for all tenants."""
    per_key = arrivals.groupBy("src_partition", F.col("key").alias("tenant_id")).agg(
        F.count(F.lit(1)).alias("records")
    )
    # One row per source partition, and one number for all of them.
    per_partition = per_key.groupBy("src_partition").agg(F.sum("records").alias("partition_records"))
    everything = per_partition.agg(F.sum("partition_records")).scalar()
    return per_key.join(per_partition, "src_partition").select(
        "src_partition",
        "tenant_id",
        "records",
        "partition_records",
        F.round(F.col("records") / everything, 6).alias("share"),
        F.round(F.col("partition_records") / everything, 6).alias("partition_share"),
    )


def key_partition_invariant(arrivals: DataFrame) -> DataFrame:
    """For each key, how many source partitions carried it and whether that is exactly one."""
    parts = F.count_distinct("src_partition")
    return arrivals.groupBy(F.col("key").alias("tenant_id")).agg(
        parts.alias("partitions"), (parts == 1).alias("single_partition")
    )


def partition_load(
    rows: DataFrame, key: str = "tenant_id", partitions: int = 4, read_by: Column | None = None, hashed: Column | None = None
) -> DataFrame:
    """Records per partition as read, and per partition once they were hashed by key.

    ``read_by`` names the partition a record was read from, the task's own number by default; ``hashed`` is the
    hash of the key, the one of Spark's shuffles by default.  Both loads come from counts: no row is moved.
    """
    source = F.spark_partition_id() if read_by is None else read_by
    read = rows.groupBy(source.cast("int").alias("partition_index")).agg(F.count(F.lit(1)).alias("records"))
    by_key = keyed_load(rows, partitions, key, hashed).withColumn("partition_index", F.col("subtask").cast("int"))

    def stage(load: DataFrame, name: str) -> DataFrame:
        return load.select(F.lit(name).alias("stage"), "partition_index", "records")

    return stage(read, "as_read").unionByName(stage(by_key, "by_key"))


def keyed_load(rows: DataFrame, partitions: int = 4, key: str = "tenant_id", hashed: Column | None = None) -> DataFrame:
    """Records and hot-tenant records each keyed partition would own.

    Only the number of keys per partition matters, so rows are counted per key before anything else.
    """
    owner = F.pmod(F.hash(key) if hashed is None else hashed, F.lit(partitions)).cast("int")
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(owner.alias("subtask")).agg(
        F.sum("n").alias("records"),
        F.coalesce(F.sum(F.when(F.col(key) == HOT_TENANT, F.col("n"))), F.lit(0)).alias("hot_records"),
    )


EVIDENCE = ("keyed_records", "hot_state", "local_recent", "remote_recent")

# How each reading is named in coverage errors.
EVIDENCE_TITLE = {
    "keyed_records": "lab_keyed_records",
    "hot_state": "lab_hot_tenant_state_count",
    "local_recent": "local recent shuffle",
    "remote_recent": "remote recent shuffle",
}


def evidence_maps(readings: DataFrame, scope: str) -> DataFrame:
    """One row per scope with a map subtask -> value for each kind of reading.

    ``readings`` holds ``scope, reading, subtask, value`` with one row per subtask, so a map has at
    most as many entries as the job has subtasks.
    """
    entry = F.struct("subtask", "value")

    def gathered(kind: str) -> Column:
        entries = F.array_sort(F.collect_list(F.when(F.col("reading") == kind, entry)))
        return F.map_from_entries(entries).alias(kind)

    return readings.groupBy(scope).agg(*[gathered(kind) for kind in EVIDENCE])


def number_text(value: Column) -> Column:
    """Whole numbers with one decimal, as in 100.0, also where a double's own text has an exponent."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    return F.when(whole, F.concat(value.cast("decimal(16,0)").cast("string"), F.lit(".0"))).otherwise(value.cast("string"))


def list_text(items: Column) -> Column:
    quoted = F.transform(items, lambda s: F.concat(F.lit("'"), s.cast("string"), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def map_text(entries: Column) -> Column:
    shown = F.transform(
        F.map_entries(entries),
        lambda e: F.concat(F.lit("'"), e["key"].cast("string"), F.lit("': "), number_text(e["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(shown, ", "), F.lit("}"))


def hot_owners(hot_state: Column) -> Column:
    return F.map_keys(F.map_filter(hot_state, lambda _k, v: v > 0))


def expected_subtasks(parallelism: int) -> Column:
    return F.sequence(F.lit(0), F.lit(parallelism - 1))


def coverage_errors(parallelism: int) -> list[Column]:
    expected = expected_subtasks(parallelism)
    errors = []
    for kind in EVIDENCE:
        reported = F.array_sort(F.map_keys(F.col(kind)))
        text = F.concat(
            F.lit(f"{EVIDENCE_TITLE[kind]} subtasks are "), list_text(reported), F.lit(", expected "), list_text(expected)
        )
        errors.append(F.when(reported != expected, text))
    return errors


def owner_errors() -> list[Column]:
    owners = hot_owners(F.col("hot_state"))
    total = F.aggregate(F.map_values("keyed_records"), F.lit(0.0), lambda acc, v: acc + v)
    majority = F.exists(
        owners, lambda o: F.coalesce(F.try_element_at(F.col("keyed_records"), o), F.lit(0.0)) > total / 2
    )
    return [
        F.when(
            F.size(owners) != 1,
            F.concat(
                F.lit("expected exactly one positive tenant-hot state gauge, found "),
                F.size(owners).cast("string"), F.lit(" ("), list_text(owners), F.lit(")"),
            ),
        ),
        F.when(
            ~majority,
            F.concat(
                F.lit("expected the tenant-hot owner to process a majority of records; found "),
                map_text(F.col("keyed_records")),
            ),
        ),
    ]


def shuffle_errors() -> list[Column]:
    moving = F.exists(F.map_values("local_recent"), lambda v: v > 0)
    remote = F.map_filter("remote_recent", lambda _k, v: v != 0)
    return [
        F.when(~moving, F.lit("recent local shuffle rates contain no positive byte rate")),
        F.when(
            F.size(F.map_keys(remote)) > 0,
            F.concat(F.lit("recent remote shuffle rates are not zero: "), map_text(remote)),
        ),
    ]


def verification_errors(evidence: DataFrame, parallelism: int = 4) -> DataFrame:
    """The ordered list of failed checks of each scope; empty when the evidence holds."""
    found = F.array(*coverage_errors(parallelism), *owner_errors(), *shuffle_errors())
    return evidence.withColumn("errors", F.filter(found, lambda e: e.isNotNull()))


def hot_owner_check(load: DataFrame) -> DataFrame:
    """Whether exactly one partition owns the hot tenant and that owner holds more than half of all records."""
    owned = F.col("hot_records") > 0
    return load.agg(
        F.sum("records").alias("records"),
        F.count_if(owned).alias("owners"),
        F.coalesce(F.max(F.when(owned, F.col("records"))), F.lit(0)).alias("owner_records"),
    ).select(
        "*",
        (F.col("owners") == 1).alias("single_owner"),
        (2 * F.col("owner_records") > F.col("records")).alias("owner_has_majority"),
    )


def subtask_coverage(readings: DataFrame, group: list[str], parallelism: int = 4) -> DataFrame:
    """Per group, the expected subtasks that reported nothing."""
    reported = F.collect_set("subtask")
    return readings.groupBy(*group).agg(
        F.count_distinct("subtask").alias("reported"),
        F.array_join(F.array_except(expected_subtasks(parallelism), reported), ",").alias("missing"),
    )


def shuffle_check(recent: DataFrame, group: list[str]) -> DataFrame:
    """Recent local transfer is positive somewhere, and recent remote transfer is zero everywhere."""
    return recent.groupBy(*group).agg(
        (F.coalesce(F.max("local_recent"), F.lit(0.0)) > 0).alias("local_moving"),
        (F.count_if(F.col("remote_recent") != 0) == 0).alias("remote_silent"),
    )
