"""Deterministic telemetry data derived row by row from the ``events`` table.

Every dataset is a projection of ``events`` (plus an explode for copies), so it grows with the table
and needs no driver-side data.  ``duck.py`` states the same derivations for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.prefix import Running, blocked_running, running_number
from tidemark.schema import HOT_TENANT
from tidemark.session import configure

ARRIVAL_BLOCK = 65_536
REGIONS = ("north", "coast", "inland")
FIRMWARES = ("7.1.0", "7.1.4", "8.0.0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(index: str, options: tuple[str, ...]) -> str:
    return f"element_at(array({', '.join(repr(o) for o in options)}), cast({index} + 1 AS int))"


def iso(ms: str) -> str:
    return f"""date_format(timestamp_millis({ms}), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")"""


def placed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` dealt by event to as many partitions as the session shuffles into.

    The table is smaller than the text derived from it, and Spark cuts scans by bytes: without this, all
    making and parsing of text would be done by the few tasks that read the table.
    """
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def base(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One row per event with the identifiers and flags all other datasets use."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return (placed(spark, events) if spread else events).selectExpr(
        "event_id AS eid",
        "user_id",
        "unix_millis(cast(ts AS timestamp)) AS ems",
        "event_id * 17 % 100 < 10 AS late",
        "event_id % 20 = 0 AS has_dup",
        "event_id % 200 = 7 AS bad",
        f"""CASE WHEN event_id * 31 % 100 < 80 THEN '{HOT_TENANT}'
            ELSE concat('tenant-', lpad(cast(1 + user_id % 20 AS string), 3, '0')) END AS tenant_id""",
        "cast(CASE WHEN event_id * 31 % 100 < 80 THEN 0 ELSE 1 + user_id % 5 END AS int) AS src_partition",
        "concat('device-', lpad(cast(1 + user_id % 2000 AS string), 4, '0')) AS device_id",
        "event_type AS metric_name",
        "cast(value AS decimal(18, 3)) AS metric_value",
        f"{choose('event_id * 7 % 3', REGIONS)} AS region",
        f"{choose('event_id % 3', FIRMWARES)} AS firmware",
    )


def sends(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Originals and intentional duplicates: one row per send."""
    copies = base(spark, sf_dir, spread).selectExpr(
        "*", "explode(if(has_dup, array(0L, 1L), array(0L))) AS copy"
    )
    return copies.selectExpr(
        "*",
        "2 * eid + copy AS producer_sequence",
        "concat('run-', eid % 4) AS producer_run_id",
        "concat('event-', eid) AS event_id",
        "ems + if(late, 15000 + 1000 * (eid * 13 % 286), eid % 2000) + copy AS pms",
        "ems - if(late, 1000 * (600 + eid * 13 % 3600), 0) AS vms",
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sends as JSON text in ``value``, some originals with one defect each."""
    metric = "if(copy = 0 AND eid % 500 = 3, 'true', cast(metric_value AS string))"
    produced = f"if(copy = 0 AND eid % 500 = 13, rtrim('Z', {iso('pms')}), {iso('pms')})"
    region = "if(copy = 0 AND eid % 500 = 11, '', concat(',\"region\":\"', region, '\"'))"
    text = f"""concat(
        '{{"device_id":"', device_id, '","event_id":"', event_id, '","event_time":"', {iso('vms')},
        '","firmware":"', firmware, '","injected_duplicate":', copy = 1, ',"injected_late":', late,
        ',"metric_name":"', metric_name, '","metric_value":', {metric}, ',"produced_at":"', {produced},
        '","producer_run_id":"', producer_run_id, '","producer_sequence":', producer_sequence,
        {region}, ',"schema_version":1,"tenant_id":"', tenant_id, '"}}')"""
    return (
        sends(spark, sf_dir, spread=True)
        .selectExpr("*", f"{text} AS whole")
        .selectExpr(
            "eid",
            "copy",
            "producer_sequence AS arrival",
            "pms AS sent_ms",
            "tenant_id AS key",
            "if(copy = 0 AND bad, left(whole, length(whole) - 1), whole) AS value",
            "src_partition",
            "eid - eid % 8 AS batch_id",
            "eid div 8 * 10000 AS batch_ms",
        )
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sends with the offset each got in its source partition."""
    numbered = running_number(
        raw(spark, sf_dir), ["src_partition"], ["arrival"], F.expr(f"arrival div {ARRIVAL_BLOCK}"), "position"
    )
    return numbered.selectExpr("*", "position - 1 AS offset").drop("position")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table: every send once, and some sends twice after a recovery replay."""
    rows = sends(spark, sf_dir).selectExpr(
        "*",
        "explode(if(eid % 997 = 5, array(0L, 1L), array(0L))) AS replay",
        "pms + 50 + eid % 400 AS processed_ms",
        """CASE WHEN eid >= 8 THEN
             ems + 1500 * (if(late, eid * 29 % 100 - 20, eid * 29 % 100 - 97)) END AS watermark_ms""",
    )
    return rows.selectExpr(
        "1 AS schema_version",
        "producer_run_id",
        "producer_sequence",
        "timestamp_millis(pms) AS produced_at",
        "event_id",
        "tenant_id",
        "device_id",
        "metric_name",
        "cast(metric_value AS double) AS metric_value",
        "timestamp_millis(ems) AS event_time",
        "region",
        "firmware",
        "copy = 1 AS injected_duplicate",
        "late AS injected_late",
        "timestamp_millis(processed_ms) AS processed_at",
        "timestamp_millis(watermark_ms) AS watermark_at_arrival",
        "coalesce(ems <= watermark_ms, false) AS is_late",
        "greatest(0L, coalesce(watermark_ms - ems, 0L)) AS lateness_ms",
        "timestamp_millis(processed_ms + 20 + eid % 900 + 1000 * replay) AS ingested_at",
        "date_format(timestamp_millis(ems), 'yyyyMM') AS ym",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sender tried: one row per send with its size and enqueue time."""
    return raw(spark, sf_dir).selectExpr(
        "concat('run-', eid % 4) AS run_id",
        "arrival AS producer_sequence",
        "concat('event-', eid) AS event_id",
        "cast(octet_length(value) AS bigint) AS payload_bytes",
        "sent_ms AS enqueued_ms",
    )


def callbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the broker answered: acknowledgements, failures, and silence for some sends."""
    answered = sends(spark, sf_dir).filter("producer_sequence % 97 <> 0")
    return answered.selectExpr("*", "producer_sequence % 101 = 0 AS failed").selectExpr(
        "producer_run_id AS run_id",
        "producer_sequence",
        "if(failed, NULL, src_partition) AS partition",
        "if(failed, NULL, producer_sequence) AS offset",
        "if(failed, NULL, pms + 1 + eid * 7 % 40) AS acked_ms",
        "failed",
        "eid % 13 AS tx_retries",
    )


def flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to when each run was flushed: two to their ends, one not to its end, and one not at all."""
    ended = attempts(spark, sf_dir).filter("run_id <> 'run-2'").groupBy("run_id").agg(F.max("enqueued_ms").alias("last_ms"))
    return ended.selectExpr("run_id", "last_ms - if(run_id = 'run-3', 86400000L, 0L) AS flushed_ms")


def client_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sender statistics as JSON text, in the shapes retry extraction has to cope with."""
    text = """CASE user_id % 6
        WHEN 0 THEN concat('{"txretries":', v, '}')
        WHEN 1 THEN concat('{"brokers":{"a":{"txretries":', v, '},"b":{"txretries":', v % 7, '}}}')
        WHEN 2 THEN concat('{"txretries":true,"brokers":{"a":{"txretries":', v, '},"b":7}}')
        WHEN 3 THEN concat('{"txretries":-', 1 + v, '}')
        WHEN 4 THEN concat('{"brokers":{"a":{"txretries":-2},"b":{"txretries":', v, '},"c":{}}}')
        ELSE '{"brokers":[1,2]}' END"""
    counted = base(spark, sf_dir).selectExpr("eid", "user_id", "cast(floor(metric_value) AS bigint) AS v")
    return counted.selectExpr("concat('run-', eid % 4) AS run_id", "eid", f"{text} AS statistics")


# Names of the metric series this package reports.
VALID_TOTAL = "pipeline_records_valid_total"
KEYED_TOTAL = "pipeline_keyed_records_total"
PENDING = "pipeline_source_pending_records"
UP = "up"
INPUT_WATERMARK = "pipeline_input_watermark_ms"
HOT_STATE = "pipeline_hot_tenant_state_count"
LOCAL_BYTES = "pipeline_shuffle_local_bytes_per_second"
REMOTE_BYTES = "pipeline_shuffle_remote_bytes_per_second"
JOBS = ("broker", "stream-driver", "stream-executor", "warehouse")


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one sample at its own time: the type of event says which metric, the user which series.

    Counters are running sums of the values of their events, one of them starting again at 5,000; gauges show the
    value itself.  The sums are made in blocks of a day.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "cast(ts AS timestamp) AS ts", "user_id", "event_type", "value", "cast(floor(value) AS bigint) AS whole"
    )
    named = events.selectExpr(
        "*",
        f"""CASE event_type WHEN 'click' THEN '{VALID_TOTAL}' WHEN 'view' THEN '{KEYED_TOTAL}' WHEN 'signup' THEN '{PENDING}'
            WHEN 'error' THEN {choose('user_id % 3', (UP, INPUT_WATERMARK, HOT_STATE))}
            ELSE {choose('user_id % 2', (LOCAL_BYTES, REMOTE_BYTES))} END AS name""",
        "if(event_type = 'view' AND user_id % 10 < 7, 2, user_id % 4) AS shard",
    )
    counted = blocked_running(
        named, ["name", "shard"], ["ts", "event_id"], F.expr("unix_seconds(ts) div 86400"),
        {"total": Running("sum", F.col("whole"))},
    )
    samples = counted.selectExpr(
        "event_id",
        "ts",
        "name",
        f"if(name = '{UP}', NULL, shard) AS subtask",
        f"if(name = '{UP}', {choose('user_id div 3 % 4', JOBS)}, 'stream-executor') AS job",
        "if(event_type = 'click' AND whole = 13, concat('j', user_id % 7), NULL) AS runtime_id",
        f"""cast(CASE name WHEN '{VALID_TOTAL}' THEN total % 5000 WHEN '{KEYED_TOTAL}' THEN total
            WHEN '{PENDING}' THEN if(user_id % 50 = 7, double('NaN'), value)
            WHEN '{UP}' THEN if(value > 60, 0, 1)
            WHEN '{INPUT_WATERMARK}' THEN unix_millis(ts) - 100 * whole
            WHEN '{HOT_STATE}' THEN if(shard = 2, whole, 0)
            WHEN '{LOCAL_BYTES}' THEN whole
            ELSE if(value > 300, whole, 0) END AS double) AS value""",
    )
    labels = """map_filter(map('subtask_index', cast(subtask AS string), 'job', job, 'job_id', runtime_id),
        (k, v) -> v IS NOT NULL) AS labels"""
    return samples.selectExpr("event_id", "ts", "name", labels, "value")


# Services whose logs are collected, and the messages they write.
SERVICES = ("sender", "stream-driver", "stream-executor")
REJECT_MESSAGE = "invalid_record_routed_to_dlq"
MILESTONE_MESSAGE = "keyed_state_milestone"
FINAL_EVENT = "producer_final"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event, most of them JSON, with a service name."""
    level = choose("eid div 3 % 4", ("INFO", "INFO", "WARNING", "ERROR"))
    job = f"""head, ',"component":"stream-job","message":"'"""
    text = f"""CASE
        WHEN eid % 10 = 0 THEN concat(head, ',"event":"{FINAL_EVENT}","producer_run_id":"run-', eid % 4,
            '","attempted":', eid * 2, ',"acked":', eid * 2 - if(eid % 3 = 0, 1, 0),
            ',"failed":', if(eid % 3 = 0, 1, 0), ',"undelivered":0,"reconciled":true}}')
        WHEN eid % 10 < 4 THEN concat({job}, '{REJECT_MESSAGE}","error_category":"invalid_json","raw_payload_length":',
            100 + eid % 200, '}}')
        WHEN eid % 10 < 6 THEN concat({job}, '{MILESTONE_MESSAGE}","tenant_id":"tenant-hot","tenant_record_count":', eid, '}}')
        WHEN eid % 10 = 6 THEN concat('Savepoint completed. Path: file:///ckpt/', eid % 11,
            '; Savepoint completed. Path: file:///ckpt/sp-', eid, '.')
        WHEN eid % 10 = 7 THEN concat('plain text line ', eid)
        WHEN eid % 10 = 8 AND eid % 3 = 0 THEN concat({job}, 'said ', char(92), '"stop', char(92), '""}}')
        WHEN eid % 10 = 8 AND eid % 3 = 1 THEN concat({job}, 'caf', char(92), 'u00e9 open"}}')
        ELSE concat({job}, 'job_starting"}}') END"""
    stamped = base(spark, sf_dir, spread=True).selectExpr(
        "eid", f"""concat('{{"timestamp":"', {iso('ems')}, '","level":"', {level}, '"') AS head"""
    )
    return stamped.selectExpr("eid", f"{choose('eid % 3', SERVICES)} AS service", f"{text} AS raw")
