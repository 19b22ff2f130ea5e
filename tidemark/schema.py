"""Column contracts of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The fourteen required fields, in the order error details list them.
REQUIRED_FIELDS = (
    "schema_version",
    "producer_run_id",
    "producer_sequence",
    "produced_at",
    "event_id",
    "tenant_id",
    "device_id",
    "metric_name",
    "metric_value",
    "event_time",
    "region",
    "firmware",
    "injected_duplicate",
    "injected_late",
)

# The closed set of rejection categories.
INVALID_JSON = "invalid_json"
MISSING_FIELD = "missing_field"
INVALID_TYPE = "invalid_type"
INVALID_TIMESTAMP = "invalid_timestamp"
ERROR_CATEGORIES = (INVALID_JSON, MISSING_FIELD, INVALID_TYPE, INVALID_TIMESTAMP)

# Fixed values shared with readers of the dead-letter table.
PIPELINE_VERSION = "1.0.0"
SOURCE_TOPIC = "telemetry.raw"
DLQ_TOPIC = "telemetry.dlq"
HOT_TENANT = "tenant-hot"

LONG_MIN = -(2**63)
LONG_MAX = 2**63 - 1

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("producer_run_id", T.StringType()),
        T.StructField("producer_sequence", T.LongType()),
        T.StructField("produced_at", T.TimestampType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("firmware", T.StringType()),
        T.StructField("injected_duplicate", T.BooleanType()),
        T.StructField("injected_late", T.BooleanType()),
    ]
)

PARSED_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("event_time_ms", T.LongType())])

SINK_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("watermark_at_arrival", T.TimestampType()),
        T.StructField("is_late", T.BooleanType()),
        T.StructField("lateness_ms", T.LongType()),
    ]
)

# The stored table adds the writer-side clock and the month partition column.
TABLE_SCHEMA = T.StructType(
    [
        *SINK_SCHEMA.fields,
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("ym", T.StringType()),
    ]
)

TABLE_SORT_KEY = (
    "tenant_id",
    "metric_name",
    "event_time",
    "device_id",
    "event_id",
    "producer_run_id",
    "producer_sequence",
)

DLQ_FIELDS = (
    "raw_payload",
    "error_category",
    "error_detail",
    "source_topic",
    "pipeline_version",
    "failed_at",
)
DLQ_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in DLQ_FIELDS])

# One captured arrival: what a topic read delivers, plus the batch that read it.
ARRIVAL_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("service", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

PARSED_FIELDS = tuple(PARSED_SCHEMA.fieldNames())
SINK_FIELDS = tuple(SINK_SCHEMA.fieldNames())
