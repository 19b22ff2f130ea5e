"""The event contract: category, detail and typed values of single records."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from tidemark.functions import contract
from tidemark.operators import dlq, validate
from tidemark.schema import ERROR_CATEGORIES, PARSED_FIELDS, REQUIRED_FIELDS

GOOD = {
    "schema_version": 1,
    "producer_run_id": "run-a7",
    "producer_sequence": 905,
    "produced_at": "2026-08-23T12:00:05.123Z",
    "event_id": "event-k31",
    "tenant_id": "tenant-9",
    "device_id": "device-0700",
    "metric_name": "flow_rate",
    "metric_value": 12.25,
    "event_time": "2026-08-23T12:00:00.000Z",
    "region": "coast",
    "firmware": "7.1.0",
    "injected_duplicate": False,
    "injected_late": True,
}

VERSION = "schema_version must be an integer from 1 through 65535"
SEQUENCE = "producer_sequence must be an integer from 0 through 9223372036854775807"
OBJECT = "top-level JSON value must be an object"
NUMERIC = "metric_value must be numeric"
FINITE = "metric_value must be finite"
OFFSET = "event_time must include a UTC offset or Z suffix"
RANGE = "event_time is outside ClickHouse DateTime64(3) range 1900-01-01 through 2299-12-31 UTC"
NOT_ISO = "event_time is not a valid ISO-8601 timestamp"


def changed(**values) -> str:
    return json.dumps({**GOOD, **values})


def token(name: str, literal: str) -> str:
    """A record in which one value is written as the given raw token."""
    return json.dumps({**GOOD, name: "@@"}).replace('"@@"', literal)


def without(*names: str, **values) -> str:
    return json.dumps({k: v for k, v in {**GOOD, **values}.items() if k not in names})


WHOLE = json.dumps(GOOD)
CASES = [
    (WHOLE, None, None),
    (f"  {WHOLE}\n", None, None),
    (changed(extra={"a": [1, 2]}), None, None),
    (token("metric_value", "7"), None, None),
    (token("metric_value", "1e3"), None, None),
    (changed(event_time="2026-08-23T17:30:00.000+05:30"), None, None),
    (changed(event_time="2026-08-23T12:00Z"), None, None),
    (changed(event_time="2026-08-23 12:00:00,5Z"), None, None),
    (changed(event_time="1900-01-01T00:00:00Z"), None, None),
    (changed(event_time="2299-12-31T23:59:59.999Z"), None, None),
    (changed(schema_version=65_535, producer_sequence=2**63 - 1), None, None),
    (WHOLE[:-1] + ', "schema_version": 2}', None, None),
    ('{"broken":', "invalid_json", "JSON decoding failed"),
    ("", "invalid_json", "JSON decoding failed"),
    (WHOLE[:-1], "invalid_json", "JSON decoding failed"),
    (WHOLE + "x", "invalid_json", "JSON decoding failed"),
    (WHOLE + "]", "invalid_json", "JSON decoding failed"),
    (WHOLE + "}", "invalid_json", "JSON decoding failed"),
    (WHOLE + "," + WHOLE, "invalid_json", "JSON decoding failed"),
    (WHOLE + WHOLE, "invalid_json", "JSON decoding failed"),
    (WHOLE + ',"z":2', "invalid_json", "JSON decoding failed"),
    (WHOLE + "],[" + WHOLE, "invalid_json", "JSON decoding failed"),
    (WHOLE.replace('"', "'"), "invalid_json", "JSON decoding failed"),
    ("[1]", "invalid_type", OBJECT),
    ("[NaN]", "invalid_type", OBJECT),
    (f"[{WHOLE}]", "invalid_type", OBJECT),
    ("5", "invalid_type", OBJECT),
    ('"s"', "invalid_type", OBJECT),
    ("null", "invalid_type", OBJECT),
    (without("event_id", "region"), "missing_field", "missing required field(s): event_id, region"),
    (without("event_id", schema_version=True), "missing_field", "missing required field(s): event_id"),
    (changed(schema_version=True), "invalid_type", VERSION),
    (changed(schema_version=0), "invalid_type", VERSION),
    (changed(schema_version=65_536), "invalid_type", VERSION),
    (changed(schema_version=1.0), "invalid_type", VERSION),
    (changed(schema_version="1"), "invalid_type", VERSION),
    (changed(schema_version=None), "invalid_type", VERSION),
    (token("schema_version", "NaN"), "invalid_type", VERSION),
    (changed(producer_sequence=True), "invalid_type", SEQUENCE),
    (changed(producer_sequence=-1), "invalid_type", SEQUENCE),
    (changed(producer_sequence=2**63), "invalid_type", SEQUENCE),
    (changed(metric_value=True), "invalid_type", NUMERIC),
    (changed(metric_value="1"), "invalid_type", NUMERIC),
    (changed(metric_value="NaN"), "invalid_type", NUMERIC),
    (changed(metric_value=None), "invalid_type", NUMERIC),
    (token("metric_value", "Infinity"), "invalid_type", FINITE),
    (token("metric_value", "-Infinity"), "invalid_type", FINITE),
    (token("metric_value", "NaN"), "invalid_type", FINITE),
    (token("metric_value", "1e400"), "invalid_type", FINITE),
    (changed(injected_duplicate="false"), "invalid_type", "injected_duplicate must be boolean"),
    (changed(injected_late=0), "invalid_type", "injected_late must be boolean"),
    (changed(producer_run_id=" "), "invalid_type", "producer_run_id must be a non-empty string"),
    (changed(tenant_id=" \t"), "invalid_type", "tenant_id must be a non-empty string"),
    (changed(region=5), "invalid_type", "region must be a non-empty string"),
    (changed(producer_run_id="", injected_duplicate="false"), "invalid_type", "injected_duplicate must be boolean"),
    (changed(event_time="2026-08-23T12:00:00.000"), "invalid_timestamp", OFFSET),
    (changed(event_time="2026-08-23"), "invalid_timestamp", OFFSET),
    (changed(event_time=5), "invalid_timestamp", "event_time must be an ISO-8601 string"),
    (changed(event_time="yesterday"), "invalid_timestamp", NOT_ISO),
    (changed(event_time="2026-02-30T00:00:00Z"), "invalid_timestamp", NOT_ISO),
    (changed(event_time="2026-08-23T12:00:00 UTC"), "invalid_timestamp", NOT_ISO),
    (changed(event_time="1899-12-31T23:59:59.999Z"), "invalid_timestamp", RANGE),
    (changed(event_time="2300-01-01T00:00:00.000Z"), "invalid_timestamp", RANGE),
    (changed(event_time="2299-12-31T23:59:59.9995Z"), "invalid_timestamp", RANGE),
    (changed(produced_at="x", event_id=""), "invalid_timestamp", NOT_ISO.replace("event_time", "produced_at")),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(CASES)], "i int, value string")
    return {r["i"]: r for r in validate.validate(rows).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_category_and_detail(verdicts, i):
    text, category, detail = CASES[i]
    error = verdicts[i]["error"]
    assert (error["category"] if error else None, error["detail"] if error else None) == (category, detail), text
    assert verdicts[i]["is_valid"] == (category is None)


def test_typed_values_of_a_valid_record(verdicts):
    row = verdicts[0]
    assert row["producer_sequence"] == 905
    assert row["metric_value"] == 12.25
    assert row["injected_late"] is True
    assert row["event_time"] == datetime(2026, 8, 23, 12, 0)
    assert row["event_time_ms"] == 1_787_486_400_000


def test_offset_gives_the_same_instant(verdicts):
    assert verdicts[5]["event_time_ms"] == verdicts[0]["event_time_ms"]


def test_repeated_key_keeps_the_last_value(verdicts):
    assert verdicts[11]["schema_version"] == 2


def test_all_missing_fields_are_listed_within_the_limit(spark):
    row = validate.validate(spark.createDataFrame([("{}",)], "value string")).first()
    expected = "missing required field(s): " + ", ".join(REQUIRED_FIELDS)
    assert row["error"]["category"] == "missing_field"
    assert row["error"]["detail"] == (expected if len(expected) <= 256 else expected[:253] + "...")


def test_split_keeps_every_record(spark, verdicts):
    rows = validate.validate(spark.createDataFrame([(t,) for t, _, _ in CASES], "value string"))
    valid, invalid = validate.valid_rows(rows), validate.invalid_rows(rows)
    assert valid.count() + invalid.count() == len(CASES)
    assert tuple(valid.columns) == PARSED_FIELDS
    counters = validate.validation_counters(rows).first().asDict()
    assert counters["records_seen"] == len(CASES)
    assert counters["records_valid"] == sum(1 for _, c, _ in CASES if c is None)
    assert counters["records_invalid"] == sum(v for k, v in counters.items() if k.startswith("invalid_"))


def test_the_filter_does_not_repeat_the_work(spark):
    rows = validate.valid_rows(validate.validate(spark.createDataFrame([(WHOLE,)], "value string")))
    # One reading for the JSON types and one for the values.
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json") == 2


def test_envelope_is_compact_and_ordered(spark):
    rejects = spark.createDataFrame(
        [('{"lab-data":"exact é value"}', "invalid_type", "wrong\ntype " + "x" * 300)],
        "raw_payload string, error_category string, error_detail string",
    )
    from pyspark.sql import functions as F

    at = F.lit("2026-08-23 12:00:00Z").cast("timestamp")
    text = dlq.encoded(dlq.envelopes(rejects, at)).first()["value"]
    detail = "wrong type " + "x" * 242 + "..."
    assert json.loads(text)["error_detail"] == detail
    assert text == (
        '{"raw_payload":"{\\"lab-data\\":\\"exact é value\\"}","error_category":"invalid_type","error_detail":"'
        + detail
        + '","source_topic":"telemetry.raw","pipeline_version":"1.0.0","failed_at":"2026-08-23T12:00:00.000Z"}'
    )


def test_unknown_category_is_refused():
    with pytest.raises(ValueError, match="unbounded error category"):
        contract.Rule("true", "event-id-123", "bad")
    assert {c for _, c, _ in CASES if c} == set(ERROR_CATEGORIES)


def test_every_field_is_checked_once():
    assert sorted(name for name, _ in contract.CHECK_ORDER) == sorted(REQUIRED_FIELDS)


@pytest.mark.parametrize(
    ("text", "instant"),
    [
        ("20260823T120000Z", "2026-08-23 12:00:00.000000"),
        ("2026-08-23T120000Z", "2026-08-23 12:00:00.000000"),
        ("2026-W34-7T12:00:00Z", "2026-08-23 12:00:00.000000"),
        ("2026W347T12Z", "2026-08-23 12:00:00.000000"),
        ("2026-08-23T12+00:00", "2026-08-23 12:00:00.000000"),
        ("2026-08-23x12:00:00Z", "2026-08-23 12:00:00.000000"),
        ("2026-08-23T12:00:00.1234567891Z", "2026-08-23 12:00:00.123456"),
        ("2026-08-24T06:30:00+18:30", "2026-08-23 12:00:00.000000"),
        ("2026-08-23T12:00:00+00:00:30.5", "2026-08-23 11:59:29.500000"),
        ("2026-02-30T12:00:00Z", None),
        ("2026-W54-1T12:00:00Z", None),
        ("2026-08-23T12:0000Z", None),
        ("2026-08-23T12:00:60Z", None),
        ("2026-08-23T12:00:00", None),
    ],
)
def test_iso_forms(spark, text, instant):
    shown = f"date_format({contract.instant('t')}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    assert spark.createDataFrame([(text,)], "t string").selectExpr(f"{shown} AS i").first()["i"] == instant
