"""The derived datasets of ``datasets.py`` stated as SQL, for checking results in another engine."""

from __future__ import annotations

from tidemark.plans.datasets import FIRMWARES, JOBS, REGIONS, SERVICES


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def iso(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"


def at(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def mix(n: str, salt: int) -> str:
    """The integer mixing of ``functions.numbers.mix``."""
    p = 2_147_483_647
    seed = f"((({n}) + {salt * 7_919}) % {p})"
    first = f"(({seed} * 48271 + {salt + 1}) % {p})"
    return f"((xor({first}, {first} >> 15) * 69621 + 12345) % {p})"


BASE = f"""
base AS (
  SELECT event_id AS eid, user_id, epoch_us(ts) // 1000 AS ems,
    (event_id * 17) % 100 < 10 AS late, event_id % 20 = 0 AS has_dup, event_id % 200 = 7 AS bad,
    CASE WHEN (event_id * 31) % 100 < 80 THEN 'tenant-hot'
         ELSE 'tenant-' || lpad(CAST(1 + user_id % 20 AS VARCHAR), 3, '0') END AS tenant_id,
    CASE WHEN (event_id * 31) % 100 < 80 THEN 0 ELSE CAST(1 + user_id % 5 AS INTEGER) END AS src_partition,
    'device-' || lpad(CAST(1 + user_id % 2000 AS VARCHAR), 4, '0') AS device_id,
    event_type AS metric_name, CAST(value AS DECIMAL(18,3)) AS metric_value,
    {sql_list(REGIONS)}[(event_id * 7) % 3 + 1] AS region,
    {sql_list(FIRMWARES)}[event_id % 3 + 1] AS firmware
  FROM events
)"""

SENDS = """
sends AS (
  SELECT b.*, c.copy, 2 * eid + c.copy AS producer_sequence, 'run-' || eid % 4 AS producer_run_id,
    'event-' || eid AS event_id,
    ems + CASE WHEN late THEN 15000 + 1000 * ((eid * 13) % 286) ELSE eid % 2000 END + c.copy AS pms,
    ems - CASE WHEN late THEN 1000 * (600 + (eid * 13) % 3600) ELSE 0 END AS vms
  FROM base b JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR b.has_dup
)"""

RAW = f"""
whole AS (
  SELECT *, '{{"device_id":"' || device_id || '","event_id":"' || event_id
    || '","event_time":"' || {iso("vms")} || '","firmware":"' || firmware
    || '","injected_duplicate":' || CASE WHEN copy = 1 THEN 'true' ELSE 'false' END
    || ',"injected_late":' || CASE WHEN late THEN 'true' ELSE 'false' END
    || ',"metric_name":"' || metric_name
    || '","metric_value":' || CASE WHEN copy = 0 AND eid % 500 = 3 THEN 'true' ELSE CAST(metric_value AS VARCHAR) END
    || ',"produced_at":"' || CASE WHEN copy = 0 AND eid % 500 = 13 THEN rtrim({iso("pms")}, 'Z') ELSE {iso("pms")} END
    || '","producer_run_id":"' || producer_run_id
    || '","producer_sequence":' || producer_sequence
    || CASE WHEN copy = 0 AND eid % 500 = 11 THEN '' ELSE ',"region":"' || region || '"' END
    || ',"schema_version":1,"tenant_id":"' || tenant_id || '"}}' AS text
  FROM sends
),
raw AS (
  SELECT eid, copy, producer_sequence AS arrival, pms AS sent_ms, tenant_id AS key,
    CASE WHEN copy = 0 AND bad THEN left(text, length(text) - 1) ELSE text END AS value,
    src_partition, eid - eid % 8 AS batch_id, (eid // 8) * 10000 AS batch_ms
  FROM whole
)"""

ARRIVALS = """
arrivals AS (
  SELECT *, row_number() OVER (PARTITION BY src_partition ORDER BY arrival) - 1 AS "offset" FROM raw
)"""

# The contract restated with another JSON reader; it covers the defects the raw data can have.
JUDGED = r"""
judged AS (
  SELECT *, CASE
      WHEN NOT json_valid(value) THEN 'invalid_json'
      WHEN json_extract(value, '$.region') IS NULL THEN 'missing_field'
      WHEN json_type(value, '$.metric_value') NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN 'invalid_type'
      WHEN NOT regexp_matches(json_extract_string(value, '$.produced_at'), '(Z|[+-]\d\d:?\d\d)$')
        THEN 'invalid_timestamp'
    END AS error_category
  FROM raw
),
typed AS (
  SELECT eid, copy, arrival, batch_id, batch_ms, src_partition,
    CAST(json_extract_string(value, '$.schema_version') AS INTEGER) AS schema_version,
    json_extract_string(value, '$.producer_run_id') AS producer_run_id,
    CAST(json_extract_string(value, '$.producer_sequence') AS BIGINT) AS producer_sequence,
    CAST(rtrim(json_extract_string(value, '$.produced_at'), 'Z') AS TIMESTAMP) AS produced_at,
    json_extract_string(value, '$.event_id') AS event_id,
    json_extract_string(value, '$.tenant_id') AS tenant_id,
    json_extract_string(value, '$.device_id') AS device_id,
    json_extract_string(value, '$.metric_name') AS metric_name,
    CAST(json_extract_string(value, '$.metric_value') AS DOUBLE) AS metric_value,
    CAST(rtrim(json_extract_string(value, '$.event_time'), 'Z') AS TIMESTAMP) AS event_time,
    json_extract_string(value, '$.region') AS region,
    json_extract_string(value, '$.firmware') AS firmware,
    json_extract_string(value, '$.injected_duplicate') = 'true' AS injected_duplicate,
    json_extract_string(value, '$.injected_late') = 'true' AS injected_late
  FROM judged WHERE error_category IS NULL
),
rejects AS (
  SELECT eid, copy, arrival, src_partition, value AS raw_payload, error_category,
    CASE error_category
      WHEN 'invalid_json' THEN 'JSON decoding failed'
      WHEN 'missing_field' THEN 'missing required field(s): region'
      WHEN 'invalid_type' THEN 'metric_value must be numeric'
      ELSE 'produced_at must include a UTC offset or Z suffix' END AS error_detail
  FROM judged WHERE error_category IS NOT NULL
)"""

# The watermark definition on a full batch-by-partition grid.
WATERMARKS = """
offered AS (
  SELECT j.batch_id, j.batch_ms, j.src_partition,
    CASE WHEN j.error_category IS NULL
      THEN epoch_us(CAST(rtrim(json_extract_string(j.value, '$.event_time'), 'Z') AS TIMESTAMP)) // 1000
      ELSE 0 END AS event_ms
  FROM judged j
),
cells AS (SELECT batch_id, src_partition, max(event_ms) AS mx, max(batch_ms) AS batch_ms FROM offered GROUP BY ALL),
steps AS (SELECT batch_id, max(batch_ms) AS batch_ms FROM cells GROUP BY batch_id),
grid AS (
  SELECT s.batch_id, s.batch_ms, p.src_partition, c.mx, c.batch_ms AS seen
  FROM steps s CROSS JOIN (SELECT DISTINCT src_partition FROM cells) p
  LEFT JOIN cells c ON c.batch_id = s.batch_id AND c.src_partition = p.src_partition
),
carried AS (
  SELECT batch_id, batch_ms,
    max(mx) OVER w AS pm, max(seen) OVER w AS ls
  FROM grid
  WINDOW w AS (PARTITION BY src_partition ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
lows AS (
  SELECT batch_id, max(batch_ms) AS batch_ms, min(CASE WHEN batch_ms - ls <= 30000 THEN pm END) - 10000 AS w0
  FROM carried GROUP BY batch_id
),
marks AS (
  SELECT batch_id, batch_ms, max(w0) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS watermark_ms FROM lows
)"""

# The watermark each row meets: six source partitions, each with what it has delivered before the row.
_OFFERS = ", ".join(
    f"CASE WHEN batch_ms - max(batch_ms) FILTER (src_partition = {p}) OVER w <= 30000"
    f" THEN max(event_ms) FILTER (src_partition = {p}) OVER w END"
    for p in range(6)
)
ROW_MARKS = f"""
row_lows AS (
  SELECT arrival, src_partition, event_ms, list_min([{_OFFERS}]) - 10000 AS low
  FROM (SELECT j.arrival, j.batch_ms, j.src_partition,
          CASE WHEN j.error_category IS NULL
            THEN epoch_us(CAST(rtrim(json_extract_string(j.value, '$.event_time'), 'Z') AS TIMESTAMP)) // 1000
            ELSE 0 END AS event_ms FROM judged j) o
  WINDOW w AS (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
row_marks AS (
  SELECT arrival, src_partition, event_ms, max(low) OVER (ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS watermark_ms FROM row_lows
)"""

# What a first batch takes of each source partition when a third of all offsets is admitted.
ADMITTED = """
parts AS (SELECT src_partition, min(arrival) AS first, max(arrival) + 1 AS past FROM raw GROUP BY 1),
quota AS (SELECT sum(past) // 3 + 1 AS lim, sum(past - first) AS waiting FROM parts),
taken AS (
  SELECT src_partition, past, first + CASE WHEN waiting <= lim THEN past - first
      ELSE least(past - first, greatest(1, lim * (past - first) // waiting)) END AS done
  FROM parts, quota
)"""

OBSERVED = f"""
observed AS (
  SELECT t.*, {at("s.pms + 50 + s.eid % 400")} AS processed_at, {at("m.watermark_ms")} AS watermark_at_arrival,
    coalesce(epoch_us(t.event_time) // 1000 <= m.watermark_ms, false) AS is_late,
    CAST(greatest(0, coalesce(m.watermark_ms - epoch_us(t.event_time) // 1000, 0)) AS BIGINT) AS lateness_ms
  FROM typed t JOIN sends s ON s.producer_sequence = t.producer_sequence JOIN marks m ON m.batch_id = t.batch_id
)"""

TELEMETRY = f"""
stored AS (
  SELECT s.*, pms + 50 + eid % 400 AS processed_ms, pms + 70 + eid % 400 + eid % 900 + 1000 * r.replay AS ingested_ms,
    CASE WHEN eid >= 8 THEN ems + CASE WHEN late THEN ((eid * 29) % 100 - 20) * 1500
                                       ELSE ((eid * 29) % 100 - 97) * 1500 END END AS watermark_ms
  FROM sends s JOIN (VALUES (0), (1)) r(replay) ON r.replay = 0 OR s.eid % 997 = 5
),
telemetry AS (
  SELECT 1 AS schema_version, producer_run_id, producer_sequence, {at("pms")} AS produced_at, event_id, tenant_id,
    device_id, metric_name, CAST(metric_value AS DOUBLE) AS metric_value, {at("ems")} AS event_time, region, firmware,
    copy = 1 AS injected_duplicate, late AS injected_late, {at("processed_ms")} AS processed_at,
    {at("watermark_ms")} AS watermark_at_arrival, coalesce(ems <= watermark_ms, false) AS is_late,
    CAST(greatest(0, coalesce(watermark_ms - ems, 0)) AS BIGINT) AS lateness_ms,
    {at("ingested_ms")} AS ingested_at, strftime({at("ems")}, '%Y%m') AS ym
  FROM stored
)"""

DELIVERY = """
attempts AS (
  SELECT 'run-' || eid % 4 AS run_id, arrival AS producer_sequence, 'event-' || eid AS event_id,
    CAST(octet_length(encode(value)) AS BIGINT) AS payload_bytes, sent_ms AS enqueued_ms
  FROM raw
),
callbacks AS (
  SELECT producer_run_id AS run_id, producer_sequence, producer_sequence % 101 = 0 AS failed,
    CASE WHEN producer_sequence % 101 <> 0 THEN src_partition END AS "partition",
    CASE WHEN producer_sequence % 101 <> 0 THEN producer_sequence END AS "offset",
    CASE WHEN producer_sequence % 101 <> 0 THEN pms + 1 + (eid * 7) % 40 END AS acked_ms,
    eid % 13 AS tx_retries
  FROM sends WHERE producer_sequence % 97 <> 0
),
flushes AS (
  SELECT run_id, max(enqueued_ms) - CASE run_id WHEN 'run-3' THEN 86400000 ELSE 0 END AS flushed_ms
  FROM attempts WHERE run_id <> 'run-2' GROUP BY 1
),
delivery AS (
  SELECT a.*, c."partition", c."offset", c.acked_ms,
    CASE WHEN c.failed THEN 'failed' WHEN NOT c.failed THEN 'acked'
      WHEN a.enqueued_ms <= f.flushed_ms THEN 'undelivered' ELSE 'pending' END AS status,
    CASE WHEN c.acked_ms IS NOT NULL THEN greatest(0, c.acked_ms - a.enqueued_ms) END AS latency_ms,
    CAST(coalesce(c.tx_retries, 0) AS BIGINT) AS tx_retries
  FROM attempts a LEFT JOIN callbacks c USING (run_id, producer_sequence) LEFT JOIN flushes f USING (run_id)
)"""

METRICS = f"""
named AS (
  SELECT *, CAST(floor(value) AS BIGINT) AS whole,
    CASE event_type WHEN 'click' THEN 'pipeline_records_valid_total' WHEN 'view' THEN 'pipeline_keyed_records_total'
      WHEN 'signup' THEN 'pipeline_source_pending_records'
      WHEN 'error' THEN ['up', 'pipeline_input_watermark_ms', 'pipeline_hot_tenant_state_count'][user_id % 3 + 1]
      ELSE ['pipeline_shuffle_local_bytes_per_second', 'pipeline_shuffle_remote_bytes_per_second'][user_id % 2 + 1] END AS name,
    CASE WHEN event_type = 'view' AND user_id % 10 < 7 THEN 2 ELSE user_id % 4 END AS shard
  FROM events
),
counted AS (SELECT *, CAST(sum(whole) OVER (PARTITION BY name, shard ORDER BY ts, event_id) AS BIGINT) AS total FROM named),
samples AS (
  SELECT event_id, ts, name, CASE WHEN name <> 'up' THEN shard END AS subtask,
    CASE WHEN name = 'up' THEN {sql_list(JOBS)}[(user_id // 3) % 4 + 1] ELSE 'stream-executor' END AS job,
    CASE WHEN event_type = 'click' AND whole = 13 THEN 'j' || user_id % 7 END AS runtime_id,
    CAST(CASE name WHEN 'pipeline_records_valid_total' THEN total % 5000 WHEN 'pipeline_keyed_records_total' THEN total
      WHEN 'pipeline_source_pending_records' THEN CASE WHEN user_id % 50 = 7 THEN CAST('NaN' AS DOUBLE) ELSE value END
      WHEN 'up' THEN CASE WHEN value > 60 THEN 0 ELSE 1 END
      WHEN 'pipeline_input_watermark_ms' THEN epoch_us(ts) // 1000 - 100 * whole
      WHEN 'pipeline_hot_tenant_state_count' THEN CASE WHEN shard = 2 THEN whole ELSE 0 END
      WHEN 'pipeline_shuffle_local_bytes_per_second' THEN whole
      ELSE CASE WHEN value > 300 THEN whole ELSE 0 END END AS DOUBLE) AS value
  FROM counted
),
series AS (
  SELECT *, concat_ws(',', 'job=' || job, 'job_id=' || runtime_id, 'subtask_index=' || subtask) AS labels_key FROM samples
)"""

LOGS = f"""
lines AS (
  SELECT eid, {sql_list(SERVICES)}[eid % 3 + 1] AS service, {iso("ems")} AS stamp, ['INFO', 'INFO', 'WARNING', 'ERROR'][(eid // 3) % 4 + 1] AS lvl
  FROM base
),
log_lines AS (
  SELECT eid, service, CASE
    WHEN eid % 10 = 0 THEN '{{"timestamp":"' || stamp || '","level":"' || lvl || '","event":"producer_final","producer_run_id":"run-' || eid % 4
      || '","attempted":' || eid * 2 || ',"acked":' || eid * 2 - CASE WHEN eid % 3 = 0 THEN 1 ELSE 0 END
      || ',"failed":' || CASE WHEN eid % 3 = 0 THEN '1' ELSE '0' END || ',"undelivered":0,"reconciled":true}}'
    WHEN eid % 10 IN (1, 2, 3) THEN '{{"timestamp":"' || stamp || '","level":"' || lvl
      || '","component":"stream-job","message":"invalid_record_routed_to_dlq","error_category":"invalid_json","raw_payload_length":' || 100 + eid % 200 || '}}'
    WHEN eid % 10 IN (4, 5) THEN '{{"timestamp":"' || stamp || '","level":"' || lvl
      || '","component":"stream-job","message":"keyed_state_milestone","tenant_id":"tenant-hot","tenant_record_count":' || eid || '}}'
    WHEN eid % 10 = 6 THEN 'Savepoint completed. Path: file:///ckpt/' || eid % 11 || '; Savepoint completed. Path: file:///ckpt/sp-' || eid || '.'
    WHEN eid % 10 = 7 THEN 'plain text line ' || eid
    WHEN eid % 10 = 8 AND eid % 3 < 2 THEN '{{"timestamp":"' || stamp || '","level":"' || lvl || '","component":"stream-job","message":"'
      || CASE eid % 3 WHEN 0 THEN 'said ' || chr(92) || '"stop' || chr(92) || '"' ELSE 'caf' || chr(92) || 'u00e9 open' END || '"}}'
    ELSE '{{"timestamp":"' || stamp || '","level":"' || lvl || '","component":"stream-job","message":"job_starting"}}' END AS raw
  FROM lines
),
log_docs AS (SELECT *, json_extract_string(raw, '$.level') AS level, json_extract_string(raw, '$.component') AS component FROM log_lines WHERE json_valid(raw))"""

STATISTICS = """
statistics AS (
  SELECT 'run-' || eid % 4 AS run_id, eid, user_id, v, CASE user_id % 6
    WHEN 0 THEN '{"txretries":' || v || '}'
    WHEN 1 THEN '{"brokers":{"a":{"txretries":' || v || '},"b":{"txretries":' || v % 7 || '}}}'
    WHEN 2 THEN '{"txretries":true,"brokers":{"a":{"txretries":' || v || '},"b":7}}'
    WHEN 3 THEN '{"txretries":-' || 1 + v || '}'
    WHEN 4 THEN '{"brokers":{"a":{"txretries":-2},"b":{"txretries":' || v || '},"c":{}}}'
    ELSE '{"brokers":[1,2]}' END AS statistics
  FROM (SELECT *, CAST(floor(metric_value) AS BIGINT) AS v FROM base) b
)"""


def query(select: str, *parts: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n" + select.strip()


def over_telemetry(select: str) -> str:
    return query(select, BASE, SENDS, TELEMETRY)


def over_raw(select: str) -> str:
    return query(select, BASE, SENDS, RAW)


def over_arrivals(select: str) -> str:
    return query(select, BASE, SENDS, RAW, ARRIVALS)


def over_judged(select: str) -> str:
    return query(select, BASE, SENDS, RAW, JUDGED)


def over_marks(select: str) -> str:
    return query(select, BASE, SENDS, RAW, JUDGED, WATERMARKS)


def over_row_marks(select: str) -> str:
    return query(select, BASE, SENDS, RAW, JUDGED, ROW_MARKS)


def over_admitted(select: str) -> str:
    return query(select, BASE, SENDS, RAW, JUDGED, ADMITTED)


def over_observed(select: str) -> str:
    return query(select, BASE, SENDS, RAW, JUDGED, WATERMARKS, OBSERVED)


def over_delivery(select: str) -> str:
    return query(select, BASE, SENDS, RAW, DELIVERY)


def over_metrics(select: str) -> str:
    return query(select, METRICS)


def over_logs(select: str) -> str:
    return query(select, BASE, LOGS)
