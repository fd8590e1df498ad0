"""The same queries as plain SQL over the given tables, for an independent check in DuckDB."""

_SENT = """
WITH sent AS (
    SELECT event_id, user_id, event_type, ts, value,
           event_id % 10 + 1 AS "stationId",
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(epoch_us(ts) // 1000 AS BIGINT) AS millis,
           event_id // 10 + 1 AS n
    FROM events
),
reading AS (
    SELECT event_id AS "offset", user_id, event_type, "stationId",
           CAST(n AS BIGINT) AS "sequenceNumber",
           CASE WHEN k < 30 THEN 'LOW' WHEN k < 70 THEN 'MID' ELSE 'HIGH' END AS "batteryStatus",
           millis AS "statusTimeStamp",
           CAST(event_id * 37 % 101 AS INTEGER) AS humidity,
           value AS temperature,
           CAST(event_id * 29 % 101 AS DOUBLE) AS "windSpeed"
    FROM sent
),
message AS (
    SELECT *, CAST("stationId" AS VARCHAR) AS key,
           '{"stationId":' || "stationId" || ',"sequenceNumber":' || "sequenceNumber"
           || ',"batteryStatus":"' || "batteryStatus" || '","statusTimeStamp":' || "statusTimeStamp"
           || ',"weatherStatus":{"humidity":' || humidity
           || ',"temperature":' || CAST(temperature AS VARCHAR)
           || ',"windSpeed":' || CAST("windSpeed" AS VARCHAR) || '}}' AS json
    FROM reading
),
document AS (
    SELECT "stationId" || '-' || "sequenceNumber" AS doc_id, "stationId" AS station_id,
           "sequenceNumber" AS s_no, "batteryStatus" AS battery_status,
           "statusTimeStamp" // 1000 AS status_timestamp, "statusTimeStamp" AS event_millis,
           humidity, temperature, "windSpeed" AS wind_speed, "offset", event_type
    FROM reading
)
"""

# The feed that the analyses of drops and gaps read has lost one number in ten.
_LOSSY = _SENT.replace("FROM sent\n)", "FROM sent WHERE n % 10 <> 3\n)")

_STATUS = '"stationId", "sequenceNumber", "batteryStatus", "statusTimeStamp", humidity, temperature, "windSpeed"'
_DOCUMENT = (
    "doc_id, station_id, s_no, battery_status, status_timestamp, event_millis, "
    "humidity, temperature, wind_speed"
)
_DATE = """strftime(make_timestamp("statusTimeStamp" * 1000), '%Y-%m-%d')"""

_BY_STATION = _LOSSY + """,
dropped AS (
    SELECT station_id, max(s_no) AS expected, count(DISTINCT s_no) AS received,
           max(s_no) - count(DISTINCT s_no) AS dropped,
           CAST(max(s_no) - count(DISTINCT s_no) AS DOUBLE) / max(s_no) AS drop_rate
    FROM document GROUP BY station_id
)
"""

_GAPS = _LOSSY + """,
stepped AS (
    SELECT station_id, s_no,
           lag(s_no, 1, 0) OVER (PARTITION BY station_id ORDER BY s_no) AS previous
    FROM document
),
gap AS (
    SELECT station_id, previous + 1 AS missing_from, s_no - 1 AS missing_to,
           s_no - previous - 1 AS missing
    FROM stepped WHERE s_no - previous - 1 > 0
)
"""

_PAYLOADS = """
WITH parsed AS (
    SELECT event_id AS payload_id, CAST(100 AS BIGINT) AS "stationId",
           date_trunc('minute', ts) AS minute,
           CAST(event_id * 37 % 101 AS INTEGER) AS humidity,
           value AS temperature
    FROM events WHERE event_type <> 'error'
)
"""

_LATEST_BY_USER = _SENT + """,
live AS (
    SELECT CAST(user_id AS VARCHAR) AS key, arg_max(json, "offset") AS value
    FROM message GROUP BY user_id
)
"""

_EPOCHS = _LOSSY + """,
restarted AS (
    SELECT station_id, "offset", CASE WHEN s_no > 400 THEN s_no - 400 ELSE s_no END AS s_no
    FROM document
),
marked AS (
    SELECT *, CASE WHEN s_no < lag(s_no) OVER (PARTITION BY station_id ORDER BY "offset")
                   THEN 1 ELSE 0 END AS reset
    FROM restarted
),
phased AS (
    SELECT *, CAST(sum(reset) OVER (PARTITION BY station_id ORDER BY "offset") AS BIGINT) AS epoch
    FROM marked
)
SELECT station_id, epoch, max(s_no) AS expected, count(DISTINCT s_no) AS received,
       max(s_no) - count(DISTINCT s_no) AS dropped,
       CAST(max(s_no) - count(DISTINCT s_no) AS DOUBLE) / max(s_no) AS drop_rate
FROM phased GROUP BY station_id, epoch"""

ORACLES: dict[str, str] = {
    "status_stream": _SENT + f'SELECT key, "offset", {_STATUS} FROM message',
    "json_roundtrip": _SENT + f'SELECT "offset", json, {_STATUS} FROM message',
    "archive_scan": _SENT
    + f'SELECT "stationId" AS station_id, {_DATE} AS date, {_STATUS} FROM reading',
    "incremental_ingest": _SENT + f"SELECT {_DOCUMENT} FROM document",
    "mixed_ingest": _SENT + """
SELECT doc_id, station_id, s_no, CASE WHEN event_type <> 'error' THEN battery_status END AS battery_status,
       status_timestamp, event_millis, CASE WHEN event_type <> 'error' THEN humidity END AS humidity,
       CASE WHEN event_type <> 'error' THEN temperature END AS temperature,
       CASE WHEN event_type <> 'error' THEN wind_speed END AS wind_speed
FROM document""",
    "file_timestamp": _SENT + """
SELECT CASE event_type
           WHEN 'error' THEN 'part-' || millis || '-' || event_id || '.parquet.tmp'
           WHEN 'view' THEN 'other-' || event_id || '.parquet'
           ELSE 'part-' || millis || '-' || event_id || '.parquet' END AS file_name,
       CASE WHEN event_type NOT IN ('error', 'view') THEN millis END AS file_millis
FROM sent""",
    "archive_write": _SENT + f"""
SELECT "stationId" AS station_id, {_DATE} AS date, count(*) AS records,
       CAST(sum("sequenceNumber") AS BIGINT) AS number_sum,
       CAST(sum(humidity) AS BIGINT) AS humidity_sum
FROM reading GROUP BY 1, 2""",
    "archive_stream": _SENT
    + f'SELECT "stationId" AS station_id, {_DATE} AS date, {_STATUS} FROM reading',
    "doc_upsert": _SENT + """
SELECT doc_id, station_id, s_no, battery_status, status_timestamp, event_millis, humidity,
       CASE WHEN event_type = 'click' THEN temperature + 1 ELSE temperature END AS temperature,
       wind_speed
FROM document""",
    "ensure_target": _SENT
    + "SELECT station_id, count(*) AS documents FROM document GROUP BY station_id",
    "snapshot_csv": _LATEST_BY_USER + """
SELECT key, CASE CAST(key AS INTEGER) % 5 WHEN 0 THEN '  a,' || key || '"b" '
                 WHEN 1 THEN key || chr(10) || ' second line' WHEN 2 THEN '' WHEN 3 THEN NULL
                 ELSE value END AS value
FROM live""",
    "publish_frame": _SENT + "SELECT key, json AS value FROM message",
    "rain_events": _SENT + 'SELECT key, "stationId", humidity FROM message WHERE humidity > 70',
    "rain_stream": _SENT + """
SELECT key, '{"stationId":' || "stationId" || ',"humidity":' || humidity || '}' AS value
FROM message WHERE humidity > 70""",
    "to_wire": _SENT + f"""
SELECT "offset", {_STATUS.replace('temperature', 'CAST(trunc(temperature) AS DOUBLE) AS temperature')}
FROM reading""",
    "openmeteo_to_status": _PAYLOADS + """
SELECT payload_id, "stationId", row_number() OVER (ORDER BY payload_id) AS "sequenceNumber",
       'NOT_AVAILABLE' AS "batteryStatus",
       CAST(epoch_us(minute) // 1000 AS BIGINT) AS "statusTimeStamp",
       humidity, temperature, CAST(12.5 AS DOUBLE) AS "windSpeed"
FROM parsed""",
    "assign_sequence": _PAYLOADS + """
SELECT "stationId", payload_id, strftime(minute, '%Y-%m-%dT%H:%M') AS time,
       row_number() OVER (ORDER BY minute, payload_id) AS "sequenceNumber"
FROM parsed""",
    "normalize_status": _SENT + f"SELECT {_DOCUMENT} FROM document",
    "required_fields": _SENT + """
SELECT "offset", CASE WHEN event_type <> 'error' THEN "stationId" END AS "stationId",
       CASE WHEN event_type <> 'view' THEN "sequenceNumber" END AS "sequenceNumber",
       event_type NOT IN ('error', 'view') AS kept
FROM reading""",
    "decode_battery": _SENT + 'SELECT "offset", "batteryStatus" AS battery_status FROM reading',
    "classify_battery": _SENT + """
SELECT event_id, CASE WHEN k / 100.0 < 0.3 THEN 'LOW' WHEN k / 100.0 < 0.7 THEN 'MID'
                      ELSE 'HIGH' END AS battery_status
FROM sent""",
    "latest_status": _SENT + """
SELECT key, arg_max(json, "offset") AS value, max("offset") AS "offset"
FROM message GROUP BY key""",
    "latest_status_stream": _SENT + """
SELECT key, arg_max(json, "offset") AS value, max("offset") AS "offset"
FROM message GROUP BY key""",
    "feed_rejects": _SENT + """
SELECT key, substr(json, 1, 20) AS text, "offset" FROM message WHERE event_type = 'error'""",
    "feed_rejects_landed": _SENT + """
SELECT CASE WHEN event_type = 'view' THEN key END AS key,
       CASE WHEN event_type = 'click' THEN json END AS text, "offset"
FROM message WHERE event_type IN ('click', 'view', 'error')""",
    "latest_of_texts": _SENT + """
SELECT key, arg_max(json, "offset") AS value, max("offset") AS "offset"
FROM message WHERE event_type <> 'error' GROUP BY key""",
    "latest_over_partitions": _SENT + """
SELECT key, json AS value, 1048576 - 300 + "offset" // 2 AS "offset",
       CAST("offset" % 2 AS INTEGER) AS partition, "offset" // 64 * 1000 AS millis
FROM message WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY key ORDER BY "offset" // 64 DESC, "offset" % 2 DESC, "offset" DESC) = 1""",
    "payload_stream": _PAYLOADS + """,
numbered AS (SELECT *, row_number() OVER (ORDER BY payload_id) AS n FROM parsed)
SELECT '100' AS key, '{"stationId":100,"sequenceNumber":' || n
       || ',"batteryStatus":"NOT_AVAILABLE","statusTimeStamp":' || CAST(epoch_us(minute) // 1000 AS BIGINT)
       || ',"weatherStatus":{"humidity":' || humidity || ',"temperature":' || CAST(temperature AS VARCHAR)
       || ',"windSpeed":12.5}}' AS value, n AS "offset"
FROM numbered QUALIFY n = max(n) OVER ()""",
    "payload_numbers": _PAYLOADS + """
SELECT "stationId", row_number() OVER (ORDER BY payload_id) AS "sequenceNumber",
       'NOT_AVAILABLE' AS "batteryStatus", CAST(epoch_us(minute) // 1000 AS BIGINT) AS "statusTimeStamp",
       humidity, temperature, CAST(12.5 AS DOUBLE) AS "windSpeed"
FROM parsed""",
    "get_status": _SENT + """,
live AS (SELECT key, arg_max(json, "offset") AS value FROM message GROUP BY key),
asked AS (SELECT DISTINCT CAST(user_id % 15 + 1 AS VARCHAR) AS key FROM events)
SELECT asked.key, live.value IS NOT NULL AS found, live.value
FROM asked LEFT JOIN live ON asked.key = live.key""",
    "get_one_status": _SENT + """
SELECT key, arg_max(json, "offset") AS value FROM message WHERE key = '3' GROUP BY key""",
    "view_all": _LATEST_BY_USER + "SELECT key, value FROM live",
    "compact_latest": _SENT + f"""
SELECT CAST(user_id AS VARCHAR) AS key, "offset", {_STATUS} FROM reading
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) = 1""",
    "overwrite_stats": _SENT + """,
stepped AS (
    SELECT key, 8 + strlen(key)
           + strlen(lag(json) OVER (PARTITION BY key ORDER BY "offset")) AS superseded
    FROM message
)
SELECT key, count(superseded) AS overwrites,
       CAST(coalesce(sum(superseded), 0) AS BIGINT) AS superseded_bytes
FROM stepped GROUP BY key""",
    "reconcile_snapshot": _LATEST_BY_USER + """,
seen AS (
    SELECT CAST(user_id AS VARCHAR) AS key, arg_max(json, "offset") AS value
    FROM message WHERE event_type <> 'error' GROUP BY user_id
)
SELECT count(*) AS total, count(*) FILTER (WHERE seen.key IS NULL) AS missing,
       count(*) FILTER (WHERE seen.value <> live.value) AS stale
FROM live LEFT JOIN seen ON live.key = seen.key""",
    "archive_manifest": _SENT + f"""
SELECT "stationId" AS station_id, {_DATE} AS date, count(*) AS records
FROM reading GROUP BY 1, 2""",
    "battery_distribution": _SENT + """
SELECT battery_status, count(*) AS readings,
       CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM document) AS share_pct
FROM document GROUP BY battery_status""",
    "dropped_per_station": _BY_STATION + "SELECT * FROM dropped",
    "dropped_per_epoch": _EPOCHS,
    "dropped_per_epoch_archive": _EPOCHS,
    "sequence_gaps": _GAPS + "SELECT * FROM gap",
    "gap_stream": _GAPS + "SELECT * FROM gap",
    "gaps_of_batches": _GAPS + "SELECT * FROM gap",
    "missing_numbers": _GAPS
    + "SELECT station_id, unnest(range(missing_from, missing_to + 1)) AS s_no FROM gap",
    "drop_rate_total": _BY_STATION + """
SELECT CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(received) AS BIGINT) AS received,
       CAST(sum(dropped) AS BIGINT) AS dropped,
       CAST(sum(dropped) AS DOUBLE) / sum(expected) AS drop_rate
FROM dropped""",
    "measurement_summary": """
SELECT event_type, count(*) AS count, round(avg(value), 6) AS mean,
       quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95,
       quantile_disc(value, 0.99) AS p99, max(value) AS max
FROM events GROUP BY event_type""",
    "sketched_summary": """
SELECT event_type, count(*) AS count, round(avg(value), 6) AS mean, max(value) AS max,
       TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within
FROM events GROUP BY event_type""",
    "rate_per_window": """
SELECT CAST(epoch_us(date_trunc('second', ts)) // 1000 AS BIGINT) AS window_start_millis,
       count(*) AS ops, CAST(count(*) AS DOUBLE) AS ops_per_sec,
       round(avg(value), 6) AS avg_value, max(value) AS max_value
FROM events GROUP BY 1""",
    "dedup_documents": _SENT + f"SELECT {_DOCUMENT} FROM document",
    "dedup_stream": _SENT + f"""
SELECT {_DOCUMENT} FROM document WHERE event_type <> 'error' OR event_millis >= 1705363200000""",
}
