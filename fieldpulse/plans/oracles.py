"""The catalog's queries as ANSI SQL over the same tables, written on their own."""

from __future__ import annotations

READINGS = """
SELECT 'dev-' || user_id AS device_id, event_type AS metric_type, value, ts AS recorded_at,
       ts + to_seconds((event_id * 37) % 120) AS ingested_at, 'evt-' || event_id AS idempotency_key,
       event_id * 2 AS delivery_seq, event_id
FROM events"""

DELIVERIES = """
SELECT device_id, metric_type, value, recorded_at, ingested_at, idempotency_key, delivery_seq, event_id
FROM readings
UNION ALL
SELECT device_id, metric_type, value + 1000, recorded_at, ingested_at + to_seconds(30), idempotency_key,
       delivery_seq + 1, event_id
FROM readings WHERE event_id % 20 = 0"""

STRAY = """
SELECT CASE event_id % 7 WHEN 0 THEN 'devices/' || device_id || '/a/readings'
                         WHEN 1 THEN 'devices/' || device_id || '/status'
                         WHEN 2 THEN device_id
                         WHEN 3 THEN 'devices//readings'
                         ELSE 'devices/' || device_id || '/readings' END AS topic,
       CASE event_id % 7 WHEN 2 THEN NULL WHEN 3 THEN '' ELSE device_id END AS level,
       ingested_at, delivery_seq, event_id
FROM deliveries"""

FAULTY = r"""
SELECT device_id,
       CASE event_id % 11 WHEN 0 THEN chr(9) || ' ' WHEN 1 THEN repeat('m', 33) WHEN 2 THEN repeat(' ', 33)
                          WHEN 3 THEN repeat('m', 32) ELSE metric_type END AS metric_type,
       CASE WHEN event_id % 13 <> 0 THEN value END AS value,
       CASE WHEN event_id % 17 <> 0 THEN recorded_at END AS recorded_at,
       ingested_at,
       CASE event_id % 19 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE idempotency_key END AS idempotency_key,
       delivery_seq, event_id
FROM deliveries"""

VIOLATIONS = r"""
SELECT delivery_seq AS row_key, 'metricType' AS field, 'must not be blank' AS message FROM faulty
WHERE metric_type IS NULL OR regexp_full_match(metric_type, '[\x00-\x20]*')
UNION ALL
SELECT delivery_seq, 'metricType', 'size must be between 0 and 32' FROM faulty WHERE length(metric_type) > 32
UNION ALL
SELECT delivery_seq, 'value', 'must not be null' FROM faulty WHERE value IS NULL
UNION ALL
SELECT delivery_seq, 'idempotencyKey', 'must not be blank' FROM faulty
WHERE idempotency_key IS NULL OR regexp_full_match(idempotency_key, '[\x00-\x20]*')"""

KNOWN = "SELECT 'dev-' || c_custkey AS id FROM customer WHERE c_custkey % 10 <> 3"

DEVICE_REQUESTS = """
SELECT 'dev-' || c_custkey AS id,
       CASE WHEN again = 1 THEN 'again' ELSE c_name END AS device_name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'GATEWAY' WHEN 'AUTOMOBILE' THEN 'CAMERA'
                         WHEN 'MACHINERY' THEN 'SENSOR' WHEN 'FURNITURE' THEN 'EDGE_NODE'
                         ELSE c_mktsegment END AS device_type,
       n_name AS site,
       CAST((c_custkey * 7) % 200 - 100 AS DOUBLE) AS latitude,
       CAST((c_custkey * 13) % 360 - 180 AS DOUBLE) AS longitude,
       TIMESTAMP '2024-01-01 00:00:00' AS received_at,
       c_custkey * 2 + again AS seq, c_custkey, again
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT 0 AS again UNION ALL SELECT 1) AS copies ON again = 0 OR c_custkey % 8 = 0"""

DEVICES = """
SELECT id, device_name, device_type, site, latitude, longitude,
       TIMESTAMP '2023-12-01 00:00:00' AS created_at, TIMESTAMP '2023-12-01 00:00:00' AS updated_at
FROM device_requests WHERE again = 0 AND c_custkey % 10 <> 3"""

DEVICE_VIOLATIONS = """
SELECT seq AS row_key, 'deviceType' AS field,
       'must be one of CAMERA, GATEWAY, SENSOR, EDGE_NODE' AS message
FROM device_requests WHERE device_type NOT IN ('CAMERA', 'GATEWAY', 'SENSOR', 'EDGE_NODE')
UNION ALL
SELECT seq, 'latitude', 'must be greater than or equal to -90.0' FROM device_requests WHERE latitude < -90
UNION ALL
SELECT seq, 'latitude', 'must be less than or equal to 90.0' FROM device_requests WHERE latitude > 90
UNION ALL
SELECT seq, 'longitude', 'must be greater than or equal to -180.0' FROM device_requests
WHERE longitude < -180
UNION ALL
SELECT seq, 'longitude', 'must be less than or equal to 180.0' FROM device_requests WHERE longitude > 180"""

GATEWAYS = "SELECT * FROM devices WHERE device_type = 'GATEWAY'"

REGISTRATIONS = """
SELECT r.*, CASE WHEN r.seq IN (SELECT row_key FROM device_violations) THEN 'INVALID'
                 WHEN r.id IN (SELECT id FROM gateways) THEN 'DEVICE_ALREADY_EXISTS'
                 WHEN row_number() OVER (PARTITION BY r.id, r.seq IN (SELECT row_key FROM device_violations)
                                         ORDER BY r.seq) > 1 THEN 'DEVICE_ALREADY_EXISTS'
                 ELSE 'REGISTERED' END AS outcome
FROM device_requests r"""

REGISTERED = """
SELECT id, device_name, device_type, site, latitude, longitude, created_at, updated_at FROM gateways
UNION ALL
SELECT id, device_name, device_type, site, latitude, longitude, TIMESTAMP '{at}', TIMESTAMP '{at}'
FROM registrations WHERE outcome = 'REGISTERED'"""

PATCHES = """
SELECT 'dev-' || c_custkey AS id,
       CASE (c_custkey + nth) % 7 WHEN 0 THEN 'name-' || nth WHEN 1 THEN '   ' WHEN 2 THEN repeat('n', 129)
                                  WHEN 3 THEN 'both-' || nth END AS device_name,
       CASE (c_custkey + nth) % 7 WHEN 3 THEN 'CAMERA' WHEN 4 THEN 'SENSOR' WHEN 5 THEN 'TOASTER' END
         AS device_type,
       c_custkey * 3 + nth AS seq
FROM customer JOIN (SELECT 0 AS nth UNION ALL SELECT 1 UNION ALL SELECT 2) AS n
  ON nth = 0 OR c_custkey % 4 = 0"""

PATCH_ERRORS = """
SELECT id, seq, device_name, device_type,
       CASE WHEN length(device_name) > 128 OR device_type = 'TOASTER' THEN 'INVALID'
            WHEN device_name IS NULL AND device_type IS NULL THEN 'NO_FIELDS_TO_UPDATE'
            WHEN id NOT IN (SELECT id FROM {devices}) THEN 'DEVICE_NOT_FOUND'
            WHEN trim(device_name) = '' THEN 'DEVICE_NAME_CANNOT_BE_BLANK' END AS error
FROM patches"""

PATCHED = """
SELECT d.id, coalesce(n.device_name, d.device_name) AS device_name,
       coalesce(t.device_type, d.device_type) AS device_type, d.site, d.latitude, d.longitude, d.created_at,
       CASE WHEN n.id IS NOT NULL OR t.id IS NOT NULL THEN TIMESTAMP '2024-02-02 00:00:00'
            ELSE d.updated_at END AS updated_at
FROM {devices} d
LEFT JOIN (SELECT id, device_name FROM patch_errors WHERE error IS NULL AND device_name IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1) n ON n.id = d.id
LEFT JOIN (SELECT id, device_type FROM patch_errors WHERE error IS NULL AND device_type IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1) t ON t.id = d.id"""

DELETES = """
SELECT 'dev-' || c_custkey AS id, c_custkey * 2 + nth AS seq
FROM customer JOIN (SELECT 0 AS nth UNION ALL SELECT 1) AS n ON nth = 0 OR c_custkey % 6 = 0"""

DELETIONS = """
SELECT id, seq, CASE WHEN id NOT IN (SELECT id FROM devices) THEN 'DEVICE_NOT_FOUND'
                     WHEN id IN (SELECT device_id FROM readings)
                       THEN 'DEVICE_HAS_READINGS'
                     WHEN row_number() OVER (PARTITION BY id ORDER BY seq) = 1 THEN 'DELETED'
                     ELSE 'DEVICE_NOT_FOUND' END AS outcome
FROM deletes"""

DEVICE_CHANGES = """
SELECT CASE WHEN k < 2 THEN 'REGISTER' WHEN k < 4 THEN 'PATCH' ELSE 'DELETE' END AS kind, 'dev-' || c_custkey AS id,
       CASE WHEN (c_custkey + nth) % 11 <> 0 THEN 'name-' || nth END AS device_name,
       CASE WHEN (c_custkey + nth) % 13 <> 0 THEN CASE WHEN k = 3 THEN 'CAMERA' WHEN k < 3 THEN 'SENSOR' END END AS device_type,
       'site' AS site, 1.5::DOUBLE AS latitude, nth::DOUBLE AS longitude,
       TIMESTAMP '2024-03-01 00:00:00' + to_seconds((c_custkey * 13 + nth * 29) % 60) AS received_at, c_custkey * 8 + nth AS seq
FROM (SELECT c_custkey, nth, (c_custkey + nth * 5 + c_custkey // 7) % 5 AS k FROM customer, range(8) AS n(nth))"""

CHANGE_OUTCOMES = """
SELECT *, CASE kind WHEN 'REGISTER' THEN CASE WHEN bad THEN 'INVALID' WHEN there THEN 'DEVICE_ALREADY_EXISTS' ELSE 'REGISTERED' END
               WHEN 'PATCH' THEN CASE WHEN device_name IS NULL AND device_type IS NULL THEN 'NO_FIELDS_TO_UPDATE'
                                      WHEN NOT there THEN 'DEVICE_NOT_FOUND' ELSE 'UPDATED' END
               ELSE CASE WHEN NOT there THEN 'DEVICE_NOT_FOUND' WHEN used THEN 'DEVICE_HAS_READINGS' ELSE 'DELETED' END END AS outcome
FROM (SELECT *, coalesce(last_value(makes IGNORE NULLS) OVER (PARTITION BY id ORDER BY received_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         id IN (SELECT id FROM devices)) AS there
      FROM (SELECT *, CASE WHEN kind = 'REGISTER' AND NOT bad THEN TRUE WHEN kind = 'DELETE' AND NOT used THEN FALSE END AS makes
            FROM (SELECT *, device_name IS NULL OR device_type IS NULL AS bad,
                         id IN (SELECT device_id FROM readings WHERE event_id % 50 = 0) AS used FROM device_changes)))"""

CHANGED = """
SELECT d.id, last_value(e.device_name IGNORE NULLS) OVER w AS device_name, last_value(e.device_type IGNORE NULLS) OVER w AS device_type,
       last_value(e.site IGNORE NULLS) OVER w AS site, last_value(e.latitude IGNORE NULLS) OVER w AS latitude,
       last_value(e.longitude IGNORE NULLS) OVER w AS longitude,
       last_value(e.created_at IGNORE NULLS) OVER w AS created_at, last_value(e.updated_at IGNORE NULLS) OVER w AS updated_at
FROM (SELECT id, max(CASE WHEN outcome = 'REGISTERED' THEN moment END) AS made, max(CASE WHEN outcome = 'DELETED' THEN moment END) AS removed
      FROM change_events GROUP BY id) d
JOIN change_events e ON e.id = d.id AND (made IS NULL OR e.moment >= made) AND outcome IN ('HELD', 'REGISTERED', 'UPDATED')
WHERE (removed IS NULL OR removed < made)
WINDOW w AS (PARTITION BY d.id ORDER BY e.moment ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
QUALIFY row_number() OVER (PARTITION BY d.id ORDER BY e.moment) = 1"""

CHANGE_EVENTS = """
SELECT id, device_name, device_type, site, latitude, longitude, created_at, updated_at, 'HELD' AS outcome, TIMESTAMP '2000-01-01' AS moment FROM devices
UNION ALL
SELECT id, device_name, device_type, CASE WHEN outcome = 'REGISTERED' THEN site END, CASE WHEN outcome = 'REGISTERED' THEN latitude END,
       CASE WHEN outcome = 'REGISTERED' THEN longitude END, CASE WHEN outcome = 'REGISTERED' THEN TIMESTAMP '2024-02-02 00:00:00' END,
       TIMESTAMP '2024-02-02 00:00:00', outcome, received_at + to_microseconds(seq % 8) AS moment
FROM change_outcomes WHERE outcome IN ('REGISTERED', 'UPDATED', 'DELETED')"""

LATE_KNOWN = """
SELECT 'dev-' || c_custkey AS id, TIMESTAMP '2024-01-02 00:00:00' + to_seconds(least((c_custkey * 7919) % 2000000,
           CASE WHEN c_custkey % 20 = 13 THEN (c_custkey * 7919 + 100000) % 2000000 ELSE 2000000 END)) AS since
FROM customer WHERE c_custkey % 10 = 3
UNION ALL SELECT id, TIMESTAMP '2000-01-01' FROM known"""

SUBSCRIPTIONS = """
SELECT n_name AS subscription, unnest(CASE n_nationkey % 6
    WHEN 0 THEN ['devices/+/readings', 'devices/dev-' || n_nationkey || '/#'] WHEN 1 THEN ['devices/dev-' || n_nationkey || '/#']
    WHEN 2 THEN ['+/+/a/+', 'devices/#/x'] WHEN 3 THEN ['devices/+/+/#'] WHEN 4 THEN ['devices/dev-' || n_nationkey || '/readings', 'dev+/#']
    ELSE ['+', 'devices//readings'] END) AS topic_filter
FROM nation"""

# Columns of a stage's input: spoiled, invalid, recorded time after the default.
OUTCOMES = """
SELECT *, CASE WHEN spoiled THEN 'DECODE_ERROR' WHEN invalid THEN 'INVALID'
               WHEN unknown THEN 'DEVICE_NOT_FOUND' WHEN turn > 1 THEN 'DUPLICATE'
               WHEN ingested_at > closes + to_seconds(10) THEN 'DROPPED_LATE'
               WHEN ingested_at > closes THEN 'ACCEPTED_LATE' ELSE 'ACCEPTED' END AS outcome
FROM (SELECT *, date_trunc('minute', recorded_at) + to_minutes(1) AS closes,
             row_number() OVER (PARTITION BY idempotency_key, spoiled OR invalid OR unknown
                                ORDER BY ingested_at, delivery_seq) AS turn
      FROM (SELECT *, device_id NOT IN (SELECT id FROM known) AS unknown FROM staged))"""

STAGED = "SELECT *, FALSE AS spoiled, FALSE AS invalid FROM deliveries"

STAGED_MESSAGES = """
SELECT device_id, CASE WHEN event_id % 50 <> 1 THEN metric_type END AS metric_type,
       CASE WHEN event_id % 50 <> 1 THEN value END AS value,
       CASE WHEN event_id % 50 <> 1 THEN recorded_at ELSE ingested_at END AS recorded_at, ingested_at,
       CASE WHEN event_id % 50 <> 1 THEN idempotency_key END AS idempotency_key, delivery_seq,
       event_id % 50 = 1 AS spoiled, FALSE AS invalid
FROM deliveries"""

STAGED_FAULTY = """
SELECT device_id, metric_type, value, coalesce(recorded_at, ingested_at) AS recorded_at, ingested_at,
       idempotency_key, delivery_seq, FALSE AS spoiled,
       delivery_seq IN (SELECT row_key FROM violations) AS invalid
FROM faulty"""

COLUMNS = ("device_id, metric_type, value, recorded_at, ingested_at, idempotency_key, delivery_seq")

FIRST = """
SELECT * FROM deliveries
QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at, delivery_seq) = 1"""

STORED = """
SELECT * FROM deliveries WHERE device_id IN (SELECT id FROM known)
QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at, delivery_seq) = 1"""

MINUTE = """
SELECT *, date_trunc('minute', recorded_at) AS window_start FROM readings
WHERE ingested_at <= date_trunc('minute', recorded_at) + to_seconds(70)"""

DAY = """
SELECT *, date_trunc('day', recorded_at) AS window_start FROM readings
WHERE ingested_at <= date_trunc('day', recorded_at) + to_days(1) + to_seconds(10)"""

STATS = """device_id, metric_type, window_start, round(avg(value), 6) AS average,
       quantile_disc(value, 0.95) AS p95, count(*) AS count"""

DEVICE_VIEW = "id, device_name, device_type, site, latitude, longitude, created_at, updated_at"

# Each text may use those before it.
_PARTS = {
    "readings": READINGS,
    "deliveries": DELIVERIES,
    "stray": STRAY,
    "faulty": FAULTY,
    "violations": VIOLATIONS,
    "known": KNOWN,
    "device_requests": DEVICE_REQUESTS,
    "devices": DEVICES,
    "device_violations": DEVICE_VIOLATIONS,
    "gateways": GATEWAYS,
    "registrations": REGISTRATIONS,
    "patches": PATCHES,
    "deletes": DELETES,
    "deletions": DELETIONS,
    "first_rows": FIRST,
    "stored": STORED,
    "minute_rows": MINUTE,
    "day_rows": DAY,
}


def _with(select: str, **more: str) -> str:
    parts = {**_PARTS, **more}
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + "\n" + select


def _outcomes(staged: str, select: str) -> str:
    return _with(select, staged=staged, outcomes=OUTCOMES)


def oracle_sql() -> dict[str, str]:
    patched = {"patch_errors": PATCH_ERRORS.format(devices="devices"),
               "patched": PATCHED.format(devices="devices")}
    registered = REGISTERED.format(at="2024-02-02 00:00:00")
    stream_readings = _outcomes(
        STAGED_MESSAGES,
        f"SELECT {COLUMNS} FROM outcomes WHERE outcome IN ('ACCEPTED', 'ACCEPTED_LATE', 'DROPPED_LATE')")
    stream_metrics = _outcomes(
        STAGED_MESSAGES,
        f"""SELECT {STATS}
            FROM (SELECT *, date_trunc('minute', recorded_at) AS window_start FROM outcomes
                  WHERE outcome IN ('ACCEPTED', 'ACCEPTED_LATE'))
            GROUP BY device_id, metric_type, window_start""")
    stream_outcomes = _outcomes(
        STAGED_MESSAGES, "SELECT outcome, count(*) AS rows FROM outcomes GROUP BY outcome")
    return {
        "reading_messages": _with(
            r"SELECT topic, ingested_at, delivery_seq FROM stray"
            r" WHERE regexp_full_match(topic, 'devices/[^/]*/readings')"),
        "reading_requests": _with(f"SELECT {COLUMNS} FROM faulty"),
        "device_requests": _with(
            "SELECT id, device_name, device_type, site, latitude, longitude, received_at, seq"
            " FROM device_requests"),
        "write_readings": _with(f"SELECT {COLUMNS} FROM stored"),
        "write_devices": _with(f"SELECT {DEVICE_VIEW} FROM patched", **patched),
        "merge_transports": _with("""
            SELECT device_id,
                   CASE WHEN NOT bad THEN metric_type END AS metric_type,
                   CASE WHEN NOT bad THEN value END AS value,
                   CASE WHEN NOT bad THEN recorded_at END AS recorded_at, ingested_at,
                   CASE WHEN NOT bad THEN idempotency_key END AS idempotency_key, delivery_seq,
                   bad AS decode_error
            FROM (SELECT *, metric_type IN ('click', 'view', 'error') AND event_id % 50 = 1 AS bad
                  FROM deliveries)"""),

        "topic_match": _with(
            r"SELECT topic, delivery_seq FROM stray"
            r" WHERE regexp_full_match(topic, 'devices/[^/]*/readings')"),
        "subscription_match": _with("""
            SELECT DISTINCT subscription, topic, delivery_seq
            FROM stray JOIN subscriptions ON regexp_full_match(topic, '(?s)' || CASE
                WHEN topic_filter = '+' THEN '[^/]*'
                ELSE replace(replace(topic_filter, '+', '[^/]*'), '/#', '(/.*)?') END)
            WHERE topic <> '' AND topic_filter NOT IN ('devices/#/x', 'dev+/#')""", subscriptions=SUBSCRIPTIONS),
        "topic_device_id": _with("SELECT topic, delivery_seq, level AS device_id FROM stray"),
        "payload_decode": _with("""
            SELECT 'devices/' || device_id || '/readings' AS topic, device_id,
                   CASE WHEN event_id % 50 <> 1 THEN metric_type END AS metric_type,
                   CASE WHEN event_id % 50 <> 1 THEN value END AS value,
                   CASE WHEN event_id % 50 <> 1 THEN recorded_at END AS recorded_at,
                   CASE WHEN event_id % 50 <> 1 THEN idempotency_key END AS idempotency_key,
                   ingested_at, delivery_seq, event_id % 50 = 1 AS decode_error
            FROM deliveries"""),
        "decode_rejects": _with("""
            SELECT 'devices/' || device_id || '/readings' AS topic, ingested_at, delivery_seq
            FROM deliveries WHERE event_id % 50 = 1"""),
        "recorded_at_default": _with(
            "SELECT delivery_seq, coalesce(recorded_at, ingested_at) AS recorded_at, ingested_at FROM faulty"),
        "ingest_stamp": _with("""
            SELECT 'devices/' || device_id || '/readings' AS topic, ingested_at,
                   (delivery_seq // 4) * 65536 + delivery_seq % 4 AS delivery_seq
            FROM deliveries"""),
        "device_type_decode": _with("""
            SELECT seq, device_type,
                   device_type IN ('CAMERA', 'GATEWAY', 'SENSOR', 'EDGE_NODE') AS type_known
            FROM device_requests"""),
        "location_pack": _with("""
            SELECT seq, '{"latitude":' || latitude || ',"longitude":' || longitude || '}' AS location
            FROM device_requests"""),
        "location_flatten": _with("SELECT id, latitude, longitude FROM devices"),
        "reading_view": _with("""
            SELECT device_id, metric_type, value, recorded_at, ingested_at,
                   date_diff('microsecond', recorded_at, ingested_at) AS lag_us
            FROM readings"""),
        "device_view": _with(f"SELECT {DEVICE_VIEW} FROM devices"),

        "validate_readings": _with("""
            SELECT delivery_seq, count(row_key) AS violation_count
            FROM faulty LEFT JOIN violations ON row_key = delivery_seq GROUP BY delivery_seq"""),
        "validate_devices": _with("""
            SELECT seq, count(row_key) AS violation_count
            FROM device_requests LEFT JOIN device_violations ON row_key = seq GROUP BY seq"""),
        "validate_device_patches": _with("SELECT id, seq, error FROM patch_errors", **patched),
        "violation_list": _with("SELECT row_key, field, message FROM violations"),
        "device_violation_list": _with("SELECT row_key, field, message FROM device_violations"),

        "known_device_readings": _with(
            f"SELECT {COLUMNS} FROM deliveries WHERE device_id IN (SELECT id FROM known)"),
        "unknown_device_readings": _with(
            f"SELECT {COLUMNS} FROM deliveries WHERE device_id NOT IN (SELECT id FROM known)"),
        "resolve_duplicates": _with("""
            SELECT d.idempotency_key, d.ingested_at, d.delivery_seq, s.device_id AS stored_device_id,
                   s.metric_type AS stored_metric_type, s.value AS stored_value,
                   s.recorded_at AS stored_recorded_at, s.ingested_at AS stored_ingested_at,
                   s.delivery_seq AS stored_delivery_seq
            FROM deliveries d JOIN stored s ON d.idempotency_key = s.idempotency_key
            WHERE d.delivery_seq <> s.delivery_seq"""),
        "reading_with_device": _with("""
            SELECT idempotency_key, device_id, device_name, device_type, site, value
            FROM readings JOIN devices ON device_id = id"""),

        "dedup_first_wins": _with(f"SELECT {COLUMNS} FROM first_rows"),
        "dedup_against_store": _with(f"""
            SELECT {COLUMNS} FROM deliveries
            WHERE ingested_at >= TIMESTAMP '2024-01-08' AND idempotency_key NOT IN (
                SELECT idempotency_key FROM deliveries WHERE ingested_at < TIMESTAMP '2024-01-16')
            QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at, delivery_seq) = 1"""),
        "key_index_dedup": _with(f"""
            SELECT {COLUMNS} FROM deliveries
            WHERE ingested_at >= TIMESTAMP '2024-01-08' AND idempotency_key NOT IN (
                SELECT idempotency_key FROM deliveries WHERE ingested_at < TIMESTAMP '2024-01-16')
            QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at, delivery_seq) = 1"""),
        "dedup_stream": _with(f"SELECT {COLUMNS} FROM first_rows"),
        "duplicate_count": _with("""
            SELECT count(*) - count(DISTINCT idempotency_key) AS duplicate_count
            FROM deliveries WHERE device_id IN (SELECT id FROM known)"""),

        "window_key": _with("""
            SELECT idempotency_key, device_id, metric_type, date_trunc('minute', recorded_at) AS window_start
            FROM readings"""),
        "lateness_class": _with("""
            SELECT idempotency_key, window_start, window_end,
                   CASE WHEN ingested_at <= window_end THEN 'ON_TIME'
                        WHEN ingested_at <= window_end + to_seconds(10) THEN 'LATE_ACCEPTED'
                        ELSE 'LATE_DROPPED' END AS lateness
            FROM (SELECT *, date_trunc('minute', recorded_at) AS window_start,
                         date_trunc('minute', recorded_at) + to_minutes(1) AS window_end FROM readings)"""),
        "late_by": _with("""
            SELECT idempotency_key, late_us
            FROM (SELECT idempotency_key,
                         date_diff('microsecond', date_trunc('minute', recorded_at) + to_minutes(1),
                                   ingested_at) AS late_us
                  FROM readings)
            WHERE late_us > 0"""),
        "drop_too_late": _with(f"SELECT {COLUMNS}, window_start FROM minute_rows"),
        "late_dropped_rows": _with("""
            SELECT idempotency_key, device_id, metric_type, window_start, window_end,
                   date_diff('microsecond', window_end, ingested_at) AS late_us
            FROM (SELECT *, date_trunc('minute', recorded_at) AS window_start,
                         date_trunc('minute', recorded_at) + to_minutes(1) AS window_end FROM readings)
            WHERE ingested_at > window_end + to_seconds(10)"""),
        "window_avg": _with("""
            SELECT device_id, metric_type, window_start, round(avg(value), 6) AS average
            FROM minute_rows GROUP BY device_id, metric_type, window_start"""),
        "window_count": _with("""
            SELECT device_id, metric_type, window_start, count(*) AS count
            FROM minute_rows GROUP BY device_id, metric_type, window_start"""),
        "window_p95": _with("""
            SELECT device_id, metric_type, window_start, quantile_disc(value, 0.95) AS p95
            FROM day_rows GROUP BY device_id, metric_type, window_start"""),
        "window_p95_by_metric": _with("""
            SELECT metric_type, window_start, quantile_disc(value, 0.95) AS p95
            FROM day_rows GROUP BY metric_type, window_start"""),
        "window_p95_hot_groups": _with("""
            SELECT metric_type, window_start, quantile_disc(value, 0.95) AS p95
            FROM day_rows GROUP BY metric_type, window_start"""),
        "window_metrics": _with(
            f"SELECT {STATS} FROM minute_rows GROUP BY device_id, metric_type, window_start"),
        "window_metrics_daily": _with(
            f"SELECT {STATS} FROM day_rows GROUP BY device_id, metric_type, window_start"),
        "window_metrics_close_after": _with(f"""
            SELECT {STATS}
            FROM (SELECT *, date_trunc('minute', recorded_at) AS window_start FROM readings
                  WHERE ingested_at <= date_trunc('minute', recorded_at) + to_seconds(130))
            GROUP BY device_id, metric_type, window_start"""),
        "current_window": _with(f"""
            SELECT {STATS}
            FROM day_rows WHERE window_start = TIMESTAMP '2024-01-15 00:00:00'
            GROUP BY device_id, metric_type, window_start"""),
        "late_counts": _with("""
            SELECT count(*) FILTER (WHERE late_us > 0 AND late_us <= 10000000) AS late_accepted,
                   count(*) FILTER (WHERE late_us > 10000000) AS late_dropped
            FROM (SELECT date_diff('microsecond', date_trunc('minute', recorded_at) + to_minutes(1),
                                   ingested_at) AS late_us
                  FROM readings)"""),
        "stream_window_metrics": _with(
            f"SELECT {STATS} FROM minute_rows GROUP BY device_id, metric_type, window_start"),

        "register_devices": _with(f"SELECT {DEVICE_VIEW} FROM registered", registered=registered),
        "register_outcome": _with("SELECT id, seq, outcome FROM registrations"),
        "get_devices": _with("""
            SELECT 'dev-' || c_custkey AS id, d.id IS NOT NULL AS found, device_name, device_type, site
            FROM customer LEFT JOIN devices d ON d.id = 'dev-' || c_custkey"""),
        "list_devices": _with(f"SELECT {DEVICE_VIEW} FROM devices"),
        "patch_devices": _with(f"SELECT {DEVICE_VIEW} FROM patched", **patched),
        "audit_times": _with(
            "SELECT id, created_at, updated_at FROM patched",
            registered=REGISTERED.format(at="2024-01-20 00:00:00"),
            patch_errors=PATCH_ERRORS.format(devices="registered"),
            patched=PATCHED.format(devices="registered")),
        "delete_devices": _with(f"""
            SELECT {DEVICE_VIEW} FROM devices
            WHERE id NOT IN (SELECT id FROM deletions WHERE outcome = 'DELETED')"""),
        "delete_outcome": _with("SELECT id, seq, outcome FROM deletions"),

        "device_change_outcome": _with(
            "SELECT id, seq, kind, outcome FROM change_outcomes", device_changes=DEVICE_CHANGES, change_outcomes=CHANGE_OUTCOMES),
        "apply_device_changes": _with(
            f"SELECT {DEVICE_VIEW} FROM changed", device_changes=DEVICE_CHANGES, change_outcomes=CHANGE_OUTCOMES, change_events=CHANGE_EVENTS, changed=CHANGED),
        "stream_device_changes": _with(f"""
            SELECT {COLUMNS} FROM staged JOIN late_known ON device_id = id AND since <= ingested_at WHERE NOT spoiled
            QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at, delivery_seq) = 1""",
                                       staged=STAGED_MESSAGES, late_known=LATE_KNOWN),

        "ingest_outcome": _outcomes(STAGED, "SELECT delivery_seq, idempotency_key, outcome FROM outcomes"),
        "ingest_outcome_messages": _outcomes(
            STAGED_MESSAGES, "SELECT delivery_seq, idempotency_key, outcome FROM outcomes"),
        "ingest_outcome_faulty": _outcomes(
            STAGED_FAULTY, "SELECT delivery_seq, recorded_at, outcome FROM outcomes"),
        "outcome_counts": _outcomes(
            STAGED, "SELECT outcome, count(*) AS rows FROM outcomes GROUP BY outcome"),
        "reading_counts": _with(
            "SELECT device_id, count(*) AS reading_count FROM stored GROUP BY device_id"),

        "stream_duplicate_answers": _outcomes(STAGED_MESSAGES, """
            SELECT d.idempotency_key, d.ingested_at, d.delivery_seq, s.device_id AS stored_device_id,
                   s.metric_type AS stored_metric_type, s.value AS stored_value,
                   s.recorded_at AS stored_recorded_at, s.ingested_at AS stored_ingested_at,
                   s.delivery_seq AS stored_delivery_seq
            FROM outcomes d JOIN outcomes s ON d.idempotency_key = s.idempotency_key
            WHERE d.outcome = 'DUPLICATE' AND s.outcome IN ('ACCEPTED', 'ACCEPTED_LATE', 'DROPPED_LATE')"""),
        "stream_late_rows": _outcomes(STAGED_MESSAGES, """
            SELECT idempotency_key, device_id, metric_type, date_trunc('minute', recorded_at) AS window_start, closes AS window_end,
                   date_diff('microsecond', closes, ingested_at) AS late_us
            FROM outcomes WHERE outcome = 'DROPPED_LATE'"""),
        "stream_progress": _with("""
            SELECT CASE WHEN ingested_at < TIMESTAMP '2024-01-11' THEN 0 WHEN ingested_at < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch_id,
                   count(*) AS input_rows, TRUE AS has_rate, TRUE AS has_backlog
            FROM deliveries GROUP BY 1"""),
        "stream_readings": stream_readings,
        "stream_metrics": stream_metrics,
        "store_current_window": _outcomes(
            STAGED_MESSAGES,
            f"""SELECT {STATS}
                FROM (SELECT *, date_trunc('minute', recorded_at) AS window_start FROM outcomes
                      WHERE outcome IN ('ACCEPTED', 'ACCEPTED_LATE'))
                GROUP BY device_id, metric_type, window_start
                QUALIFY window_start = max(window_start) OVER ()"""),
        "stateful_stream_readings": stream_readings,
        "stateful_stream_metrics": stream_metrics,
        "stream_outcomes": stream_outcomes,
        "stateful_stream_outcomes": stream_outcomes,
    }
