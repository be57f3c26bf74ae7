"""The same results as plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

_READINGS = """
WITH r AS (
  SELECT event_id, concat('V', lpad(CAST(1 + user_id % 5 AS VARCHAR), 3, '0')) AS vehicle_id,
    CASE event_id % 4 WHEN 0 THEN 'FL' WHEN 1 THEN 'FR' WHEN 2 THEN 'RL' ELSE 'RR' END AS tire_position,
    CAST(1704067200000 + event_id * 500 AS BIGINT) AS ts_ms,
    CAST(round(value * 100) AS BIGINT) AS v, CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events
), readings AS (
  SELECT event_id, concat(vehicle_id, '-', tire_position) AS sensor_id, vehicle_id, tire_position, ts_ms,
    epoch_ms(ts_ms) AS ts,
    CAST(CASE WHEN k < 30 THEN 15000 + (v * 37) % 20001 ELSE 20000 + (v * 37) % 8001 END AS DOUBLE) / 100 AS pressure_kpa,
    CAST(CASE WHEN k < 30 THEN 7500 + (v * 13) % 2001 ELSE 6500 + (v * 13) % 1301 END AS DOUBLE) / 100 AS temperature_c,
    CAST(280 + event_id % 61 AS DOUBLE) / 100 AS battery_voltage,
    CAST(60 + v % 61 AS DOUBLE) AS pressure_psi
  FROM r
)"""

_MESSAGES = """, messages AS (
  SELECT *, event_id % 101 AS fault, CASE event_id % 101
    WHEN 0 THEN '{bad'
    WHEN 1 THEN concat('{"sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id, '","timestamp":', ts_ms, ',"temperature_c":', temperature_c, '}')
    WHEN 2 THEN concat('{"sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id, '","timestamp":', ts_ms, ',"pressure_kpa":"', pressure_kpa, '","temperature_c":', temperature_c, '}')
    WHEN 3 THEN concat('{"sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id, '","timestamp":', ts_ms, ',"pressure_kpa":null,"temperature_c":', temperature_c, '}')
    WHEN 4 THEN '[1,2]'
    ELSE concat('{"sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id, '","timestamp":', ts_ms, ',"pressure_kpa":', pressure_kpa, ',"temperature_c":', temperature_c, ',"battery_voltage":', battery_voltage, '}')
    END AS value
  FROM readings
)"""


def _tiered(source: str = "readings") -> str:
    return f""", tiered AS (
  SELECT event_id, concat(sensor_id, CASE WHEN low THEN '-LP-' ELSE '-HT-' END, ts_ms) AS alert_id, sensor_id, vehicle_id,
    ts AS "timestamp", CASE WHEN low THEN 'LOW_PRESSURE' ELSE 'HIGH_TEMPERATURE' END AS alert_type,
    CASE WHEN low THEN CASE WHEN pressure_kpa < 180 THEN 'HIGH' ELSE 'MEDIUM' END
         ELSE CASE WHEN temperature_c > 95 THEN 'HIGH' ELSE 'MEDIUM' END END AS severity,
    CASE WHEN low THEN printf('Pressure %.1f kPa is below threshold 200 kPa', pressure_kpa)
         ELSE printf('Temperature %.1f°C is above threshold 90°C', temperature_c) END AS description,
    CASE WHEN low THEN pressure_kpa ELSE temperature_c END AS triggering_value,
    concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), CASE WHEN ts_ms % 1000 = 0 THEN '' ELSE strftime(ts, '.%f') END) AS iso_time
  FROM (SELECT *, pressure_kpa < 200 AS low FROM {source} WHERE pressure_kpa < 200 OR temperature_c > 90)
)"""


_MULTI = """, multi AS (
  SELECT concat(sensor_id, '-LP-', ts_ms) AS alert_id, sensor_id, vehicle_id, ts AS "timestamp", 'LOW_PRESSURE' AS alert_type,
    'HIGH' AS severity, printf('Pressure %.1f kPa is below threshold 180.0 kPa', pressure_kpa) AS description,
    pressure_kpa AS triggering_value FROM readings WHERE pressure_kpa < 180
  UNION ALL
  SELECT concat(sensor_id, '-HP-', ts_ms), sensor_id, vehicle_id, ts, 'HIGH_PRESSURE', 'HIGH',
    printf('Pressure %.1f kPa is above threshold 300.0 kPa', pressure_kpa), pressure_kpa
  FROM readings WHERE pressure_kpa > 300
  UNION ALL
  SELECT concat(sensor_id, '-HT-', ts_ms), sensor_id, vehicle_id, ts, 'HIGH_TEMPERATURE', 'MEDIUM',
    printf('Temperature %.1f°C is above threshold 80.0°C', temperature_c), temperature_c
  FROM readings WHERE temperature_c > 80
)"""

_CASE = """, cases AS (
SELECT concat(sensor_id, '_', ts_ms) AS alert_id, sensor_id, vehicle_id, ts AS "timestamp",
  -- Fixed values: names, levels and texts of the three rules.
  ['LOW_PRESSURE', 'HIGH_PRESSURE', 'HIGH_TEMPERATURE'][hit] AS alert_type, ['HIGH', 'HIGH', 'MEDIUM'][hit] AS severity,
  concat(['Pressure ', 'Pressure ', 'Temperature '][hit], CAST(found AS VARCHAR),
    [' kPa is below threshold 180 kPa', ' kPa is above threshold 300 kPa', '°C is above threshold 80°C'][hit]) AS description,
  found AS triggering_value
FROM (SELECT *, CASE WHEN hit < 3 THEN pressure_kpa ELSE temperature_c END AS found
      FROM (SELECT *, list_position([pressure_kpa < 180, pressure_kpa > 300, temperature_c > 80], true) AS hit FROM readings))
WHERE hit > 0
)"""

_ALERT_COLUMNS = "alert_id, sensor_id, vehicle_id, \"timestamp\", alert_type, severity, description, triggering_value"

_ALERT_TABLE = f""", alert_table AS (
  SELECT {_ALERT_COLUMNS}, event_id % 3 = 0 AS is_resolved, "timestamp" + INTERVAL 2 SECOND AS created_at FROM tiered
)"""

_AGGREGATE_COLUMNS = (
    "sensor_id, vehicle_id, window_start, window_end, window_size, avg_pressure, avg_temperature, "
    "min_pressure, max_pressure, min_temperature, max_temperature, record_count"
)


def _windows(time: str = "ts") -> str:
    return f""", aggs AS (
  SELECT sensor_id, vehicle_id, w AS window_start, w + INTERVAL 1 MINUTE AS window_end, '1m' AS window_size,
    CAST(sum(CAST(round(pressure_kpa * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS avg_pressure,
    CAST(sum(CAST(round(temperature_c * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS avg_temperature,
    min(pressure_kpa) AS min_pressure, max(pressure_kpa) AS max_pressure,
    min(temperature_c) AS min_temperature, max(temperature_c) AS max_temperature, count(*) AS record_count
  FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, {time}) AS w FROM readings)
  GROUP BY sensor_id, vehicle_id, w
)"""


_VEHICLES = """, vehicles AS (
  SELECT concat('V', CASE WHEN c_custkey + 2 < 1000 THEN lpad(CAST(c_custkey + 2 AS VARCHAR), 3, '0')
                          ELSE CAST(c_custkey + 2 AS VARCHAR) END) AS vehicle_id,
    CASE WHEN c_acctbal < 0 THEN '' ELSE concat('owner', c_custkey, '@example.com') END AS owner_email,
    concat(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'owner' ELSE 'driver' END, c_custkey, '@example.com') AS driver_email,
    TIMESTAMP '2024-01-01' AS created_at
  FROM customer
)"""

_CHANGES = """, changes AS (
  SELECT concat('V', CASE WHEN s_suppkey * 20 + 1 < 1000 THEN lpad(CAST(s_suppkey * 20 + 1 AS VARCHAR), 3, '0')
                          ELSE CAST(s_suppkey * 20 + 1 AS VARCHAR) END) AS vehicle_id,
    concat('fleet', s_suppkey, '@example.com') AS owner_email, concat('desk', s_suppkey, '@example.com') AS driver_email
  FROM supplier
)"""

_BOTH_BRANCHES = (
    _READINGS
    + _tiered()
    + " SELECT alert_id, severity, CAST(1 AS BIGINT) AS in_table, CAST(1 AS BIGINT) AS in_topic FROM tiered"
)

_NOTIFICATIONS = (
    _READINGS
    + _tiered()
    + _VEHICLES
    + """
SELECT t.alert_id, t.vehicle_id,
  CASE WHEN owner_email = driver_email THEN owner_email
       ELSE concat(least(owner_email, driver_email), ', ', greatest(owner_email, driver_email)) END AS recipients,
  concat('[', severity, '] Tire Alert for Vehicle ', t.vehicle_id, ': ', alert_type) AS subject,
  concat(chr(10), '        TIRE ALERT NOTIFICATION', chr(10), '        =======================', chr(10), '        ', chr(10),
    '        Vehicle ID: ', t.vehicle_id, chr(10), '        Alert Type: ', alert_type, chr(10),
    '        Severity:   ', severity, chr(10), '        Time:       ', iso_time, chr(10), '        ', chr(10),
    '        Description:', chr(10), '        ', description, chr(10), '        ', chr(10),
    '        Please check the dashboard for more details.', chr(10), '        ') AS body
FROM tiered t JOIN vehicles v ON t.vehicle_id = v.vehicle_id WHERE owner_email <> ''"""
)

_JSON_WINDOWS = """, json_aggs AS (
  SELECT sensor_id, vehicle_id, w AS window_start, w + INTERVAL 1 MINUTE AS window_end, '1m' AS window_size,
    CAST(sum(CAST(round(p * 100) AS BIGINT)) AS DOUBLE) / 100 / count(p) AS avg_pressure,
    CAST(sum(CAST(round(temperature_c * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS avg_temperature,
    min(p) AS min_pressure, max(p) AS max_pressure,
    min(temperature_c) AS min_temperature, max(temperature_c) AS max_temperature, count(*) AS record_count
  FROM (SELECT *, CASE WHEN fault NOT IN (2, 3) THEN pressure_kpa END AS p, time_bucket(INTERVAL 1 MINUTE, ts) AS w
        FROM messages WHERE fault NOT IN (0, 1, 4))
  GROUP BY sensor_id, vehicle_id, w
)"""

_JSON_ALERTS = (
    _READINGS
    + ", readable AS (SELECT * FROM readings WHERE event_id % 101 NOT IN (0, 1, 3, 4))"
    + _tiered("readable")
    + f"""
SELECT {_ALERT_COLUMNS} FROM tiered
UNION ALL
SELECT concat(sensor_id, '-LP-', ts_ms), sensor_id, vehicle_id, ts, 'LOW_PRESSURE', 'HIGH',
  'Pressure 150.0 kPa is below threshold 200 kPa', 150.0::DOUBLE
FROM readable r WHERE event_id % 50 = 7 AND NOT EXISTS (SELECT 1 FROM tiered t WHERE t.alert_id = concat(r.sensor_id, '-LP-', r.ts_ms))"""
)

# A row that is sent late counts only if its window was still open when it came.
_WINDOWS_JSON_STREAM = (
    _READINGS
    + _MESSAGES
    + f""", sent AS (
  SELECT *, CASE WHEN event_id % 97 = 5 AND part < 2 THEN part + 2 ELSE part END AS sent_in
  FROM (SELECT *, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS part,
          CASE WHEN fault NOT IN (2, 3) THEN pressure_kpa END AS p, time_bucket(INTERVAL 1 MINUTE, ts) AS w
        FROM messages) WHERE fault NOT IN (0, 1, 4)
), marks AS (
  SELECT n AS sent_in, (SELECT max(ts) - INTERVAL 5 SECOND FROM sent WHERE sent_in < n) AS mark FROM range(5) t(n)
), kept AS (
  SELECT s.* FROM sent s JOIN marks m ON s.sent_in = m.sent_in WHERE mark IS NULL OR w + INTERVAL 1 MINUTE > mark
), stream_aggs AS (
  SELECT sensor_id, vehicle_id, w AS window_start, w + INTERVAL 1 MINUTE AS window_end, '1m' AS window_size,
    CAST(sum(CAST(round(p * 100) AS BIGINT)) AS DOUBLE) / 100 / count(p) AS avg_pressure,
    CAST(sum(CAST(round(temperature_c * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS avg_temperature,
    min(p) AS min_pressure, max(p) AS max_pressure,
    min(temperature_c) AS min_temperature, max(temperature_c) AS max_temperature, count(*) AS record_count
  FROM kept GROUP BY sensor_id, vehicle_id, w
)
SELECT {_AGGREGATE_COLUMNS} FROM stream_aggs
WHERE avg_pressure IS NOT NULL AND window_end <= (SELECT mark FROM marks WHERE sent_in = 4)"""
)

_PAYLOAD = """concat('{"alert_id":"', alert_id, '","sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id,
  '","timestamp":', epoch_ms("timestamp"), ',"alert_type":"', alert_type, '","severity":"', severity,
  '","description":"', description, '","triggering_value":', triggering_value"""

_AGGREGATE_ID = "row_number() OVER (ORDER BY window_start, sensor_id, vehicle_id)"

_CLOCK = "TIMESTAMP '2024-06-01 12:00:00'"


def oracles() -> dict[str, str]:
    """``name -> SQL`` for the registered queries."""
    tiered = _READINGS + _tiered()
    alerts = tiered + _ALERT_TABLE
    windows = _READINGS + _windows()
    messages = _READINGS + _MESSAGES
    reading_out = "sensor_id, vehicle_id, ts_ms"
    battery = "CASE WHEN fault IN (1, 2, 3) THEN NULL ELSE battery_voltage END AS battery_voltage"
    strict_pressure = "CASE WHEN fault IN (1, 2, 3) THEN NULL ELSE pressure_kpa END AS pressure_kpa"
    case = _READINGS + _CASE
    plain = {
        "tumble_agg_1m": windows + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs",
        "tumble_agg_1m_stream": windows
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs"
        " WHERE window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM readings)",
        "tumble_agg_ingest_time": _READINGS
        + _windows("ts + to_seconds(event_id % 7)")
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs",
        "tumble_agg_clock_stream": _READINGS
        + _windows("ts + to_seconds(event_id % 7)")
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs",
        "aggregates_to_table": windows + f" SELECT {_AGGREGATE_ID} AS id, {_AGGREGATE_COLUMNS}, {_CLOCK} AS created_at FROM aggs",
        "windows_from_json": messages
        + _JSON_WINDOWS
        + f" SELECT {_AGGREGATE_COLUMNS} FROM json_aggs WHERE avg_pressure IS NOT NULL",
        "windows_rejected": messages
        + _JSON_WINDOWS
        + " SELECT sensor_id, window_start, record_count,"
        " 'avg_pressure is null; min_pressure is null; max_pressure is null' AS reason"
        " FROM json_aggs WHERE avg_pressure IS NULL",
        "short_windows_rejected": messages
        + " SELECT sensor_id, w AS window_start, count(*) AS record_count,"
        " 'avg_pressure is null; min_pressure is null; max_pressure is null' AS reason"
        " FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, ts) AS w FROM messages WHERE fault NOT IN (0, 1, 4))"
        " GROUP BY sensor_id, vehicle_id, w HAVING count(*) FILTER (fault NOT IN (2, 3)) = 0",
        "windows_json_stream": _WINDOWS_JSON_STREAM,
        "alerts_tiered": tiered + f" SELECT {_ALERT_COLUMNS}, iso_time FROM tiered",
        "alerts_multi": _READINGS + _MULTI + f" SELECT {_ALERT_COLUMNS}, {_CLOCK} AS processed_at FROM multi",
        "alerts_case": case + f" SELECT {_ALERT_COLUMNS} FROM cases",
        "alert_payload_case": case + f" SELECT {_PAYLOAD}, '}}') AS value FROM cases",
        "alert_payload_multi": _READINGS
        + _MULTI
        + f""" SELECT {_PAYLOAD}, ',"processed_at":"2024-06-01T12:00:00"}}') AS value FROM multi""",
        "alerts_rejected": tiered
        + """
SELECT alert_id, CASE WHEN event_id % 10 = 7 THEN repeat(alert_type, 5) ELSE alert_type END AS alert_type,
  CASE WHEN event_id % 10 <> 3 THEN severity END AS severity,
  CASE WHEN event_id % 10 = 3 THEN 'severity is null' ELSE 'alert_type is longer than 50' END AS reason
FROM tiered WHERE event_id % 10 IN (3, 7)""",
        "alerts_json_stream": _JSON_ALERTS,
        "alerts_json_stream_quarantine": messages
        + " SELECT value, CASE WHEN fault IN (1, 3) THEN 'bad_value' ELSE 'malformed' END AS reason"
        " FROM messages, range(2) c(copy) WHERE fault IN (0, 1, 3, 4) AND (copy = 0 OR event_id % 50 = 7)",
        "ingest_rejected": _READINGS
        + """
SELECT CASE event_id % 53 WHEN 0 THEN '{bad' WHEN 1 THEN concat('{"pressure":', pressure_kpa, ',"timestamp":', ts_ms, '}')
    ELSE concat('{"tire_id":"', sensor_id, '","timestamp":"soon"}') END AS value,
  CASE event_id % 53 WHEN 0 THEN 'malformed' ELSE 'bad_value' END AS reason
FROM readings WHERE event_id % 53 < 3""",
        "alerts_legacy_psi": _READINGS
        + ' SELECT vehicle_id, tire_position, pressure_psi, temperature_c, true AS alert, ts_ms AS "timestamp"'
        " FROM readings WHERE pressure_psi < 90 OR temperature_c > 80",
        "alerts_legacy_check": _READINGS
        + " SELECT vehicle_id, 'Check tire' AS alert FROM readings WHERE pressure_psi < 90 OR temperature_c > 80",
        "alerts_legacy_json": _READINGS
        + """
SELECT concat('{"vehicle_id":"', vehicle_id, '","tire_position":"', tire_position, '","pressure_psi":', pressure_psi,
  ',"temperature_c":', temperature_c, ',"alert":true,"timestamp":', ts_ms, '}') AS value
FROM readings WHERE pressure_psi < 90 OR temperature_c > 80""",
        "reading_labels": _READINGS
        + " SELECT sensor_id, ts_ms, pressure_kpa, temperature_c, CASE WHEN pressure_kpa < 180 OR pressure_kpa > 300"
        " OR temperature_c > 80 THEN 'ALERT' ELSE 'NORMAL' END AS label FROM readings",
        "smoke_classes": messages
        + " SELECT event_id, value, CASE WHEN pressure_kpa < 180 THEN 'LOW PRESSURE'"
        " WHEN temperature_c > 80 THEN 'HIGH TEMP' END AS class FROM messages WHERE fault > 4",
        "parse_strict": messages
        + f" SELECT event_id, {reading_out}, {strict_pressure}, temperature_c, {battery}"
        " FROM messages WHERE fault NOT IN (0, 1, 4)",
        "parse_tolerant": messages
        + f" SELECT event_id, {reading_out}, pressure_kpa, temperature_c, {battery}, ts"
        " FROM messages WHERE fault NOT IN (0, 1, 3, 4)",
        "parse_quarantine": messages
        + " SELECT event_id, value, CASE WHEN fault = 1 THEN 'missing_field' ELSE 'malformed' END AS reason"
        " FROM messages WHERE fault IN (0, 1, 4)",
        "parse_tolerant_quarantine": messages
        + " SELECT event_id, value, CASE WHEN fault IN (1, 3) THEN 'bad_value' ELSE 'malformed' END AS reason"
        " FROM messages WHERE fault IN (0, 1, 3, 4)",
        "parse_sql_table": messages
        + f" SELECT event_id, {reading_out}, {strict_pressure}, temperature_c, {battery}"
        " FROM messages WHERE fault NOT IN (0, 4)",
        "alerts_from_json": _READINGS
        + ", readable AS (SELECT * FROM readings WHERE event_id % 101 NOT IN (0, 1, 3, 4))"
        + _tiered("readable")
        + f" SELECT {_ALERT_COLUMNS} FROM tiered",
        "alert_json_payload": tiered
        + ' SELECT alert_id, sensor_id, vehicle_id, iso_time AS "timestamp", alert_type, severity, description,'
        " triggering_value FROM tiered",
        "alerts_from_topic": tiered + f" SELECT {_ALERT_COLUMNS} FROM tiered",
        "alerts_insert_ignore": tiered
        + _MULTI
        + f"""
SELECT row_number() OVER (ORDER BY batch, "timestamp", alert_id) AS id, {_ALERT_COLUMNS},
  false AS is_resolved, {_CLOCK} AS created_at
FROM (
  SELECT 0 AS batch, {_ALERT_COLUMNS} FROM tiered
  UNION ALL
  SELECT 1, {_ALERT_COLUMNS} FROM multi m WHERE NOT EXISTS (SELECT 1 FROM tiered t WHERE t.alert_id = m.alert_id)
)""",
        "alerts_fan_out": _BOTH_BRANCHES,
        "alerts_stream_fan_out": _BOTH_BRANCHES,
        "alerts_stream_distinct": tiered + f" SELECT {_ALERT_COLUMNS} FROM tiered",
        "alerts_packed": tiered + f" SELECT {_ALERT_COLUMNS} FROM tiered",
        "vehicles_upsert": "WITH"
        + _VEHICLES.lstrip(",")
        + _CHANGES
        + f"""
SELECT coalesce(c.vehicle_id, v.vehicle_id) AS vehicle_id, coalesce(c.owner_email, v.owner_email) AS owner_email,
  coalesce(c.driver_email, v.driver_email) AS driver_email, coalesce(v.created_at, {_CLOCK}) AS created_at
FROM vehicles v FULL JOIN changes c ON v.vehicle_id = c.vehicle_id""",
        "tire_data_ingest": _READINGS
        + ' SELECT sensor_id AS tire_id, pressure_kpa AS pressure, temperature_c AS temperature, ts AS "timestamp"'
        " FROM readings",
        "tire_data_all": _READINGS
        + " SELECT sensor_id AS tire_id, pressure_kpa AS pressure, temperature_c AS temperature,"
        f' CASE WHEN temperature_c <= 80 THEN ts ELSE {_CLOCK} END AS "timestamp" FROM readings',
        "latest_alerts": alerts + ' SELECT * FROM alert_table ORDER BY "timestamp" DESC, alert_id LIMIT 20',
        "latest_aggregations": windows
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs ORDER BY window_end DESC, sensor_id, vehicle_id LIMIT 20",
        "stored_latest_alerts": tiered
        + f"""
SELECT {_ALERT_COLUMNS}, id, false AS is_resolved, {_CLOCK} AS created_at
FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", alert_id) AS id FROM tiered)
ORDER BY "timestamp" DESC, alert_id LIMIT 20""",
        "stored_latest_aggregations": windows
        + f"""
SELECT {_AGGREGATE_COLUMNS}, id, {_CLOCK} AS created_at
FROM (SELECT *, {_AGGREGATE_ID} AS id FROM aggs)
ORDER BY window_end DESC, sensor_id, vehicle_id LIMIT 20""",
        "stored_recent_aggregations": windows
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs"
        " WHERE window_start >= (SELECT max(window_start) - INTERVAL 1 HOUR FROM aggs)",
        "vehicle_latest_metrics": _READINGS
        + """
SELECT vehicle_id, sensor_id, ts AS "timestamp", pressure_kpa, temperature_c, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, sensor_id) AS rank FROM readings)
WHERE rank <= 10""",
        "vehicle_latest_alerts": alerts
        + f"""
SELECT {_ALERT_COLUMNS}, is_resolved, created_at, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY "timestamp" DESC, alert_id) AS rank FROM alert_table)
WHERE rank <= 10""",
        "one_vehicle_latest_alerts": alerts
        + " SELECT * FROM alert_table WHERE vehicle_id = 'V003' ORDER BY \"timestamp\" DESC, alert_id LIMIT 10",
        "current_alerts": alerts + ' SELECT * FROM alert_table WHERE is_resolved = FALSE ORDER BY "timestamp" DESC',
        "recent_aggregations": windows
        + f" SELECT {_AGGREGATE_COLUMNS} FROM aggs"
        " WHERE window_start >= (SELECT max(ts) - INTERVAL 1 HOUR FROM readings) ORDER BY window_start DESC",
        "dashboard_summary": alerts
        + _windows()
        + f"""
SELECT (SELECT count(*) FROM alert_table) AS total_alerts_history,
  (SELECT count(DISTINCT vehicle_id) FROM aggs) AS active_vehicles_24h,
  (SELECT count(*) FROM alert_table WHERE severity = 'CRITICAL') AS critical_alerts_total,
  (SELECT count(*) FROM alert_table WHERE severity = 'WARNING') AS warning_alerts_total, {_CLOCK} AS last_updated""",
        "alert_severities": alerts + " SELECT severity, count(*) AS alerts FROM alert_table GROUP BY severity",
        "table_counts": alerts
        + _windows()
        + " SELECT CAST((SELECT count(*) FROM alert_table) AS INT) AS alert_count,"
        " CAST((SELECT count(*) FROM aggs) AS INT) AS agg_count",
        "high_alerts_last_hour": alerts
        + " SELECT count(*) AS high_alerts, count(*) > 0 AS raise_alert FROM alert_table"
        " WHERE severity = 'HIGH' AND created_at > (SELECT max(ts) - INTERVAL 1 HOUR FROM readings)",
        "panel_series": windows
        + ' SELECT window_start AS "time", sensor_id, vehicle_id, avg_pressure, avg_temperature FROM aggs ORDER BY 1, 2, 3',
        "panel_alert_distribution": alerts + " SELECT alert_type, count(*) AS alerts FROM alert_table GROUP BY alert_type",
        "panel_active_vehicles": windows + " SELECT count(DISTINCT vehicle_id) AS active_vehicles FROM aggs",
        "notifications_outbox": _NOTIFICATIONS,
        "notifications_stream": _NOTIFICATIONS,
        "notifications_unroutable": tiered
        + _VEHICLES
        + " SELECT alert_id, vehicle_id, alert_type, severity FROM tiered t WHERE NOT EXISTS"
        " (SELECT 1 FROM vehicles v WHERE v.vehicle_id = t.vehicle_id AND v.owner_email <> '')",
    }
    # Stored and streamed forms have the answers of the derived ones.
    same = {
        "stored_dashboard_summary": "dashboard_summary",
        "stored_current_alerts": "current_alerts",
        "stored_high_alerts_last_hour": "high_alerts_last_hour",
        "vehicle_latest_stream": "vehicle_latest_metrics",
        "vehicles_upsert_buckets": "vehicles_upsert",
    }
    return plain | {name: plain[as_] for name, as_ in same.items()}
