"""DuckDB SQL that rebuilds the core tables from the driver views.

Mirrors ``aerolith.sources.driver_tables``; every oracle query starts with
``CORE`` and then names its own CTEs / final SELECT.
"""

CORE = """
WITH
parameter AS (
  SELECT CAST(row_number() OVER (ORDER BY code) AS INTEGER) AS parameter_id,
         CAST(row_number() OVER (ORDER BY code) AS INTEGER) AS openaq_parameter_id,
         code, upper(code) AS display_name, 'ug/m3' AS preferred_unit,
         CAST(NULL AS VARCHAR) AS description
  FROM (SELECT DISTINCT event_type AS code FROM events WHERE event_type IS NOT NULL) t
),
location AS (
  SELECT c.c_custkey AS location_id, c.c_custkey AS openaq_location_id, c.c_name AS name,
         CAST(NULL AS VARCHAR) AS locality, n.n_name AS city, r.r_name AS country,
         CAST(CAST(((c.c_custkey * 7) % 1801) - 900 AS DOUBLE) / 10 AS DECIMAL(9,6)) AS latitude,
         CAST(CAST(((c.c_custkey * 13) % 3601) - 1800 AS DOUBLE) / 10 AS DECIMAL(9,6)) AS longitude,
         'UTC' AS timezone, (c.c_custkey % 10) <> 9 AS is_active,
         TIMESTAMP '2023-12-01 00:00:00' + to_hours(CAST(c.c_custkey % 720 AS INTEGER)) AS first_seen_at,
         TIMESTAMP '2023-12-01 00:00:00' + to_hours(CAST(c.c_custkey % 720 AS INTEGER))
             + to_days(CAST(c.c_custkey % 7 AS INTEGER)) AS last_seen_at,
         CAST(c.c_nationkey AS INTEGER) AS nation_key
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
sensor AS (
  SELECT e.user_id * 1000 + p.parameter_id AS sensor_id,
         e.user_id * 1000 + p.parameter_id AS openaq_sensor_id,
         e.user_id AS location_id, p.parameter_id, 'ug/m3' AS unit,
         ((e.user_id * 1000 + p.parameter_id) % 13) <> 0 AS is_active,
         e.first_seen_at, e.last_seen_at
  FROM (SELECT user_id, event_type, min(ts) AS first_seen_at, max(ts) AS last_seen_at
        FROM events GROUP BY user_id, event_type) e
  JOIN parameter p ON p.code = e.event_type
),
m AS (
  SELECT e.event_id AS measurement_id, e.user_id * 1000 + p.parameter_id AS sensor_id,
         e.ts AS measured_at, CAST(e.value AS DECIMAL(12,4)) AS value, 'ug/m3' AS unit,
         e.props AS raw_payload, CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) AS ingestion_run_id,
         CAST(date_trunc('month', e.ts) AS DATE) AS measured_month
  FROM events e JOIN parameter p ON p.code = e.event_type
),
threshold_rule AS (
  SELECT (CAST(sc.nation_key AS BIGINT) * 1000 + sc.parameter_id) * 4 + lv.level_idx AS threshold_rule_id,
         sc.parameter_id, sc.city, lv.warning_level,
         CAST(lv.base + CASE WHEN lv.level_idx > 0 THEN sc.nation_key % 3 ELSE 0 END AS DECIMAL(12,4)) AS min_value,
         ((CAST(sc.nation_key AS BIGINT) * 1000 + sc.parameter_id) * 4 + lv.level_idx) % 7 <> 0 AS is_active,
         TIMESTAMP '2023-12-01 00:00:00' AS updated_at
  FROM (SELECT DISTINCT l.nation_key, l.city, s.parameter_id
        FROM sensor s JOIN location l ON l.location_id = s.location_id) sc
  CROSS JOIN (VALUES ('low', 0, 0), ('moderate', 1, 10), ('high', 2, 25), ('critical', 3, 50))
       AS lv(warning_level, level_idx, base)
),
readings AS (
  SELECT m.measurement_id, m.measured_at, m.value, m.unit, m.sensor_id, m.ingestion_run_id,
         s.location_id, s.parameter_id, l.city, l.name AS location_name, l.nation_key,
         p.code AS parameter_code, p.display_name AS parameter_name
  FROM m
  JOIN sensor s ON s.sensor_id = m.sensor_id
  JOIN location l ON l.location_id = s.location_id
  JOIN parameter p ON p.parameter_id = s.parameter_id
)
"""


def q(body: str) -> str:
    """Prefix a query body (extra CTEs start with ', name AS (...)')."""
    body = body.strip()
    if body.startswith(","):
        return CORE.rstrip() + body
    return CORE + body


# Warehouse scenario fragments (mirror aerolith.plans.scenarios) -------------

LOC_HIST = """
, loc_src1 AS (
  SELECT location_id, openaq_location_id, name, city, country, latitude, longitude, first_seen_at,
         md5(concat_ws('|', openaq_location_id, name, city, country, latitude, longitude)) AS row_hash
  FROM location WHERE is_active AND location_id % 20 <> 2)
, dim_loc1 AS (
  SELECT location_id AS source_location_id, openaq_location_id, name, city, country, latitude, longitude,
         COALESCE(first_seen_at, TIMESTAMP '2024-01-01 00:00:00') AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, row_hash
  FROM loc_src1)
, loc_src2 AS (
  SELECT location_id, openaq_location_id,
         CASE WHEN location_id % 10 = 0 THEN name || ' (renamed)' ELSE name END AS name,
         CASE WHEN location_id % 15 = 1 THEN 'RELOCATED' ELSE city END AS city,
         country, latitude, longitude, first_seen_at
  FROM location WHERE is_active)
, loc_src2h AS (
  SELECT *, md5(concat_ws('|', openaq_location_id, name, city, country, latitude, longitude)) AS row_hash
  FROM loc_src2)
, dim_loc2 AS (
  SELECT d.source_location_id, d.openaq_location_id, d.name, d.city, d.country, d.latitude, d.longitude,
         d.valid_from,
         CASE WHEN d.is_current AND s.row_hash IS NOT NULL AND s.row_hash <> d.row_hash
              THEN TIMESTAMP '2024-01-15 00:00:00' ELSE d.valid_to END AS valid_to,
         CASE WHEN d.is_current AND s.row_hash IS NOT NULL AND s.row_hash <> d.row_hash
              THEN false ELSE d.is_current END AS is_current,
         d.row_hash
  FROM dim_loc1 d LEFT JOIN loc_src2h s ON s.location_id = d.source_location_id
  UNION ALL
  SELECT s.location_id, s.openaq_location_id, s.name, s.city, s.country, s.latitude, s.longitude,
         CASE WHEN x.source_location_id IS NULL THEN COALESCE(s.first_seen_at, TIMESTAMP '2024-01-15 00:00:00')
              ELSE TIMESTAMP '2024-01-15 00:00:00' END,
         CAST(NULL AS TIMESTAMP), true, s.row_hash
  FROM loc_src2h s
  LEFT JOIN (SELECT source_location_id, max(CASE WHEN is_current THEN row_hash END) AS cur_hash
             FROM dim_loc1 GROUP BY 1) x ON x.source_location_id = s.location_id
  WHERE x.cur_hash IS NULL OR x.cur_hash <> s.row_hash)
"""

SEN_HIST = """
, sen_src1 AS (
  SELECT sensor_id, openaq_sensor_id, location_id, parameter_id, unit, first_seen_at,
         md5(concat_ws('|', openaq_sensor_id, location_id, parameter_id, unit)) AS row_hash
  FROM sensor WHERE is_active AND sensor_id % 11 <> 3)
, dim_sen1 AS (
  SELECT sensor_id AS source_sensor_id, openaq_sensor_id, location_id, parameter_id, unit,
         COALESCE(first_seen_at, TIMESTAMP '2024-01-01 00:00:00') AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, row_hash
  FROM sen_src1)
, sen_src2h AS (
  SELECT sensor_id, openaq_sensor_id, location_id, parameter_id,
         CASE WHEN sensor_id % 7 = 0 THEN 'ppb' ELSE unit END AS unit, first_seen_at,
         md5(concat_ws('|', openaq_sensor_id, location_id, parameter_id,
                       CASE WHEN sensor_id % 7 = 0 THEN 'ppb' ELSE unit END)) AS row_hash
  FROM sensor WHERE is_active)
, dim_sen2 AS (
  SELECT d.source_sensor_id, d.openaq_sensor_id, d.location_id, d.parameter_id, d.unit, d.valid_from,
         CASE WHEN d.is_current AND s.row_hash IS NOT NULL AND s.row_hash <> d.row_hash
              THEN TIMESTAMP '2024-01-15 00:00:00' ELSE d.valid_to END AS valid_to,
         CASE WHEN d.is_current AND s.row_hash IS NOT NULL AND s.row_hash <> d.row_hash
              THEN false ELSE d.is_current END AS is_current,
         d.row_hash
  FROM dim_sen1 d LEFT JOIN sen_src2h s ON s.sensor_id = d.source_sensor_id
  UNION ALL
  SELECT s.sensor_id, s.openaq_sensor_id, s.location_id, s.parameter_id, s.unit,
         CASE WHEN x.source_sensor_id IS NULL THEN COALESCE(s.first_seen_at, TIMESTAMP '2024-01-15 00:00:00')
              ELSE TIMESTAMP '2024-01-15 00:00:00' END,
         CAST(NULL AS TIMESTAMP), true, s.row_hash
  FROM sen_src2h s
  LEFT JOIN (SELECT source_sensor_id, max(CASE WHEN is_current THEN row_hash END) AS cur_hash
             FROM dim_sen1 GROUP BY 1) x ON x.source_sensor_id = s.sensor_id
  WHERE x.cur_hash IS NULL OR x.cur_hash <> s.row_hash)
"""

# Alert trigger, written the reference's way: best rule by (min desc, id desc).
ALERTS = """
, alert_cand AS (
  SELECT r.measurement_id, r.measured_at, t.threshold_rule_id, t.warning_level,
         row_number() OVER (PARTITION BY r.measurement_id
                            ORDER BY t.min_value DESC, t.threshold_rule_id DESC) AS rn
  FROM readings r
  JOIN threshold_rule t ON t.parameter_id = r.parameter_id AND t.city = r.city AND t.is_active
  WHERE t.warning_level <> 'low' AND r.value >= t.min_value)
, alerts AS (
  SELECT measurement_id AS pollution_alert_id, measurement_id, measured_at AS measurement_measured_at,
         threshold_rule_id, warning_level AS alert_level, 'open' AS status, measured_at AS generated_at,
         CAST(NULL AS TIMESTAMP) AS reviewed_at, CAST(NULL AS VARCHAR) AS notes
  FROM alert_cand WHERE rn = 1)
, review_cmd AS (
  SELECT pollution_alert_id,
         CASE WHEN pollution_alert_id % 5 = 0 THEN 'closed' ELSE 'reviewed' END AS new_status,
         CASE WHEN pollution_alert_id % 3 = 0 THEN 'checked' END AS new_notes,
         generated_at + INTERVAL 2 HOUR AS command_at
  FROM alerts WHERE pollution_alert_id % 5 = 0 OR pollution_alert_id % 3 = 0)
, reviewed AS (
  SELECT a.pollution_alert_id, a.measurement_id, a.measurement_measured_at, a.threshold_rule_id,
         a.alert_level, a.generated_at,
         COALESCE(c.new_status, a.status) AS status,
         CASE WHEN c.new_status IN ('reviewed', 'closed') THEN COALESCE(a.reviewed_at, c.command_at)
              ELSE a.reviewed_at END AS reviewed_at,
         CASE WHEN c.new_status IS NOT NULL THEN COALESCE(c.new_notes, a.notes) ELSE a.notes END AS notes
  FROM alerts a LEFT JOIN review_cmd c ON c.pollution_alert_id = a.pollution_alert_id)
"""

FIRST_LOAD = """
, cur_loc AS (SELECT * FROM location WHERE is_active)
, cur_sen AS (SELECT * FROM sensor WHERE is_active)
, fact_m AS (
  SELECT m.measurement_id AS source_measurement_id, l.location_id AS source_location_id,
         s.sensor_id AS source_sensor_id, p.code AS parameter_code, p.parameter_id AS parameter_key,
         CAST(strftime(m.measured_at, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(hour(m.measured_at) * 100 + minute(m.measured_at) AS INTEGER) AS time_key,
         CAST(CASE WHEN m.value >= 0 AND m.value < 10 THEN 1 WHEN m.value >= 10 AND m.value < 25 THEN 2
                   WHEN m.value >= 25 AND m.value < 50 THEN 3 WHEN m.value >= 50 THEN 4 END AS INTEGER)
              AS risk_class_key,
         m.measured_at, CAST(m.value AS DOUBLE) AS measurement_value, m.unit, m.ingestion_run_id
  FROM m
  JOIN cur_sen s ON s.sensor_id = m.sensor_id
  JOIN cur_loc l ON l.location_id = s.location_id
  JOIN parameter p ON p.parameter_id = s.parameter_id
  WHERE m.value IS NOT NULL AND m.value >= 0 AND m.value < 100000)
"""


# Exact means, written the way Spark computes avg over decimal(12,4): the
# exact sum divided by the count, rounded half-up at scale 8 (a mean of such
# means: scale 12). The integer quotient is turned into a DOUBLE by parsing
# its decimal text, so both engines produce the same bits (inputs >= 0).

def units8(col: str) -> str:
    n = f"NULLIF(count({col}), 0)"
    return f"((2 * sum(CAST(round({col} * 10000) AS HUGEINT)) * 10000 + {n}) // (2 * {n}))"


def avg_dec4(col: str) -> str:
    return f"CAST(CAST({units8(col)} AS VARCHAR) || 'e-8' AS DOUBLE)"


def avg_units8(col: str) -> str:
    n = f"NULLIF(count({col}), 0)"
    return f"CAST(CAST(((2 * sum(CAST({col} AS HUGEINT)) * 10000 + {n}) // (2 * {n})) AS VARCHAR) || 'e-12' AS DOUBLE)"
