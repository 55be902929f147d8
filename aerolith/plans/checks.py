"""Oracle side of the quality rules: the constraints in their positive CHECK
form, written from the operational and warehouse schemas and independent of
``operators.quality.ROW_RULES``, and the rows that break them.

``BREAKS`` names, per table, the key, a modulus and the values that replace a
column where the key has a given remainder, as SQL both engines read. It
derives the broken input of ``dq_rules_broken`` from the real tables.
"""

from __future__ import annotations

# table -> rule -> what must hold (NULL passes, as in a CHECK)
CHECKS: dict[str, dict[str, str]] = {
    "location": {
        "C1_name_not_blank": "trim(name) <> ''", "C1_city_not_blank": "trim(city) <> ''",
        "C1_country_not_blank": "trim(country) <> ''", "C1_timezone_not_blank": "trim(timezone) <> ''",
        "C3_latitude_range": "latitude BETWEEN -90 AND 90", "C3_longitude_range": "longitude BETWEEN -180 AND 180",
        "C6_seen_order": "last_seen_at >= first_seen_at",
        "C11_name_not_null": "name IS NOT NULL", "C11_city_not_null": "city IS NOT NULL",
        "C11_country_not_null": "country IS NOT NULL", "C11_first_seen_not_null": "first_seen_at IS NOT NULL",
        "C11_last_seen_not_null": "last_seen_at IS NOT NULL"},
    "parameter": {
        "C1_code_not_blank": "trim(code) <> ''", "C1_display_name_not_blank": "trim(display_name) <> ''",
        "C1_unit_not_blank": "trim(preferred_unit) <> ''",
        "C11_code_not_null": "code IS NOT NULL", "C11_display_name_not_null": "display_name IS NOT NULL",
        "C11_unit_not_null": "preferred_unit IS NOT NULL"},
    "sensor": {
        "C1_unit_not_blank": "trim(unit) <> ''", "C6_seen_order": "last_seen_at >= first_seen_at",
        "C11_location_not_null": "location_id IS NOT NULL", "C11_parameter_not_null": "parameter_id IS NOT NULL",
        "C11_unit_not_null": "unit IS NOT NULL"},
    "measurement_raw": {
        "C1_unit_not_blank": "trim(unit) <> ''", "C4_value_range": "value > -1000 AND value < 100000",
        "C11_sensor_not_null": "sensor_id IS NOT NULL", "C11_value_not_null": "value IS NOT NULL",
        "C11_measured_at_not_null": "measured_at IS NOT NULL", "C11_unit_not_null": "unit IS NOT NULL"},
    "threshold_rule": {
        "C1_city_not_blank": "trim(city) <> ''",
        "C2_warning_level": "warning_level IN ('low', 'moderate', 'high', 'critical')",
        "C5_min_value_non_negative": "min_value >= 0", "C11_min_value_not_null": "min_value IS NOT NULL",
        "C11_parameter_not_null": "parameter_id IS NOT NULL", "C11_city_not_null": "city IS NOT NULL",
        "C11_warning_level_not_null": "warning_level IS NOT NULL"},
    "pollution_alert": {
        "C2_alert_level": "alert_level IN ('low', 'moderate', 'high', 'critical')",
        "C2_alert_status": "status IN ('open', 'reviewed', 'closed')",
        "C6_review_order": "reviewed_at >= generated_at",
        "C11_measurement_not_null": "measurement_id IS NOT NULL", "C11_rule_not_null": "threshold_rule_id IS NOT NULL",
        "C11_alert_level_not_null": "alert_level IS NOT NULL", "C11_status_not_null": "status IS NOT NULL",
        "C11_generated_at_not_null": "generated_at IS NOT NULL"},
    "ingestion_run_log": {
        "C2_run_type": "run_type IN ('initial', 'incremental', 'manual')",
        "C2_run_status": "status IN ('running', 'succeeded', 'failed', 'partial')",
        "C5_inserted_non_negative": "records_inserted >= 0", "C5_failed_non_negative": "records_failed >= 0",
        "C5_requested_non_negative": "records_requested >= 0",
        "C6_run_order": "finished_at >= started_at",
        "C11_run_type_not_null": "run_type IS NOT NULL", "C11_status_not_null": "status IS NOT NULL",
        "C11_started_at_not_null": "started_at IS NOT NULL"},
    "raw_api_response": {
        "C1_endpoint_not_blank": "trim(endpoint) <> ''", "C1_url_not_blank": "trim(url) <> ''",
        "C11_endpoint_not_null": "endpoint IS NOT NULL", "C11_url_not_null": "url IS NOT NULL",
        "C11_response_body_not_null": "response_body IS NOT NULL"},
    "pollution_alert_outbox": {
        "C2_event_type": "event_type IN ('created', 'status_changed')",
        "C2_previous_status": "previous_status IN ('open', 'reviewed', 'closed')",
        "C2_current_status": "current_status IN ('open', 'reviewed', 'closed')",
        "C8_status_really_changed": "event_type <> 'status_changed' OR previous_status IS DISTINCT FROM current_status",
        "C11_event_type_not_null": "event_type IS NOT NULL", "C11_current_status_not_null": "current_status IS NOT NULL",
        "C11_payload_not_null": "payload IS NOT NULL"},
    "dim_location": {
        "C6_valid_order": "valid_to > valid_from", "C11_valid_from_not_null": "valid_from IS NOT NULL",
        "C11_row_hash_not_null": "row_hash IS NOT NULL"},
    "dim_sensor": {
        "C6_valid_order": "valid_to > valid_from", "C11_valid_from_not_null": "valid_from IS NOT NULL",
        "C11_row_hash_not_null": "row_hash IS NOT NULL"},
    "dim_risk_class": {
        "C5_min_value_non_negative": "min_value >= 0", "C7_band_order": "max_value > min_value"},
    "dim_date": {
        "C7_quarter_range": "quarter BETWEEN 1 AND 4", "C7_month_range": "month BETWEEN 1 AND 12",
        "C7_day_range": "day BETWEEN 1 AND 31", "C7_weekday_range": "weekday BETWEEN 1 AND 7"},
    "dim_time": {
        "C7_hour_range": "hour BETWEEN 0 AND 23", "C7_minute_range": "minute BETWEEN 0 AND 59",
        "C2_part_of_day": "part_of_day IN ('night', 'morning', 'afternoon', 'evening')"},
}

# table -> (key, modulus, column -> {remainder: replacing value})
BREAKS: dict[str, tuple[str, int, dict[str, dict[int, str]]]] = {
    "location": ("location_id", 13, {
        "name": {1: "'  '", 2: "NULL"}, "city": {2: "''", 3: "NULL"}, "country": {3: "' '", 4: "NULL"},
        "timezone": {5: "''"}, "latitude": {6: "CAST(90.5 AS DECIMAL(9,6))", 7: "CAST(-91 AS DECIMAL(9,6))"},
        "longitude": {8: "CAST(180.000001 AS DECIMAL(9,6))", 7: "CAST(-181 AS DECIMAL(9,6))"},
        "first_seen_at": {9: "NULL"}, "last_seen_at": {10: "first_seen_at - INTERVAL 1 DAY", 11: "NULL"}}),
    "parameter": ("parameter_id", 6, {
        "code": {1: "' '", 2: "NULL"}, "display_name": {2: "''", 3: "NULL"}, "preferred_unit": {3: "' '", 1: "NULL"}}),
    "sensor": ("sensor_id", 17, {
        "unit": {1: "''", 2: "NULL"}, "location_id": {3: "NULL"}, "parameter_id": {4: "NULL"},
        "last_seen_at": {5: "first_seen_at - INTERVAL 1 HOUR"}}),
    "measurement_raw": ("measurement_id", 19, {
        "unit": {1: "' '", 2: "NULL"}, "sensor_id": {6: "NULL"}, "measured_at": {7: "NULL"},
        "value": {3: "CAST(-1000 AS DECIMAL(12,4))", 4: "CAST(100000 AS DECIMAL(12,4))", 5: "NULL",
                  8: "CAST(-999.9999 AS DECIMAL(12,4))", 9: "CAST(99999.9999 AS DECIMAL(12,4))"}}),
    "threshold_rule": ("threshold_rule_id", 11, {
        "city": {1: "' '", 2: "NULL"}, "warning_level": {3: "'severe'", 4: "NULL"},
        "min_value": {5: "CAST(-0.0001 AS DECIMAL(12,4))", 6: "NULL"}, "parameter_id": {7: "NULL"}}),
    "pollution_alert": ("measurement_id", 13, {
        "alert_level": {1: "'extreme'", 2: "NULL"}, "status": {3: "'ignored'", 4: "NULL"},
        "generated_at": {5: "NULL"}, "reviewed_at": {6: "generated_at - INTERVAL 1 HOUR"},
        "threshold_rule_id": {7: "NULL"}, "measurement_id": {8: "NULL"}}),
    "ingestion_run_log": ("ingestion_run_id", 7, {
        "run_type": {1: "'scheduled'", 2: "NULL"}, "status": {3: "'done'", 4: "NULL"},
        "records_inserted": {5: "-1"}, "records_failed": {6: "-1"}, "records_requested": {2: "-1"},
        "started_at": {0: "NULL"}, "finished_at": {1: "started_at - INTERVAL 1 HOUR"}}),
    "raw_api_response": ("source_id", 7, {
        "endpoint": {1: "' '", 2: "NULL"}, "url": {3: "''", 4: "NULL"}, "response_body": {5: "NULL"}}),
    "pollution_alert_outbox": ("measurement_id", 5, {
        "event_type": {1: "'removed'", 2: "NULL"}, "previous_status": {3: "'lost'", 4: "current_status"},
        "current_status": {2: "'lost'", 1: "NULL"}, "payload": {3: "NULL"}}),
    "dim_location": ("source_location_id", 7, {
        "valid_to": {1: "valid_from", 2: "valid_from - INTERVAL 1 DAY"}, "valid_from": {3: "NULL"}, "row_hash": {4: "NULL"}}),
    "dim_sensor": ("source_sensor_id", 7, {
        "valid_to": {1: "valid_from", 2: "valid_from - INTERVAL 1 DAY"}, "valid_from": {3: "NULL"}, "row_hash": {4: "NULL"}}),
    "dim_risk_class": ("risk_class_key", 5, {
        "min_value": {1: "CAST(-1 AS DECIMAL(12,4))"}, "max_value": {2: "min_value", 3: "CAST(0 AS DECIMAL(12,4))"}}),
    "dim_date": ("date_key", 100, {
        "quarter": {1: "0"}, "month": {2: "13"}, "day": {3: "32"}, "weekday": {4: "0"}}),
    "dim_time": ("time_key", 100, {"hour": {1: "24"}, "minute": {2: "60"}, "part_of_day": {3: "'dusk'"}}),
}

# the generated dimensions, for DuckDB
DIMS_SQL = """
, dim_risk_class AS (
  SELECT risk_class_key, CAST(min_value AS DECIMAL(12,4)) AS min_value, CAST(max_value AS DECIMAL(12,4)) AS max_value
  FROM (VALUES (1, 0, 10), (2, 10, 25), (3, 25, 50), (4, 50, NULL)) t(risk_class_key, min_value, max_value))
, dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
         isodow(d) AS weekday
  FROM generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY) t(d))
, dim_time AS (
  SELECT h * 100 + mi AS time_key, h AS hour, mi AS minute,
         CASE WHEN h < 6 THEN 'night' WHEN h < 12 THEN 'morning' WHEN h < 18 THEN 'afternoon' ELSE 'evening' END AS part_of_day
  FROM range(24) a(h), range(60) b(mi))
"""
# where DuckDB finds each table
SOURCES = {"measurement_raw": "m", "pollution_alert": "reviewed", "ingestion_run_log": "(SELECT *, 0 AS records_requested FROM runs)",
           "raw_api_response": "raw_pages",
           "pollution_alert_outbox": "outbox", "dim_location": "dim_loc2", "dim_sensor": "dim_sen2"}


def replaced(table: str) -> dict[str, str]:
    """column -> SQL of its value in the broken rows of ``table``."""
    key, mod, columns = BREAKS[table]
    return {c: "CASE " + " ".join(f"WHEN {key} % {mod} = {r} THEN {v}" for r, v in at.items()) + f" ELSE {c} END"
            for c, at in columns.items()}


def counts_sql(broken: bool) -> str:
    """rule, table_name, bad_count of every check, on the tables or their broken rows."""
    ctes, parts = "", []
    for t, rules in CHECKS.items():
        src = SOURCES.get(t, t)
        if broken:
            ctes += f", x_{t} AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in replaced(t).items())}) FROM {src})\n"
            src = f"x_{t}"
        parts += [f"SELECT '{name}' AS rule, '{t}' AS table_name, count(*) FILTER (WHERE NOT ({check})) AS bad_count FROM {src}"
                  for name, check in rules.items()]
    return DIMS_SQL + ctes + "\nUNION ALL ".join(parts)


# --- keys and references (C9, C10) --------------------------------------------

# the tables with a key or a reference that the oracle does not have under their name
KEY_TABLES_SQL = DIMS_SQL.replace("SELECT risk_class_key, CAST(min_value", "SELECT risk_class_key, code, risk_class_key AS sort_order, CAST(min_value") \
    .replace("(VALUES (1, 0, 10), (2, 10, 25), (3, 25, 50), (4, 50, NULL)) t(risk_class_key, min_value, max_value)",
             "(VALUES (1, 'low', 0, 10), (2, 'moderate', 10, 25), (3, 'high', 25, 50), (4, 'critical', 50, NULL)) t(risk_class_key, code, min_value, max_value)") \
    .replace("AS date_key, quarter(d)", "AS date_key, CAST(d AS DATE) AS full_date, quarter(d)") + """
, measurement_raw AS (SELECT * FROM m)
, pollution_alert AS (SELECT * FROM reviewed)
, ingestion_run_log AS (SELECT * FROM runs)
, pollution_alert_outbox AS (SELECT * FROM outbox)
, dim_parameter AS (SELECT parameter_id AS parameter_key, code FROM parameter)
, dim_location AS (SELECT *, CAST(hash(source_location_id, valid_from) AS HUGEINT) AS location_key FROM dim_loc2)
, dim_sensor AS (SELECT *, CAST(hash(source_sensor_id, valid_from) AS HUGEINT) AS sensor_key FROM dim_sen2)
, loc_key AS (SELECT location_id AS source_location_id, CAST(hash(location_id, COALESCE(first_seen_at, TIMESTAMP '2024-01-01')) AS HUGEINT) AS location_key FROM cur_loc)
, sen_key AS (SELECT sensor_id AS source_sensor_id, CAST(hash(sensor_id, COALESCE(first_seen_at, TIMESTAMP '2024-01-01')) AS HUGEINT) AS sensor_key FROM cur_sen)
, fact_measurement AS (SELECT * FROM fact_m JOIN loc_key USING (source_location_id) JOIN sen_key USING (source_sensor_id))
, fact_alert AS (SELECT * FROM fact_a JOIN loc_key USING (source_location_id))
, fact_prediction AS (
  SELECT i.*, p.parameter_id AS parameter_key, 'fixed_linear' AS model_name, '0.1.0' AS model_version, {score_risk} AS risk_class_key,
         CAST(strftime(target_measured_at, '%Y%m%d') AS INTEGER) AS target_date_key, location_key, sensor_key,
         CAST(hour(target_measured_at) * 100 + minute(target_measured_at) AS INTEGER) AS target_time_key
  FROM inputs i JOIN loc_key USING (source_location_id) JOIN sen_key USING (source_sensor_id) JOIN parameter p ON p.code = i.parameter_code)
"""


def _lost(columns: dict[str, int], key: str, value: str = "-1 - {}") -> dict[str, str]:
    """column -> SQL of its value where a row's ``key`` mod 23 is the given remainder: one no parent has."""
    return {c: f"CASE WHEN {key} % 23 = {r} THEN {value.format(c)} ELSE {c} END" for c, r in columns.items()}


_FACT = {"location_key": 1, "parameter_key": 2, "date_key": 3, "time_key": 4, "risk_class_key": 5, "sensor_key": 6}


def _fact_breaks(key: str, **names: str) -> dict[str, str]:
    return _lost({names.get(c, c): r for c, r in _FACT.items() if names.get(c, c)}, key)


#: table -> key, condition of the rows that occur twice, column -> SQL of its replaced value
KEY_BREAKS: dict[str, tuple[str, str, dict[str, str]]] = {
    "parameter": ("parameter_id", "parameter_id = 2", {}),
    "location": ("location_id", "location_id % 29 = 5", {}),
    "sensor": ("sensor_id", "sensor_id % 29 = 5", _lost({"location_id": 1, "parameter_id": 2}, "sensor_id")),
    "measurement_raw": ("measurement_id", "measurement_id % 29 = 5", _lost({"sensor_id": 1, "ingestion_run_id": 2}, "measurement_id")),
    "threshold_rule": ("threshold_rule_id", "threshold_rule_id % 29 = 5", _lost({"parameter_id": 1}, "threshold_rule_id")),
    "pollution_alert": ("pollution_alert_id", "pollution_alert_id % 29 = 5",
                        _lost({"measurement_id": 1, "threshold_rule_id": 2}, "pollution_alert_id")),
    "pollution_alert_outbox": ("pollution_alert_id", "pollution_alert_id % 29 = 5",
                               {"pollution_alert_id": "CASE WHEN measurement_id % 23 = 3 THEN -1 - pollution_alert_id ELSE pollution_alert_id END"}),
    "dim_date": ("date_key", "date_key % 29 = 5", {}),
    "dim_parameter": ("parameter_key", "parameter_key = 3", {}),
    "dim_risk_class": ("risk_class_key", "risk_class_key = 4", {}),
    "dim_location": ("source_location_id", "source_location_id % 29 = 5", {}),
    "dim_sensor": ("source_sensor_id", "source_sensor_id % 29 = 5", {}),
    "fact_measurement": ("source_measurement_id", "source_measurement_id % 29 = 5", _fact_breaks("source_measurement_id")),
    "fact_alert": ("source_alert_id", "source_alert_id % 29 = 5", _fact_breaks("source_alert_id", sensor_key="")),
    "fact_prediction": ("source_sensor_id", "source_sensor_id % 29 = 5",
                        _fact_breaks("source_sensor_id", date_key="target_date_key", time_key="target_time_key")),
}

#: the keys and references as the schemas declare them: rule: (table, columns[, condition]) or (table, columns, parent, columns)
KEYS: dict[str, tuple] = {
    "C9_parameter_code": ("parameter", "code"), "C9_parameter_source_id": ("parameter", "openaq_parameter_id"),
    "C9_location_source_id": ("location", "openaq_location_id"), "C9_sensor_source_id": ("sensor", "openaq_sensor_id"),
    "C9_reading_id_time": ("measurement_raw", "measurement_id, measured_at"),
    "C9_reading_sensor_time": ("measurement_raw", "sensor_id, measured_at"),
    "C9_rule_key": ("threshold_rule", "parameter_id, city, warning_level"),
    "C9_alert_reading_rule": ("pollution_alert", "measurement_id, threshold_rule_id"),
    "C9_date_full_date": ("dim_date", "full_date"), "C9_dim_parameter_code": ("dim_parameter", "code"),
    "C9_risk_code": ("dim_risk_class", "code"), "C9_risk_sort_order": ("dim_risk_class", "sort_order"),
    "C9_one_current_location": ("dim_location", "source_location_id", "is_current"),
    "C9_location_version": ("dim_location", "source_location_id, valid_from"),
    "C9_one_current_sensor": ("dim_sensor", "source_sensor_id", "is_current"),
    "C9_sensor_version": ("dim_sensor", "source_sensor_id, valid_from"),
    "C9_fact_grain": ("fact_measurement", "source_measurement_id"), "C9_alert_fact_grain": ("fact_alert", "source_alert_id"),
    "C9_prediction_key": ("fact_prediction", "source_location_id, source_sensor_id, parameter_code, target_measured_at, model_name, model_version"),
    "C10_sensor_location": ("sensor", "location_id", "location", "location_id"),
    "C10_sensor_parameter": ("sensor", "parameter_id", "parameter", "parameter_id"),
    "C10_reading_sensor": ("measurement_raw", "sensor_id", "sensor", "sensor_id"),
    "C10_reading_run": ("measurement_raw", "ingestion_run_id", "ingestion_run_log", "ingestion_run_id"),
    "C10_rule_parameter": ("threshold_rule", "parameter_id", "parameter", "parameter_id"),
    "C10_alert_reading": ("pollution_alert", "measurement_id, measurement_measured_at", "measurement_raw", "measurement_id, measured_at"),
    "C10_alert_rule": ("pollution_alert", "threshold_rule_id", "threshold_rule", "threshold_rule_id"),
    "C10_outbox_alert": ("pollution_alert_outbox", "pollution_alert_id", "pollution_alert", "pollution_alert_id"),
    "C10_fact_location": ("fact_measurement", "location_key", "dim_location", "location_key"),
    "C10_fact_sensor": ("fact_measurement", "sensor_key", "dim_sensor", "sensor_key"),
    "C10_fact_parameter": ("fact_measurement", "parameter_key", "dim_parameter", "parameter_key"),
    "C10_fact_date": ("fact_measurement", "date_key", "dim_date", "date_key"),
    "C10_fact_time": ("fact_measurement", "time_key", "dim_time", "time_key"),
    "C10_fact_risk_class": ("fact_measurement", "risk_class_key", "dim_risk_class", "risk_class_key"),
    "C10_alert_fact_location": ("fact_alert", "location_key", "dim_location", "location_key"),
    "C10_alert_fact_parameter": ("fact_alert", "parameter_key", "dim_parameter", "parameter_key"),
    "C10_alert_fact_date": ("fact_alert", "date_key", "dim_date", "date_key"),
    "C10_alert_fact_time": ("fact_alert", "time_key", "dim_time", "time_key"),
    "C10_alert_fact_risk_class": ("fact_alert", "risk_class_key", "dim_risk_class", "risk_class_key"),
    "C10_prediction_location": ("fact_prediction", "location_key", "dim_location", "location_key"),
    "C10_prediction_sensor": ("fact_prediction", "sensor_key", "dim_sensor", "sensor_key"),
    "C10_prediction_parameter": ("fact_prediction", "parameter_key", "dim_parameter", "parameter_key"),
    "C10_prediction_date": ("fact_prediction", "target_date_key", "dim_date", "date_key"),
    "C10_prediction_time": ("fact_prediction", "target_time_key", "dim_time", "time_key"),
    "C10_prediction_risk_class": ("fact_prediction", "risk_class_key", "dim_risk_class", "risk_class_key"),
}


def key_counts_sql(broken: bool, kinds: tuple[str, ...] = ("C9", "C10")) -> str:
    """rule, table_name, bad_count of every key and reference, on the tables or their broken rows."""
    ctes, name = "", {t: t for k in KEYS.values() for t in (k[0], k[2] if len(k) == 4 else k[0])}
    if broken:
        for t, (_, twice, columns) in KEY_BREAKS.items():
            replace = f"* REPLACE ({', '.join(f'{e} AS {c}' for c, e in columns.items())})" if columns else "*"
            ctes += f", y_{t} AS (SELECT {replace} FROM {t}), x_{t} AS (SELECT * FROM y_{t} UNION ALL SELECT * FROM y_{t} WHERE {twice})\n"
            name[t] = f"x_{t}"
    parts = []
    for rule, (t, columns, *rest) in KEYS.items():
        if rule.split("_")[0] not in kinds:
            continue
        given = " AND ".join(f"c.{c} IS NOT NULL" for c in columns.split(", "))
        if rule.startswith("C9"):
            where = f"{given} AND {rest[0]}" if rest else given
            count = f"(SELECT count(*) FROM (SELECT 1 FROM {name[t]} c WHERE {where} GROUP BY {columns} HAVING count(*) > 1))"
        else:
            same = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(columns.split(", "), rest[1].split(", ")))
            count = f"(SELECT count(*) FROM {name[t]} c WHERE {given} AND NOT EXISTS (SELECT 1 FROM {name[rest[0]]} p WHERE {same}))"
        parts.append(f"SELECT '{rule}' AS rule, '{t}' AS table_name, {count} AS bad_count")
    return ctes + "\nUNION ALL ".join(parts)
