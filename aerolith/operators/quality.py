"""Data-quality rules C1-C11 (the reference's CHECK / UNIQUE / FK constraints
re-aimed as rule jobs) and warehouse checks V1-V4.

Row rules are SQL predicate text describing a *violation*, the way a CHECK
constraint is written. All row rules of one table are counted in a single
aggregate pass (``count_if`` per rule), then unpivoted to
``(rule, table_name, bad_count)`` rows. CHECK passes on NULL, and so does a
filter on the violation predicate; NULLs are counted by the NOT NULL rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import scalars as S


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# rule name -> violation predicate, per table
ROW_RULES: dict[str, dict[str, str]] = {
    "location": {
        "C1_name_not_blank": "trim(name) = ''",
        "C1_city_not_blank": "trim(city) = ''",
        "C1_country_not_blank": "trim(country) = ''",
        "C1_timezone_not_blank": "trim(timezone) = ''",
        "C3_latitude_range": "latitude < -90 OR latitude > 90",
        "C3_longitude_range": "longitude < -180 OR longitude > 180",
        "C6_seen_order": "last_seen_at < first_seen_at",
        "C11_name_not_null": "name IS NULL",
        "C11_city_not_null": "city IS NULL",
        "C11_country_not_null": "country IS NULL",
        "C11_first_seen_not_null": "first_seen_at IS NULL",
        "C11_last_seen_not_null": "last_seen_at IS NULL",
    },
    "parameter": {
        "C1_code_not_blank": "trim(code) = ''",
        "C1_display_name_not_blank": "trim(display_name) = ''",
        "C1_unit_not_blank": "trim(preferred_unit) = ''",
        "C11_code_not_null": "code IS NULL",
        "C11_display_name_not_null": "display_name IS NULL",
        "C11_unit_not_null": "preferred_unit IS NULL",
    },
    "sensor": {
        "C1_unit_not_blank": "trim(unit) = ''",
        "C6_seen_order": "last_seen_at < first_seen_at",
        "C11_location_not_null": "location_id IS NULL",
        "C11_parameter_not_null": "parameter_id IS NULL",
        "C11_unit_not_null": "unit IS NULL",
    },
    "measurement_raw": {
        "C1_unit_not_blank": "trim(unit) = ''",
        "C4_value_range": f"value <= {S.VALUE_OPEN_MIN} OR value >= {S.VALUE_OPEN_MAX}",
        "C11_value_not_null": "value IS NULL",
        "C11_measured_at_not_null": "measured_at IS NULL",
        "C11_sensor_not_null": "sensor_id IS NULL",
        "C11_unit_not_null": "unit IS NULL",
    },
    "threshold_rule": {
        "C1_city_not_blank": "trim(city) = ''",
        "C2_warning_level": f"warning_level NOT IN {_in(S.WARNING_LEVELS)}",
        "C5_min_value_non_negative": "min_value < 0",
        "C11_min_value_not_null": "min_value IS NULL",
        "C11_parameter_not_null": "parameter_id IS NULL",
        "C11_city_not_null": "city IS NULL",
        "C11_warning_level_not_null": "warning_level IS NULL",
    },
    "pollution_alert": {
        "C2_alert_level": f"alert_level NOT IN {_in(S.WARNING_LEVELS)}",
        "C2_alert_status": f"status NOT IN {_in(S.ALERT_STATUSES)}",
        "C6_review_order": "reviewed_at < generated_at",
        "C11_measurement_not_null": "measurement_id IS NULL",
        "C11_rule_not_null": "threshold_rule_id IS NULL",
        "C11_alert_level_not_null": "alert_level IS NULL",
        "C11_status_not_null": "status IS NULL",
        "C11_generated_at_not_null": "generated_at IS NULL",
    },
    "ingestion_run_log": {
        "C2_run_type": f"run_type NOT IN {_in(S.RUN_TYPES)}",
        "C2_run_status": f"status NOT IN {_in(S.RUN_STATUSES)}",
        "C5_inserted_non_negative": "records_inserted < 0",
        "C5_failed_non_negative": "records_failed < 0",
        "C5_requested_non_negative": "records_requested < 0",
        "C6_run_order": "finished_at < started_at",
        "C11_run_type_not_null": "run_type IS NULL",
        "C11_status_not_null": "status IS NULL",
        "C11_started_at_not_null": "started_at IS NULL",
    },
    "raw_api_response": {
        "C1_endpoint_not_blank": "trim(endpoint) = ''",
        "C1_url_not_blank": "trim(url) = ''",
        "C11_endpoint_not_null": "endpoint IS NULL",
        "C11_url_not_null": "url IS NULL",
        "C11_response_body_not_null": "response_body IS NULL",
    },
    "pollution_alert_outbox": {
        "C2_event_type": f"event_type NOT IN {_in(S.OUTBOX_EVENT_TYPES)}",
        "C8_status_really_changed": "event_type = 'status_changed' AND "
                                    "NOT (previous_status IS DISTINCT FROM current_status)",
        "C2_previous_status": f"previous_status NOT IN {_in(S.ALERT_STATUSES)}",
        "C2_current_status": f"current_status NOT IN {_in(S.ALERT_STATUSES)}",
        "C11_event_type_not_null": "event_type IS NULL",
        "C11_current_status_not_null": "current_status IS NULL",
        "C11_payload_not_null": "payload IS NULL",
    },
    **{t: {
        "C6_valid_order": "valid_to <= valid_from",
        "C11_valid_from_not_null": "valid_from IS NULL",
        "C11_row_hash_not_null": "row_hash IS NULL",
    } for t in ("dim_location", "dim_sensor")},
    "dim_risk_class": {
        "C5_min_value_non_negative": "min_value < 0",
        "C7_band_order": "max_value <= min_value",
    },
    "dim_date": {
        "C7_quarter_range": "quarter < 1 OR quarter > 4",
        "C7_month_range": "month < 1 OR month > 12",
        "C7_day_range": "day < 1 OR day > 31",
        "C7_weekday_range": "weekday < 1 OR weekday > 7",
    },
    "dim_time": {
        "C7_hour_range": "hour < 0 OR hour > 23",
        "C7_minute_range": "minute < 0 OR minute > 59",
        "C2_part_of_day": f"part_of_day NOT IN {_in(S.PARTS_OF_DAY)}",
    },
}


def row_rule_counts(tables: dict[str, DataFrame], rules: dict[str, dict[str, str]] = ROW_RULES) -> DataFrame:
    """One aggregate pass per table, unpivoted to rule rows."""
    out = None
    for t, rs in rules.items():
        if t not in tables:
            continue
        agg = tables[t].agg(*[F.count_if(F.expr(p)).alias(name) for name, p in rs.items()])
        stack = ", ".join(f"'{name}', `{name}`" for name in rs)
        part = agg.selectExpr(f"stack({len(rs)}, {stack}) AS (rule, bad_count)") \
            .select("rule", F.lit(t).alias("table_name"), F.col("bad_count").cast("bigint"))
        out = part if out is None else out.unionByName(part)
    return out


def split_by_rules(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows (with the names of the broken rules)."""
    broken = F.array_compact(F.array(*[F.when(F.expr(p), F.lit(n)) for n, p in rules.items()]))
    tagged = df.withColumn("broken_rules", broken)
    return (tagged.filter(F.size("broken_rules") == 0).drop("broken_rules"),
            tagged.filter(F.size("broken_rules") > 0))


# Rule, table, key columns, condition (a partial unique index)
UNIQUE_KEYS: list[tuple[str, str, list[str], str | None]] = [
    ("C9_parameter_code", "parameter", ["code"], None),
    ("C9_parameter_source_id", "parameter", ["openaq_parameter_id"], None),
    ("C9_location_source_id", "location", ["openaq_location_id"], None),
    ("C9_sensor_source_id", "sensor", ["openaq_sensor_id"], None),
    ("C9_reading_id_time", "measurement_raw", ["measurement_id", "measured_at"], None),
    ("C9_reading_sensor_time", "measurement_raw", ["sensor_id", "measured_at"], None),
    ("C9_rule_key", "threshold_rule", ["parameter_id", "city", "warning_level"], None),
    ("C9_alert_reading_rule", "pollution_alert", ["measurement_id", "threshold_rule_id"], None),
    ("C9_date_full_date", "dim_date", ["full_date"], None),
    ("C9_dim_parameter_code", "dim_parameter", ["code"], None),
    ("C9_risk_code", "dim_risk_class", ["code"], None),
    ("C9_risk_sort_order", "dim_risk_class", ["sort_order"], None),
    ("C9_one_current_location", "dim_location", ["source_location_id"], "is_current"),
    ("C9_location_version", "dim_location", ["source_location_id", "valid_from"], None),
    ("C9_one_current_sensor", "dim_sensor", ["source_sensor_id"], "is_current"),
    ("C9_sensor_version", "dim_sensor", ["source_sensor_id", "valid_from"], None),
    ("C9_fact_grain", "fact_measurement", ["source_measurement_id"], None),
    ("C9_alert_fact_grain", "fact_alert", ["source_alert_id"], None),
    ("C9_prediction_key", "fact_prediction", ["source_location_id", "source_sensor_id", "parameter_code", "target_measured_at",
                                              "model_name", "model_version"], None),
]
# Rule, table, columns, parent, its columns
FOREIGN_KEYS: list[tuple[str, str, list[str], str, list[str]]] = [
    ("C10_sensor_location", "sensor", ["location_id"], "location", ["location_id"]),
    ("C10_sensor_parameter", "sensor", ["parameter_id"], "parameter", ["parameter_id"]),
    ("C10_reading_sensor", "measurement_raw", ["sensor_id"], "sensor", ["sensor_id"]),
    ("C10_reading_run", "measurement_raw", ["ingestion_run_id"], "ingestion_run_log", ["ingestion_run_id"]),
    ("C10_rule_parameter", "threshold_rule", ["parameter_id"], "parameter", ["parameter_id"]),
    ("C10_alert_reading", "pollution_alert", ["measurement_id", "measurement_measured_at"], "measurement_raw", ["measurement_id", "measured_at"]),
    ("C10_alert_rule", "pollution_alert", ["threshold_rule_id"], "threshold_rule", ["threshold_rule_id"]),
    ("C10_outbox_alert", "pollution_alert_outbox", ["pollution_alert_id"], "pollution_alert", ["pollution_alert_id"]),
    *[(f"C10_{short}_{name}", fact, [col], parent, [key])
      for short, fact, date, time, sensor in (("fact", "fact_measurement", "date_key", "time_key", True),
                                              ("alert_fact", "fact_alert", "date_key", "time_key", False),
                                              ("prediction", "fact_prediction", "target_date_key", "target_time_key", True))
      for name, col, parent, key in (("location", "location_key", "dim_location", "location_key"),
                                     *([("sensor", "sensor_key", "dim_sensor", "sensor_key")] if sensor else []),
                                     ("parameter", "parameter_key", "dim_parameter", "parameter_key"),
                                     ("date", date, "dim_date", "date_key"), ("time", time, "dim_time", "time_key"),
                                     ("risk_class", "risk_class_key", "dim_risk_class", "risk_class_key"))],
]


def _key_text(columns: list[str]) -> F.Column:
    """A key as text, NULL where any column is (such a key breaks nothing).
    The columns' lengths come first, so different keys differ as texts."""
    parts = [F.col(c).cast("string") for c in columns]
    return parts[0] if len(parts) == 1 else F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":")) for p in parts], *parts)


def key_rule_counts(tables: dict[str, DataFrame], unique=UNIQUE_KEYS, foreign=FOREIGN_KEYS) -> DataFrame:
    """Violations of every key and reference, in one shuffle.

    Each table is read once and gives, for every constraint it takes part in, a
    row (constraint, key, rows that hold it, whether a parent has it). These
    are combined before the shuffle, so a reference that millions of rows share
    travels once a task. A unique key counts once if several rows hold it; a
    reference without a parent counts with its rows."""
    entries: dict[str, list] = {t: [] for t in tables}
    rules = []
    for rule, t, columns, where in unique:
        if t in tables:
            key = _key_text(columns)
            entries[t].append((len(rules), key if where is None else F.when(F.expr(where), key), False))
            rules.append((len(rules), rule, t, True))
    for rule, t, columns, parent, parent_columns in foreign:
        if t in tables and parent in tables:
            entries[t].append((len(rules), _key_text(columns), False))
            entries[parent].append((len(rules), _key_text(parent_columns), True))
            rules.append((len(rules), rule, t, False))
    parts = []
    for t, held in entries.items():
        if held:
            each = F.array(*[F.struct(F.lit(i).alias("id"), key.alias("key"), F.lit(0 if parent else 1).alias("child"),
                                      F.lit(1 if parent else 0).alias("parent")) for i, key, parent in held])
            parts.append(tables[t].select(F.inline(each)).filter("key is not null"))
    keys = union_all(parts).groupBy("id", "key").agg(F.sum("child").alias("rows"), F.max("parent").alias("parent"))
    spark = keys.sparkSession
    names = spark.createDataFrame(rules, "id int, rule string, table_name string, is_unique boolean")
    counts = keys.groupBy("id").agg(F.count_if(F.col("rows") > 1).alias("repeated"),
                                    F.sum(F.when(F.col("parent") == 0, F.col("rows")).otherwise(0)).alias("orphans"))
    bad = F.when(F.col("is_unique"), F.col("repeated")).otherwise(F.col("orphans"))
    return names.join(counts, "id", "left").select("rule", "table_name", F.coalesce(bad, F.lit(0)).cast("bigint").alias("bad_count"))


def duplicate_keys(df: DataFrame, keys: list[str], where: str | None = None) -> DataFrame:
    """Keys that occur more than once (GROUP BY .. HAVING count > 1).
    ``where`` makes it a partial unique index (e.g. ``is_current``)."""
    d = df if where is None else df.filter(F.expr(where))
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str]) -> DataFrame:
    """Child rows whose non-NULL reference has no parent (left anti)."""
    c = child
    for k in child_keys:
        c = c.filter(F.col(k).isNotNull())
    cond = None
    for a, b in zip(child_keys, parent_keys):
        e = c[a] == parent[b]
        cond = e if cond is None else cond & e
    return c.join(parent.select(*parent_keys), cond, "left_anti")


def count_rows(name: str, df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("bad_count")).select(
        F.lit(name).alias("rule"), F.lit(table).alias("table_name"), "bad_count")


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rowcount_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as one UNION ALL."""
    return union_all([df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])
