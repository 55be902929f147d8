"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
whole input tables. Column names match the oracle SQL exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.operators import alerts as A
from aerolith.operators import dims, facts, scd2, reads
from aerolith.operators import features as FT
from aerolith.operators import forecast as FC
from aerolith.operators import ml as ML
from aerolith.operators import quality as QL
from aerolith.operators import reports as R
from aerolith.operators import runs as RN
from aerolith.operators.filters import all_option, day_range
from aerolith.plans import checks
from aerolith.plans import load as PL
from aerolith.plans import scenarios as SC
from aerolith.plans.oracle import ALERTS, FIRST_LOAD, LOC_HIST, SEN_HIST, q
from aerolith.session import scratch_path
from aerolith.sources import bronze as B
from aerolith.sources import seeds as SD
from aerolith.sources.driver_tables import core
from aerolith.streaming import jobs as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = q(sql)
        return fn
    return deco


# --- Q1-Q8 read models ----------------------------------------------------

@register("locations_summary", """
, latest AS (SELECT sensor_id, max(measured_at) AS latest_at FROM m GROUP BY sensor_id)
SELECT l.location_id, l.openaq_location_id, l.name, l.city, l.country,
       CAST(l.latitude AS DOUBLE) AS latitude, CAST(l.longitude AS DOUBLE) AS longitude, l.timezone,
       count(DISTINCT s.sensor_id) FILTER (WHERE s.is_active) AS active_sensor_count,
       max(lt.latest_at) AS latest_measurement_at
FROM location l
LEFT JOIN sensor s ON s.location_id = l.location_id
LEFT JOIN latest lt ON lt.sensor_id = s.sensor_id
WHERE l.is_active
GROUP BY l.location_id, l.openaq_location_id, l.name, l.city, l.country, l.latitude, l.longitude, l.timezone
ORDER BY l.city, l.name, l.location_id
""")
def _locations_summary(spark, sf):
    return reads.locations_summary(core(spark, sf))


@register("measurements_filtered", """
SELECT measurement_id, measured_at, CAST(value AS DOUBLE) AS value, unit, city, location_name,
       parameter_code, parameter_name, sensor_id, ingestion_run_id
FROM readings
WHERE parameter_code = 'view'
  AND measured_at >= TIMESTAMP '2024-01-05 00:00:00' AND measured_at <= TIMESTAMP '2024-01-20 12:00:00'
ORDER BY measured_at DESC, measurement_id DESC
LIMIT 200
""")
def _measurements_filtered(spark, sf):
    return reads.measurements_list(core(spark, sf), parameter="view",
                                   date_from="2024-01-05 00:00:00", date_to="2024-01-20 12:00:00",
                                   limit=200)


@register("hourly_series", """
SELECT date_trunc('hour', measured_at) AS measured_hour, city, parameter_code, unit,
       CAST(CAST(((2 * sum(CAST(round(value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(value), 0)) // (2 * NULLIF(count(value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS average_value, count(*) AS measurement_count
FROM readings
GROUP BY 1, 2, 3, 4
ORDER BY measured_hour DESC, city, parameter_code, unit
LIMIT 10000
""")
def _hourly_series(spark, sf):
    return reads.hourly_series(core(spark, sf))


@register("thresholds_list", """
SELECT r.threshold_rule_id, r.parameter_id, p.code AS parameter_code, p.display_name AS parameter_name,
       r.city, r.warning_level, CAST(r.min_value AS DOUBLE) AS min_value, r.is_active, r.updated_at
FROM threshold_rule r JOIN parameter p ON p.parameter_id = r.parameter_id
ORDER BY r.city, parameter_code, min_value, r.threshold_rule_id
""")
def _thresholds_list(spark, sf):
    return reads.thresholds_list(core(spark, sf))


@register("station_series", """
SELECT measured_at, city, location_name, parameter_code, CAST(value AS DOUBLE) AS value, unit, sensor_id
FROM readings
WHERE city = 'NATION_7'
ORDER BY city, location_name, parameter_code, measured_at, sensor_id
""")
def _station_series(spark, sf):
    return reads.station_series(core(spark, sf), city="NATION_7")


# --- warehouse: dims, SCD2, facts ------------------------------------------


def first_load_fact(c):
    """E7 computed in the plan (used by the queries that test the load itself)."""
    return facts.load_measurement_facts(c, SC.dim_location_first_load(c), SC.dim_sensor_first_load(c))


def published_fact(c):
    """The reading fact as published by the session's warehouse load."""
    return SC.published(c, "fact_measurement")


FACT_COLS = ["source_measurement_id", "source_location_id", "source_sensor_id", "parameter_code", "parameter_key", "date_key",
             "time_key", "risk_class_key", "measured_at", "measurement_value", "unit", "ingestion_run_id"]


@register("calendar_profile", FIRST_LOAD + """
, dd AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
                CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
                strftime(d, '%A') AS day_name, CAST(isodow(d) AS INTEGER) AS weekday,
                isodow(d) IN (6, 7) AS is_weekend
         FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY) t(d))
SELECT dd.year, dd.quarter, dd.month, dd.weekday, dd.day_name, dd.is_weekend,
       count(*) AS readings, count(DISTINCT f.date_key) AS days,
       CAST(CAST(((2 * sum(CAST(round(f.measurement_value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(f.measurement_value), 0)) // (2 * NULLIF(count(f.measurement_value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS mean_value
FROM fact_m f JOIN dd ON dd.date_key = f.date_key
GROUP BY ALL
""")
def _calendar_profile(spark, sf):
    """E1 dim_date joined to the reading fact (1096-row dim: broadcast is bounded)."""
    c = core(spark, sf)
    f = published_fact(c)
    dd = dims.dim_date(spark)
    return f.join(F.broadcast(dd), "date_key").groupBy(
        "year", "quarter", "month", "weekday", "day_name", "is_weekend").agg(
        F.count(F.lit(1)).alias("readings"), F.countDistinct("date_key").alias("days"),
        S.exact_mean("measurement_value").alias("mean_value"))


@register("part_of_day_profile", FIRST_LOAD + """
, dt AS (SELECT CAST(h * 100 + mi AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour,
                CASE WHEN h BETWEEN 0 AND 5 THEN 'night' WHEN h BETWEEN 6 AND 11 THEN 'morning'
                     WHEN h BETWEEN 12 AND 17 THEN 'afternoon' ELSE 'evening' END AS part_of_day
         FROM range(0, 24) a(h), range(0, 60) b(mi))
SELECT dt.part_of_day, f.parameter_code, count(*) AS readings,
       count(DISTINCT dt.hour) AS hours, CAST(CAST(((2 * sum(CAST(round(f.measurement_value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(f.measurement_value), 0)) // (2 * NULLIF(count(f.measurement_value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS mean_value,
       max(f.measurement_value) AS max_value
FROM fact_m f JOIN dt ON dt.time_key = f.time_key
GROUP BY ALL
""")
def _part_of_day_profile(spark, sf):
    """E2 dim_time joined to the reading fact."""
    c = core(spark, sf)
    f = published_fact(c)
    dt_ = dims.dim_time(spark)
    return f.join(F.broadcast(dt_), "time_key").groupBy("part_of_day", "parameter_code").agg(
        F.count(F.lit(1)).alias("readings"), F.countDistinct("hour").alias("hours"),
        S.exact_mean("measurement_value").alias("mean_value"), F.max("measurement_value").alias("max_value"))


@register("risk_share", FIRST_LOAD + """
, rc AS (SELECT * FROM (VALUES (1, 'low', 'Low'), (2, 'moderate', 'Moderate'), (3, 'high', 'High'),
                                (4, 'critical', 'Critical')) v(risk_class_key, code, label))
SELECT rc.code, rc.label, count(*) AS readings,
       count(*) / sum(count(*)) OVER () AS share
FROM fact_m f JOIN rc ON rc.risk_class_key = f.risk_class_key
GROUP BY rc.code, rc.label
""")
def _risk_share(spark, sf):
    """E3 dim_risk_class + A25: share of readings per risk class."""
    c = core(spark, sf)
    f = published_fact(c)
    rc = dims.dim_risk_class(spark).select("risk_class_key", "code", "label")
    per = f.groupBy("risk_class_key").agg(F.count(F.lit(1)).alias("readings"))
    # the share's denominator is a window over the (at most four) class rows
    return per.join(F.broadcast(rc), "risk_class_key").select(
        "code", "label", "readings",
        (F.col("readings") / F.sum("readings").over(Window.partitionBy())).alias("share"))


@register("dim_parameter_upsert", """
, src AS (SELECT *, parameter_id % 4 <> 1 AS is_active FROM parameter)
, cur AS (SELECT parameter_id * 10 AS parameter_key, code FROM parameter WHERE parameter_id % 2 = 0
          UNION ALL SELECT 7, 'retired')
, fresh AS (SELECT code, (SELECT max(parameter_key) FROM cur) + row_number() OVER (ORDER BY code) AS k
            FROM src WHERE code NOT IN (SELECT code FROM cur))
SELECT CAST(COALESCE(c.parameter_key, f.k) AS INTEGER) AS parameter_key, p.code,
       p.parameter_id AS source_parameter_id, p.display_name, p.preferred_unit, p.is_active
FROM src p LEFT JOIN cur c ON c.code = p.code LEFT JOIN fresh f ON f.code = p.code
UNION ALL SELECT 7, 'retired', 99, 'RETIRED', 'ppm', true
""")
def _dim_parameter_upsert(spark, sf):
    """SCD1 upsert of the parameter dimension over a stale snapshot with
    keys of its own and a code that the source no longer has."""
    c = core(spark, sf)
    source = c.parameter.withColumn("is_active", F.col("parameter_id") % 4 != 1)
    stale = dims.dim_parameter(c.parameter).filter("source_parameter_id % 2 = 0").select(
        "code", (F.col("source_parameter_id") * 10).alias("parameter_key"), "source_parameter_id",
        F.lower("code").alias("display_name"), F.lit("ppm").alias("preferred_unit"), F.lit(True).alias("is_active"))
    gone = spark.range(1).select(F.lit("retired").alias("code"), F.lit(7).alias("parameter_key"), F.lit(99).alias("source_parameter_id"),
                                 F.lit("RETIRED").alias("display_name"), F.lit("ppm").alias("preferred_unit"), F.lit(True).alias("is_active"))
    return dims.dim_parameter_upsert(source, stale.unionByName(gone)) \
        .select("parameter_key", "code", "source_parameter_id", "display_name", "preferred_unit", "is_active")


@register("dim_publish", FIRST_LOAD + """
, changed AS (SELECT location_id FROM cur_loc WHERE location_id % 97 = 3)
, old AS (SELECT l.*, COALESCE(first_seen_at, TIMESTAMP '2024-01-01 00:00:00') AS valid_from,
                 location_id IN (SELECT location_id FROM changed) AS ch FROM cur_loc l)
, versions AS (
  SELECT location_id, name, valid_from, CASE WHEN ch THEN TIMESTAMP '2024-01-15 00:00:00' END AS valid_to, NOT ch AS is_current FROM old
  UNION ALL SELECT location_id, name || ' (renamed)', TIMESTAMP '2024-01-15 00:00:00', NULL, true FROM old WHERE ch)
SELECT location_id AS source_location_id, name, valid_from, valid_to, is_current,
       location_id % 64 IN (SELECT location_id % 64 FROM changed) AS rewritten
FROM versions
""")
def _dim_publish(spark, sf):
    """A second load after few locations changed writes only their buckets."""
    c = core(spark, sf)
    root = scratch_path(spark, "warehouse", uuid.uuid4().hex[:12])
    PL.run_etl(spark, c, root, SC.stored_alerts(c), SC.AS_OF_1)
    first = PL.read_manifest(spark, root)["dims"]["dim_location"]
    PL.run_etl(spark, SC.Renamed(c), root, SC.stored_alerts(c), SC.AS_OF_2)
    second = PL.read_manifest(spark, root)["dims"]["dim_location"]
    rewritten = [int(b) for b, path in second.items() if first.get(b) != path]
    return PL.table(spark, root, "dim_location").select("source_location_id", "name", "valid_from", "valid_to", "is_current",
                                                        PL.bucket_of("source_location_id").isin(rewritten).alias("rewritten"))


@register("fact_surrogates", FIRST_LOAD + """
SELECT f.source_measurement_id, f.source_location_id, f.source_sensor_id, f.parameter_code,
       COALESCE(l.first_seen_at, TIMESTAMP '2024-01-01 00:00:00') AS location_valid_from, l.city,
       COALESCE(s.first_seen_at, TIMESTAMP '2024-01-01 00:00:00') AS sensor_valid_from, s.unit AS sensor_unit,
       p.display_name AS parameter_name, CAST(f.measured_at AS DATE) AS full_date,
       CAST(hour(f.measured_at) AS INTEGER) AS hour, CAST(minute(f.measured_at) AS INTEGER) AS minute,
       CASE f.risk_class_key WHEN 1 THEN 'low' WHEN 2 THEN 'moderate' WHEN 3 THEN 'high' WHEN 4 THEN 'critical' END AS risk_code
FROM fact_m f JOIN cur_loc l ON l.location_id = f.source_location_id JOIN cur_sen s ON s.sensor_id = f.source_sensor_id
JOIN parameter p ON p.code = f.parameter_code
""")
def _fact_surrogates(spark, sf):
    """Every reading fact through each of its six keys."""
    c = core(spark, sf)
    loc = scd2.with_surrogate(SC.published(c, "dim_location"), "source_location_id", "location_key") \
        .select("location_key", F.col("valid_from").alias("location_valid_from"), "city")
    sen = scd2.with_surrogate(SC.published(c, "dim_sensor"), "source_sensor_id", "sensor_key") \
        .select("sensor_key", F.col("valid_from").alias("sensor_valid_from"), F.col("unit").alias("sensor_unit"))
    par = SC.published(c, "dim_parameter").select("parameter_key", F.col("display_name").alias("parameter_name"))
    f = published_fact(c).join(loc, "location_key").join(sen, "sensor_key").join(par, "parameter_key")
    f = f.join(dims.dim_date(spark).select("date_key", "full_date"), "date_key") \
        .join(dims.dim_time(spark).select("time_key", "hour", "minute"), "time_key") \
        .join(dims.dim_risk_class(spark).select("risk_class_key", F.col("code").alias("risk_code")), "risk_class_key", "left")
    return f.select("source_measurement_id", "source_location_id", "source_sensor_id", "parameter_code", "location_valid_from", "city",
                    "sensor_valid_from", "sensor_unit", "parameter_name", "full_date", "hour", "minute", "risk_code")


LOC_COLS = ["source_location_id", "openaq_location_id", "name", "city", "country", "latitude", "longitude",
            "valid_from", "valid_to", "is_current", "row_hash"]


@register("scd2_location", LOC_HIST + """
SELECT source_location_id, openaq_location_id, name, city, country,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       valid_from, valid_to, is_current, row_hash
FROM dim_loc2
""")
def _scd2_location(spark, sf):
    """E5: two SCD2 syncs (first load, then renamed/relocated/new sources)."""
    d = SC.dim_location_history(core(spark, sf))
    return d.select(*[F.col(x).cast("double").alias(x) if x in ("latitude", "longitude") else x
                      for x in LOC_COLS])


@register("scd2_sensor", SEN_HIST + """
SELECT source_sensor_id, openaq_sensor_id, location_id, parameter_id, unit, valid_from, valid_to,
       is_current, row_hash
FROM dim_sen2
""")
def _scd2_sensor(spark, sf):
    """Sensor SCD2 with a unit change."""
    d = SC.dim_sensor_history(core(spark, sf))
    return d.select("source_sensor_id", "openaq_sensor_id", "location_id", "parameter_id", "unit",
                    "valid_from", "valid_to", "is_current", "row_hash")


@register("scd2_point_in_time", LOC_HIST + """
SELECT r.measurement_id, r.measured_at, d.source_location_id, d.name AS location_name, d.city,
       d.valid_from, d.is_current
FROM readings r JOIN dim_loc2 d
  ON d.source_location_id = r.location_id AND r.measured_at >= d.valid_from
 AND (d.valid_to IS NULL OR r.measured_at < d.valid_to)
""")
def _scd2_point_in_time(spark, sf):
    """Each reading joined to the location version valid at its time."""
    c = core(spark, sf)
    d = SC.dim_location_history(c)
    r = reads.readings(c).select("measurement_id", "measured_at", "location_id")
    j = scd2.as_of_join(r, d, "location_id", "source_location_id", "measured_at")
    return j.select("measurement_id", "measured_at", "source_location_id", F.col("name").alias("location_name"),
                    "city", "valid_from", "is_current")


@register("fact_measurement", FIRST_LOAD + """
SELECT * FROM fact_m
""")
def _fact_measurement(spark, sf):
    """E7 first load (P4 filter, J3 current dims, J4 risk band, F6/F7 keys)."""
    return first_load_fact(core(spark, sf)).select(*FACT_COLS)


@register("fact_measurement_incremental", FIRST_LOAD + """
SELECT * FROM fact_m WHERE measured_at >= TIMESTAMP '2024-01-15 00:00:00'
""")
def _fact_measurement_incremental(spark, sf):
    """Second run of E7 inserts only readings not yet in the fact."""
    c = core(spark, sf)
    dl, ds = SC.dim_location_first_load(c), SC.dim_sensor_first_load(c)
    first = facts.load_measurement_facts(c, dl, ds).filter(
        F.col("measured_at") < F.lit(SC.INCREMENTAL_CUT).cast("timestamp_ntz"))
    return facts.load_measurement_facts(c, dl, ds, existing=first).select(*FACT_COLS)


@register("fact_measurement_late", FIRST_LOAD + """
SELECT * FROM fact_m
""")
def _fact_measurement_late(spark, sf):
    """A load of early runs without every third reading, then an
    incremental one that finds the late readings of old runs and all new runs;
    together each reading once."""
    c = core(spark, sf)
    dl, ds = SC.dim_location_first_load(c), SC.dim_sensor_first_load(c)
    first = facts.load_measurement_facts(c, dl, ds).filter(
        (F.col("measured_at") < F.lit(SC.INCREMENTAL_CUT).cast("timestamp_ntz"))
        & (F.col("source_measurement_id") % 3 != 0))
    first = first.checkpoint()
    late = facts.load_measurement_facts(c, dl, ds, existing=first, incremental=True)
    return first.unionByName(late).select(*FACT_COLS)


@register("fact_purge_negative", """
SELECT c_custkey AS source_measurement_id, c_acctbal AS measurement_value,
       c_acctbal >= 0 AND c_acctbal < 100000 AS passes_quality
FROM customer WHERE c_acctbal IS NULL OR c_acctbal >= 0
""")
def _fact_purge_negative(spark, sf):
    """P5 (and P4 flag): account balances loaded as readings, negatives purged."""
    c = core(spark, sf)
    raw = c.raw("customer").select(F.col("c_custkey").alias("source_measurement_id"),
                                   F.col("c_acctbal").alias("measurement_value"))
    kept = facts.purge_negative(raw)
    return kept.withColumn("passes_quality", (F.col("measurement_value") >= 0) &
                           (F.col("measurement_value") < S.VALUE_OPEN_MAX))


# --- alerts ----------------------------------------------------------------

ALERT_COLS = ["pollution_alert_id", "measurement_id", "measurement_measured_at", "threshold_rule_id",
              "alert_level", "status", "generated_at", "reviewed_at", "notes"]


@register("alert_generation", ALERTS + """
SELECT * FROM alerts
""")
def _alert_generation(spark, sf):
    """One alert per reading for the best matching active rule."""
    return A.alerts(core(spark, sf)).select(*ALERT_COLS)


@register("alert_review", ALERTS + """
SELECT pollution_alert_id, status, reviewed_at, notes, alert_level, generated_at FROM reviewed
""")
def _alert_review(spark, sf):
    """Review commands applied to the alert table."""
    return SC.reviewed_alerts(core(spark, sf)).select(
        "pollution_alert_id", "status", "reviewed_at", "notes", "alert_level", "generated_at")


OUTBOX_SQL = ALERTS + """
, outbox AS (
  SELECT pollution_alert_id, measurement_id, measurement_measured_at, threshold_rule_id,
         'created' AS event_type, CAST(NULL AS VARCHAR) AS previous_status, status AS current_status,
         json_object('alert_level', alert_level,
                     'generated_at', strftime(generated_at, '%Y-%m-%dT%H:%M:%S.%f'),
                     'reviewed_at', strftime(reviewed_at, '%Y-%m-%dT%H:%M:%S.%f'),
                     'notes', notes)::VARCHAR AS payload,
         COALESCE(reviewed_at, generated_at) AS created_at
  FROM alerts
  UNION ALL
  SELECT r.pollution_alert_id, r.measurement_id, r.measurement_measured_at, r.threshold_rule_id,
         'status_changed', a.status, r.status,
         json_object('alert_level', r.alert_level,
                     'generated_at', strftime(r.generated_at, '%Y-%m-%dT%H:%M:%S.%f'),
                     'reviewed_at', strftime(r.reviewed_at, '%Y-%m-%dT%H:%M:%S.%f'),
                     'notes', r.notes)::VARCHAR,
         COALESCE(r.reviewed_at, r.generated_at)
  FROM reviewed r JOIN alerts a ON a.pollution_alert_id = r.pollution_alert_id
  WHERE r.status IS DISTINCT FROM a.status)
"""


@register("outbox_events", OUTBOX_SQL + """
SELECT pollution_alert_id, measurement_id, measurement_measured_at, threshold_rule_id, event_type,
       previous_status, current_status, payload, created_at
FROM outbox
""")
def _outbox_events(spark, sf):
    """T5: 'created' per new alert, 'status_changed' per real status change."""
    return SC.outbox(core(spark, sf)).drop("processed_at")


@register("outbox_pending", OUTBOX_SQL + """
SELECT pollution_alert_id, event_type, current_status, created_at
FROM outbox
""")
def _outbox_pending(spark, sf):
    """All unprocessed outbox events, oldest first."""
    return A.pending_outbox(SC.outbox(core(spark, sf))).select(
        "pollution_alert_id", "event_type", "current_status", "created_at")


FACT_ALERT_SQL = ALERTS + """
, fact_a AS (
SELECT a.pollution_alert_id AS source_alert_id, l.location_id AS source_location_id, p.code AS parameter_code, p.parameter_id AS parameter_key,
       CAST(CASE a.alert_level WHEN 'low' THEN 1 WHEN 'moderate' THEN 2 WHEN 'high' THEN 3
                               WHEN 'critical' THEN 4 END AS INTEGER) AS risk_class_key,
       CAST(strftime(a.generated_at, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(a.generated_at) * 100 + minute(a.generated_at) AS INTEGER) AS time_key,
       a.alert_level, a.status AS alert_status, CAST(m.value AS DOUBLE) AS measurement_value, a.generated_at
FROM alerts a
JOIN m ON m.measurement_id = a.measurement_id AND m.measured_at = a.measurement_measured_at
JOIN sensor s ON s.sensor_id = m.sensor_id
JOIN location l ON l.location_id = s.location_id AND l.is_active
JOIN parameter p ON p.parameter_id = s.parameter_id)
"""


@register("fact_alert", FACT_ALERT_SQL + "SELECT * FROM fact_a")
def _fact_alert(spark, sf):
    """Alert facts on the current location version."""
    c = core(spark, sf)
    f = facts.load_alert_facts(c, SC.stored_alerts(c), SC.dim_location_first_load(c))
    return f.drop("location_key")


@register("alerts_list", ALERTS + """
SELECT a.pollution_alert_id, a.generated_at, a.alert_level, a.status,
       CAST(r.value AS DOUBLE) AS measurement_value, r.unit AS measurement_unit, r.measured_at,
       r.city, r.location_name, r.parameter_code, r.parameter_name,
       CAST(t.min_value AS DOUBLE) AS threshold_value, a.reviewed_at, a.notes
FROM reviewed a
JOIN readings r ON r.measurement_id = a.measurement_id AND r.measured_at = a.measurement_measured_at
JOIN threshold_rule t ON t.threshold_rule_id = a.threshold_rule_id
ORDER BY a.generated_at DESC, a.pollution_alert_id DESC
LIMIT 200
""")
def _alerts_list(spark, sf):
    """Q4: newest 200 alerts with reading, rule, place and parameter."""
    c = core(spark, sf)
    return reads.alerts_list(c, SC.reviewed_alerts(c), limit=200)


# --- runs, reports, gaps ---------------------------------------------------


RUNS_SQL = """
, run_day AS (SELECT ingestion_run_id, count(*) AS n, min(measured_at) AS started_at,
                     max(measured_at) AS finished_at, ingestion_run_id % 100 AS d
              FROM m GROUP BY ingestion_run_id)
, runs AS (
  SELECT ingestion_run_id, 'incremental' AS run_type,
         CASE WHEN d % 4 = 3 THEN 'failed' WHEN d % 4 = 2 THEN 'partial' ELSE 'succeeded' END AS status,
         started_at, finished_at,
         CAST(CASE WHEN d % 4 = 3 THEN 0 WHEN d % 4 = 2 THEN n - (n % 5 + 1) ELSE n END AS INTEGER)
             AS records_inserted,
         CAST(CASE WHEN d % 4 = 3 THEN 1 WHEN d % 4 = 2 THEN n % 5 + 1 ELSE 0 END AS INTEGER) AS records_failed,
         CASE WHEN d % 4 = 3 THEN 'run failed'
              WHEN d % 4 = 2 THEN 'measurement skipped: ' || CAST(n % 5 + 1 AS VARCHAR) || ' invalid' END
             AS error_message
  FROM run_day)
"""


def _runs(c):
    return RN.fold_runs(RN.run_events_from_readings(c.measurement))


@register("run_status_rollup", RUNS_SQL + "SELECT * FROM runs")
def _run_status_rollup(spark, sf):
    """Open + close events folded to one row per run."""
    return _runs(core(spark, sf)).select(*RN.RUN_COLS)


@register("runs_list", RUNS_SQL + """
SELECT * FROM runs ORDER BY started_at DESC, ingestion_run_id DESC LIMIT 50
""")
def _runs_list(spark, sf):
    """Q6/L4."""
    return RN.runs_list(_runs(core(spark, sf)), limit=50)


@register("run_kpis", RUNS_SQL + """
SELECT count(*) AS runs, count(*) FILTER (WHERE status IN ('failed', 'partial')) AS failed_or_partial,
       CAST(sum(records_inserted) AS BIGINT) AS rows_inserted, CAST(sum(records_failed) AS BIGINT) AS rows_failed
FROM runs
""")
def _run_kpis(spark, sf):
    """A16."""
    return RN.run_kpis(_runs(core(spark, sf)))


@register("run_status_counts", RUNS_SQL + """
SELECT status, count(*) AS runs FROM runs GROUP BY status
""")
def _run_status_counts(spark, sf):
    """A17."""
    return RN.run_status_counts(_runs(core(spark, sf)))


@register("watermark_bound", RUNS_SQL + """
, hw AS (SELECT max(measured_at) AS high_water_mark FROM m)
, ls AS (SELECT max(COALESCE(finished_at, started_at)) AS last_success_at FROM runs WHERE status = 'succeeded')
SELECT hw.high_water_mark, ls.last_success_at,
       COALESCE(hw.high_water_mark - INTERVAL 12 HOUR, ls.last_success_at,
                TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1 DAY) AS lower_bound
FROM hw, ls
""")
def _watermark_bound(spark, sf):
    """Incremental lower bound = high-water mark minus 12 h overlap."""
    c = core(spark, sf)
    return RN.lower_bound(c.measurement, _runs(c), now="2024-02-01 00:00:00")


@register("watermark_bound_branches", RUNS_SQL + """
, hw AS (SELECT max(measured_at) AS high_water_mark FROM m)
, ls AS (SELECT max(COALESCE(finished_at, started_at)) AS last_success_at FROM runs WHERE status = 'succeeded')
SELECT 'readings' AS branch, high_water_mark - INTERVAL 12 HOUR AS lower_bound FROM hw
UNION ALL SELECT 'last success', last_success_at FROM ls
UNION ALL SELECT 'neither', TIMESTAMP '2024-01-31 00:00:00'
UNION ALL SELECT 'initial', TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 180 DAY
""")
def _watermark_bound_branches(spark, sf):
    """What the bound is with readings, with successful runs only, with
    failed ones only, and for an initial load."""
    c = core(spark, sf)
    runs, none = _runs(c), c.measurement.filter("measurement_id < 0")
    cases = {"readings": (c.measurement, runs, True), "last success": (none, runs, True),
             "neither": (none, runs.filter("status <> 'succeeded'"), True), "initial": (c.measurement, runs, False)}
    return QL.union_all([RN.lower_bound(m, r, now="2024-02-01 00:00:00", incremental=i).select(F.lit(k).alias("branch"), "lower_bound")
                         for k, (m, r, i) in cases.items()])


HOURLY_FULL = """
, hourly AS (SELECT date_trunc('hour', measured_at) AS measured_hour, city, parameter_code, unit,
                    ((2 * sum(CAST(round(value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(value), 0)) // (2 * NULLIF(count(value), 0))) AS avg_units8, count(*) AS measurement_count
             FROM readings GROUP BY ALL)
"""


@register("daily_mean", HOURLY_FULL + """
SELECT CAST(measured_hour AS DATE) AS day, parameter_code, CAST(CAST(((2 * sum(CAST(avg_units8 AS HUGEINT)) * 10000 + NULLIF(count(avg_units8), 0)) // (2 * NULLIF(count(avg_units8), 0))) AS VARCHAR) || 'e-12' AS DOUBLE) AS daily_mean,
       CAST(sum(measurement_count) AS BIGINT) AS measurement_count
FROM hourly GROUP BY ALL
""")
def _daily_mean(spark, sf):
    """Unweighted mean of hourly means per day and parameter."""
    return R.daily_mean(reads.hourly_series(core(spark, sf), limit=None, decimal_mean=True))


@register("hourly_mean", HOURLY_FULL + """
SELECT measured_hour, city, parameter_code, CAST(CAST(((2 * sum(CAST(avg_units8 AS HUGEINT)) * 10000 + NULLIF(count(avg_units8), 0)) // (2 * NULLIF(count(avg_units8), 0))) AS VARCHAR) || 'e-12' AS DOUBLE) AS average_value,
       CAST(sum(measurement_count) AS BIGINT) AS measurement_count
FROM hourly GROUP BY ALL
""")
def _hourly_mean(spark, sf):
    """A7."""
    return R.hourly_mean(reads.hourly_series(core(spark, sf), limit=None, decimal_mean=True))


@register("daily_actuals", """
, st AS (SELECT parameter_code, count(DISTINCT location_name) AS stations FROM readings GROUP BY 1)
, d AS (SELECT CAST(measured_at AS DATE) AS day, parameter_code, CAST(CAST(((2 * sum(CAST(round(value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(value), 0)) // (2 * NULLIF(count(value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS daily_actual
        FROM readings GROUP BY 1, 2)
SELECT d.day, d.parameter_code, d.daily_actual, st.stations, st.stations > 3 AS use_daily_mean
FROM d JOIN st ON st.parameter_code = d.parameter_code
""")
def _daily_actuals(spark, sf):
    """A8."""
    return R.daily_actuals(reads.readings(core(spark, sf)))


@register("overview_kpis", ALERTS + """
SELECT arg_max(CAST(value AS DOUBLE), (measured_at, measurement_id)) AS latest_value,
       CAST(CAST(((2 * sum(CAST(round(CASE WHEN measured_at >= (SELECT max(measured_at) FROM readings) - INTERVAL 7 DAY THEN value END * 10000) AS HUGEINT)) * 10000 + NULLIF(count(CASE WHEN measured_at >= (SELECT max(measured_at) FROM readings) - INTERVAL 7 DAY THEN value END), 0)) // (2 * NULLIF(count(CASE WHEN measured_at >= (SELECT max(measured_at) FROM readings) - INTERVAL 7 DAY THEN value END), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS mean_last_days,
       count(DISTINCT location_name) AS stations,
       (SELECT count(*) FROM reviewed WHERE status = 'open') AS open_alerts
FROM readings
""")
def _overview_kpis(spark, sf):
    """A14."""
    c = core(spark, sf)
    return R.overview_kpis(reads.readings(c), SC.reviewed_alerts(c))


@register("home_kpis", ALERTS + """
SELECT (SELECT count(*) FROM location WHERE is_active) AS stations,
       CAST(count(*) AS BIGINT) AS recent_readings,
       (SELECT count(*) FROM reviewed WHERE status = 'open') AS open_alerts
FROM readings
""")
def _home_kpis(spark, sf):
    """Active stations, readings, open alerts."""
    c = core(spark, sf)
    return R.home_kpis(reads.readings(c), SC.reviewed_alerts(c), c.location)


LATEST_SQL = """
, latest AS (
  SELECT city, location_name, parameter_code,
         arg_max(measured_at, (measured_at, measurement_id)) AS measured_at,
         arg_max(CAST(value AS DOUBLE), (measured_at, measurement_id)) AS value,
         arg_max(measurement_id, (measured_at, measurement_id)) AS measurement_id
  FROM readings GROUP BY ALL)
"""


@register("latest_by_station", LATEST_SQL + "SELECT * FROM latest")
def _latest_by_station(spark, sf):
    """W6."""
    return R.latest_by_station(reads.readings(core(spark, sf)))


@register("worst_reading", """
SELECT city, location_name, parameter_code, CAST(value AS DOUBLE) AS value, unit, measured_at FROM readings
ORDER BY value DESC, measured_at DESC, measurement_id DESC LIMIT 1
""")
def _worst_reading(spark, sf):
    """The highest of all readings."""
    r = reads.readings(core(spark, sf))
    return r.orderBy(F.desc("value"), F.desc("measured_at"), F.desc("measurement_id")).limit(1).select(
        "city", "location_name", "parameter_code", F.col("value").cast("double").alias("value"), "unit", "measured_at")


@register("worst_station", LATEST_SQL + """
SELECT * FROM latest ORDER BY value DESC, city, location_name, parameter_code LIMIT 1
""")
def _worst_station(spark, sf):
    """Top-1 station by latest value."""
    return R.worst_station(R.latest_by_station(reads.readings(core(spark, sf))))


@register("records_per_day", """
SELECT CAST(measured_at AS DATE) AS day, count(*) AS records FROM m GROUP BY 1
""")
def _records_per_day(spark, sf):
    """A15."""
    return R.records_per_day(core(spark, sf).measurement)


@register("date_bounds", ALERTS + RUNS_SQL + """
, u AS (SELECT CAST(measured_at AS DATE) AS d FROM m
        UNION ALL SELECT CAST(generated_at AS DATE) FROM alerts
        UNION ALL SELECT CAST(started_at AS DATE) FROM runs)
SELECT min(d) AS min_date, max(d) AS max_date FROM u
""")
def _date_bounds(spark, sf):
    """Bounds across readings, alerts and runs."""
    c = core(spark, sf)
    return R.date_bounds({"readings": (c.measurement, "measured_at"),
                          "alerts": (SC.stored_alerts(c), "generated_at"),
                          "runs": (_runs(c), "started_at")})


@register("city_options", """
SELECT DISTINCT city FROM readings WHERE city IS NOT NULL ORDER BY city
""")
def _city_options(spark, sf):
    """Sorted distinct cities that have readings."""
    return R.options(reads.readings(core(spark, sf)), "city")


ALERTS_ENRICHED = ALERTS + """
, ae AS (SELECT a.pollution_alert_id, a.generated_at, a.alert_level, a.status, r.city, r.location_name,
                r.parameter_code
         FROM reviewed a JOIN readings r ON r.measurement_id = a.measurement_id
                                        AND r.measured_at = a.measurement_measured_at)
"""


def _alerts_enriched(c):
    a = SC.reviewed_alerts(c)
    r = reads.readings(c).select("measurement_id", F.col("measured_at").alias("measurement_measured_at"),
                                 "city", "location_name", "parameter_code")
    return a.join(r, ["measurement_id", "measurement_measured_at"])


@register("alert_heatmap", ALERTS_ENRICHED + """
SELECT CAST(isodow(generated_at) AS INTEGER) AS weekday_index, strftime(generated_at, '%A') AS weekday,
""" + ",\n".join(f"       count(*) FILTER (WHERE hour(generated_at) = {h}) AS h{h:02d}" for h in range(24)) + """
FROM ae GROUP BY 1, 2
""")
def _alert_heatmap(spark, sf):
    """A9."""
    return R.alert_heatmap(_alerts_enriched(core(spark, sf)))


@register("alert_severity", ALERTS_ENRICHED + """
SELECT alert_level, count(*) AS alerts FROM ae GROUP BY 1 ORDER BY alerts DESC, alert_level
""")
def _alert_severity(spark, sf):
    """A10."""
    return R.value_counts(_alerts_enriched(core(spark, sf)), "alert_level")


@register("alert_by_pollutant", ALERTS_ENRICHED + """
SELECT parameter_code, count(*) AS alerts FROM ae GROUP BY 1 ORDER BY alerts DESC, parameter_code
""")
def _alert_by_pollutant(spark, sf):
    """A11."""
    return R.value_counts(_alerts_enriched(core(spark, sf)), "parameter_code")


@register("alert_top_stations", ALERTS_ENRICHED + """
SELECT location_name, count(*) AS alerts FROM ae GROUP BY 1 ORDER BY alerts DESC, location_name LIMIT 10
""")
def _alert_top_stations(spark, sf):
    """A12."""
    return R.top_stations(_alerts_enriched(core(spark, sf)), 10)


@register("alert_kpis", ALERTS_ENRICHED + """
SELECT count(*) AS total_alerts, count(*) FILTER (WHERE alert_level = 'critical') AS critical_alerts,
       count(DISTINCT location_name) AS stations, count(DISTINCT parameter_code) AS pollutants
FROM ae
""")
def _alert_kpis(spark, sf):
    """A13."""
    return R.alert_kpis(_alerts_enriched(core(spark, sf)))


@register("gaps", """
, g AS (SELECT city, location_name, parameter_code, measured_at,
               lag(measured_at) OVER (PARTITION BY city, location_name, parameter_code ORDER BY measured_at)
                   AS previous_at
        FROM readings)
SELECT city, location_name, parameter_code, previous_at AS gap_start, measured_at AS gap_end,
       round((epoch_us(measured_at) - epoch_us(previous_at)) / 3600000000.0, 2) AS gap_hours
FROM g
WHERE previous_at IS NOT NULL AND (epoch_us(measured_at) - epoch_us(previous_at)) / 3600000000.0 > 6
""")
def _gaps(spark, sf):
    """W8 + L8: gaps above 6 h per (city, station, parameter) (chunked lag, safe
    for hot series), the longest first."""
    return R.gaps(reads.readings(core(spark, sf))).orderBy(F.desc("gap_hours"), *R.SERIES, "gap_start")


@register("gap_sessions", """
, g AS (SELECT city, location_name, parameter_code, measured_at,
               CASE WHEN lag(measured_at) OVER w IS NULL
                      OR measured_at - lag(measured_at) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new_s
        FROM readings WINDOW w AS (PARTITION BY city, location_name, parameter_code ORDER BY measured_at))
, s AS (SELECT *, sum(new_s) OVER (PARTITION BY city, location_name, parameter_code ORDER BY measured_at
                                   ROWS UNBOUNDED PRECEDING) AS sid
        FROM g)
SELECT city, location_name, parameter_code, min(measured_at) AS first_at, max(measured_at) AS last_at,
       count(*) AS readings
FROM s GROUP BY city, location_name, parameter_code, sid
""")
def _gap_sessions(spark, sf):
    """6 h gap-bounded sessions per (city, station, parameter)."""
    return R.gap_sessions(reads.readings(core(spark, sf)))


@register("date_rollup", FIRST_LOAD + """
SELECT CAST(year(measured_at) AS INTEGER) AS year, CAST(quarter(measured_at) AS INTEGER) AS quarter,
       CAST(month(measured_at) AS INTEGER) AS month, CAST(day(measured_at) AS INTEGER) AS day, count(*) AS readings, CAST(CAST(((2 * sum(CAST(round(measurement_value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(measurement_value), 0)) // (2 * NULLIF(count(measurement_value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS mean_value
FROM fact_m GROUP BY ROLLUP (year(measured_at), quarter(measured_at), month(measured_at), day(measured_at))
""")
def _date_rollup(spark, sf):
    """Date drill-down: ROLLUP(year, quarter, month, day) over the reading fact."""
    f = published_fact(core(spark, sf))
    return f.rollup(F.year("measured_at").alias("year"), F.quarter("measured_at").alias("quarter"),
                    F.month("measured_at").alias("month"), F.dayofmonth("measured_at").alias("day")) \
        .agg(F.count(F.lit(1)).alias("readings"), S.exact_mean("measurement_value").alias("mean_value"))


# --- features, split, predictions ------------------------------------------


FEATS_SQL = FIRST_LOAD + """
, star AS (SELECT f.*, CAST(isodow(measured_at) AS INTEGER) AS weekday, CAST(month(measured_at) AS INTEGER) AS month,
                  CAST(hour(measured_at) AS INTEGER) AS hour, CAST(minute(measured_at) AS INTEGER) AS minute
           FROM fact_m f)
, feat_all AS (
  SELECT source_sensor_id, source_location_id, parameter_code, measured_at,
         measurement_value AS current_value, hour, minute, weekday, month,
         lag(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at) AS previous_value,
         CASE WHEN count(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at
                                                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
              THEN avg(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at
                                                ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS rolling_3h,
         CASE WHEN count(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at
                                                  ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) = 6
              THEN avg(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at
                                                ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) END AS rolling_6h,
         lead(measurement_value) OVER (PARTITION BY source_sensor_id ORDER BY measured_at) AS target_value,
         lead(measured_at) OVER (PARTITION BY source_sensor_id ORDER BY measured_at) AS target_measured_at
  FROM star)
, feat AS (SELECT * FROM feat_all
           WHERE previous_value IS NOT NULL AND rolling_3h IS NOT NULL AND rolling_6h IS NOT NULL
             AND target_value IS NOT NULL AND target_measured_at IS NOT NULL)
"""

FEATURE_OUT = ["source_sensor_id", "source_location_id", "parameter_code", "measured_at", "current_value",
               "previous_value", "rolling_3h", "rolling_6h", "hour", "minute", "weekday", "month",
               "target_value", "target_measured_at"]


def _features(c):
    return FT.features(FT.star_rows(published_fact(c), c.spark))


@register("features", FEATS_SQL + "SELECT " + ", ".join(FEATURE_OUT) + " FROM feat")
def _features_q(spark, sf):
    """Lag, rolling means over 3 and 6 rows, next value and time."""
    return _features(core(spark, sf)).select(*FEATURE_OUT)


@register("features_one_parameter", FEATS_SQL.replace("FROM fact_m f)", "FROM fact_m f WHERE parameter_code = 'view')")
          + "SELECT " + ", ".join(FEATURE_OUT) + " FROM feat")
def _features_one_parameter(spark, sf):
    """The training rows of a model for one parameter."""
    c = core(spark, sf)
    return FT.features(FT.star_rows(published_fact(c), spark, parameter="view")).select(*FEATURE_OUT)


@register("train_test_split", FEATS_SQL + """
, n AS (SELECT count(*) AS n FROM feat)
, k AS (SELECT CASE WHEN greatest(1, CAST(floor(n * 0.8) AS BIGINT)) >= n THEN n - 1
                    ELSE greatest(1, CAST(floor(n * 0.8) AS BIGINT)) END AS k FROM n)
SELECT source_sensor_id, measured_at, target_measured_at,
       CASE WHEN row_number() OVER (ORDER BY target_measured_at, source_sensor_id) <= (SELECT k FROM k)
            THEN 'train' ELSE 'test' END AS split
FROM feat
""")
def _train_test_split(spark, sf):
    """Exact chronological 80/20 split."""
    f = _features(core(spark, sf))
    return FT.chronological_split(f).select("source_sensor_id", "measured_at", "target_measured_at", "split")


INPUTS_SQL = FIRST_LOAD + """
, lastrows AS (SELECT *, row_number() OVER (PARTITION BY source_sensor_id ORDER BY measured_at DESC) AS rd
               FROM fact_m)
, inputs AS (
  SELECT source_sensor_id, source_location_id, parameter_code,
         max(CASE WHEN rd = 1 THEN measured_at END) AS last_measured_at,
         max(CASE WHEN rd = 1 THEN measurement_value END) AS current_value,
         max(CASE WHEN rd = 2 THEN measurement_value END) AS previous_value,
         avg(CASE WHEN rd <= 3 THEN measurement_value END) AS rolling_3h,
         avg(CASE WHEN rd <= 6 THEN measurement_value END) AS rolling_6h,
         max(CASE WHEN rd = 1 THEN measured_at END) + INTERVAL 1 HOUR AS target_measured_at
  FROM lastrows WHERE rd <= 6 GROUP BY 1, 2, 3 HAVING count(*) >= 6)
"""


def _inputs(c):
    return FT.prediction_inputs(FT.star_rows(published_fact(c), c.spark))


@register("prediction_inputs", INPUTS_SQL + "SELECT * FROM inputs")
def _prediction_inputs(spark, sf):
    """Last-row features per sensor with at least 6 readings."""
    return _inputs(core(spark, sf)).select(
        "source_sensor_id", "source_location_id", "parameter_code", "last_measured_at", "current_value",
        "previous_value", "rolling_3h", "rolling_6h", "target_measured_at")


# Spark rounds a double to decimal from its shortest decimal text; the oracle does the same.
SCORE_SQL = "(current_value * 0.6 + previous_value * 0.25 + rolling_3h * 0.1 + rolling_6h * 0.05)"
RISK_OF = lambda x: (f"CAST(CASE WHEN {x} >= 0 AND {x} < 10 THEN 1 WHEN {x} >= 10 AND {x} < 25 THEN 2 "  # noqa: E731
                     f"WHEN {x} >= 25 AND {x} < 50 THEN 3 WHEN {x} >= 50 THEN 4 END AS INTEGER)")
CREATED_AT = "2024-02-01 00:00:00"


@register("fact_prediction", INPUTS_SQL + f"""
SELECT source_location_id, source_sensor_id, parameter_code, target_measured_at,
       CAST(CAST(CAST({SCORE_SQL} AS VARCHAR) AS DECIMAL(12,4)) AS DOUBLE) AS predicted_value,
       'fixed_linear' AS model_name, '0.1.0' AS model_version, {RISK_OF(SCORE_SQL)} AS risk_class_key,
       CAST(strftime(target_measured_at, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(target_measured_at) * 100 + minute(target_measured_at) AS INTEGER) AS time_key,
       TIMESTAMP '{CREATED_AT}' AS prediction_created_at
FROM inputs
""")
def _fact_prediction(spark, sf):
    """Score, classify (unrounded), round to 4 places, insert new keys."""
    i = _inputs(core(spark, sf))
    rows = FT.prediction_rows(i, FT.fixed_linear_score(i), "fixed_linear", CREATED_AT)
    return FT.load_prediction_facts(rows).drop("feature_payload")


@register("prediction_payload", INPUTS_SQL + """
SELECT i.source_sensor_id, i.current_value, i.previous_value, i.rolling_3h, i.rolling_6h,
       CAST(hour(last_measured_at) AS INTEGER) AS hour, CAST(minute(last_measured_at) AS INTEGER) AS minute,
       CAST(isodow(last_measured_at) AS INTEGER) AS weekday, CAST(month(last_measured_at) AS INTEGER) AS month
FROM inputs i
""")
def _prediction_payload(spark, sf):
    """The features stored with each prediction, read back from their JSON."""
    i = _inputs(core(spark, sf))
    rows = FT.prediction_rows(i, FT.fixed_linear_score(i), "fixed_linear", CREATED_AT)
    doubles = ["current_value", "previous_value", "rolling_3h", "rolling_6h"]
    schema = ", ".join([f"{c} double" for c in doubles] + [f"{c} int" for c in ("hour", "minute", "weekday", "month")])
    return rows.select("source_sensor_id", F.from_json("feature_payload", schema).alias("p")).select("source_sensor_id", "p.*")


CREATED_AT_2 = "2024-02-01 06:00:00"


@register("fact_prediction_second_run", INPUTS_SQL + f"""
SELECT source_location_id, CASE WHEN source_sensor_id % 5 <> 0 THEN source_sensor_id END AS source_sensor_id, parameter_code, target_measured_at,
       CAST(CAST(CAST({SCORE_SQL} AS VARCHAR) AS DECIMAL(12,4)) AS DOUBLE) + CASE WHEN source_sensor_id % 3 = 0 THEN 1 ELSE 0 END AS predicted_value,
       CASE WHEN source_sensor_id % 3 = 0 THEN TIMESTAMP '{CREATED_AT_2}' ELSE TIMESTAMP '{CREATED_AT}' END AS prediction_created_at
FROM inputs
""")
def _fact_prediction_second_run(spark, sf):
    """A run that stored two sensors of three, then one over all with
    other values: only keys that are not stored go in, also those without a
    sensor (every fifth)."""
    i = _inputs(core(spark, sf))
    def some(rows):
        return rows.withColumn("source_sensor_id", F.when(F.col("source_sensor_id") % 5 != 0, F.col("source_sensor_id")))
    first = some(FT.prediction_rows(i.filter("source_sensor_id % 3 <> 0"), FT.fixed_linear_score(i), "fixed_linear", CREATED_AT)).checkpoint()
    again = some(FT.prediction_rows(i, FT.fixed_linear_score(i), "fixed_linear", CREATED_AT_2)) \
        .withColumn("predicted_value", F.col("predicted_value") + 1)
    return first.unionByName(FT.load_prediction_facts(again, first)).select(
        "source_location_id", "source_sensor_id", "parameter_code", "target_measured_at", "predicted_value", "prediction_created_at")


def _backtest(c):
    f = _features(c)
    return FT.prediction_rows(f, FT.fixed_linear_score(f), "fixed_linear", CREATED_AT)


BACKTEST_SQL = FEATS_SQL + f"""
, preds AS (
  SELECT source_location_id, source_sensor_id, parameter_code, target_measured_at,
         CAST(CAST(CAST({SCORE_SQL} AS VARCHAR) AS DECIMAL(12,4)) AS DOUBLE) AS predicted_value,
         'fixed_linear' AS model_name, '0.1.0' AS model_version, {RISK_OF(SCORE_SQL)} AS risk_class_key,
         TIMESTAMP '{CREATED_AT}' AS created_at
  FROM feat)
, pva AS (
  SELECT p.*, CASE p.risk_class_key WHEN 1 THEN 'Low' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'High'
                                    WHEN 4 THEN 'Critical' END AS risk_class_label,
         f.measurement_value AS actual_value, abs(p.predicted_value - f.measurement_value) AS absolute_error
  FROM preds p LEFT JOIN fact_m f
    ON f.source_location_id = p.source_location_id AND f.parameter_code = p.parameter_code
   AND f.measured_at = p.target_measured_at
   AND (p.source_sensor_id IS NULL OR f.source_sensor_id = p.source_sensor_id))
"""


@register("predictions_vs_actual", BACKTEST_SQL + """
SELECT pva.source_location_id, l.city, l.name AS location_name, source_sensor_id, parameter_code,
       target_measured_at, predicted_value, model_name, model_version, created_at, risk_class_label,
       actual_value, absolute_error
FROM pva JOIN cur_loc l ON l.location_id = pva.source_location_id
ORDER BY target_measured_at DESC, created_at DESC, source_sensor_id LIMIT 200
""")
def _predictions_vs_actual(spark, sf):
    """Newest 200 predictions with the matching actual and error."""
    c = core(spark, sf)
    return FT.predictions_vs_actual(_backtest(c), published_fact(c), scd2.current(SC.published(c, "dim_location")),
                                    limit=200)


@register("predictions_any_sensor", BACKTEST_SQL + """
, preds2 AS (SELECT * REPLACE (CASE WHEN source_sensor_id % 2 = 0 THEN source_sensor_id END AS source_sensor_id) FROM preds)
, fact2 AS (SELECT source_location_id, source_sensor_id, parameter_code, measured_at, measurement_value FROM fact_m
            UNION ALL SELECT source_location_id, source_sensor_id + 500, parameter_code, measured_at, measurement_value + 1
            FROM fact_m WHERE source_location_id % 3 = 0)
SELECT p.source_location_id, p.source_sensor_id, p.parameter_code, p.target_measured_at, p.predicted_value,
       f.measurement_value AS actual_value, abs(p.predicted_value - f.measurement_value) AS absolute_error
FROM preds2 p LEFT JOIN fact2 f
  ON f.source_location_id = p.source_location_id AND f.parameter_code = p.parameter_code AND f.measured_at = p.target_measured_at
 AND (p.source_sensor_id IS NULL OR f.source_sensor_id = p.source_sensor_id)
""")
def _predictions_any_sensor(spark, sf):
    """A prediction without a sensor meets the actuals of every sensor of
    its place, parameter and time (every third place has a second one)."""
    c = core(spark, sf)
    preds = _backtest(c).withColumn("source_sensor_id", F.when(F.col("source_sensor_id") % 2 == 0, F.col("source_sensor_id")))
    f = published_fact(c)
    second = f.filter("source_location_id % 3 = 0").withColumns({
        "source_sensor_id": F.col("source_sensor_id") + 500, "measurement_value": F.col("measurement_value") + 1})
    return FT.predictions_vs_actual(preds, f.unionByName(second), limit=None).select(
        "source_location_id", "source_sensor_id", "parameter_code", "target_measured_at", "predicted_value", "actual_value", "absolute_error")


@register("error_metrics", BACKTEST_SQL + """
SELECT count(*) AS matched, avg(abs(predicted_value - actual_value)) AS mae,
       sqrt(avg((predicted_value - actual_value) * (predicted_value - actual_value))) AS rmse,
       1 - avg((predicted_value - actual_value) * (predicted_value - actual_value)) / var_pop(actual_value) AS r2
FROM pva WHERE actual_value IS NOT NULL AND predicted_value IS NOT NULL
""")
def _error_metrics(spark, sf):
    """MAE, RMSE, R2 of the backtest predictions."""
    c = core(spark, sf)
    return FT.error_metrics(FT.predictions_vs_actual(_backtest(c), published_fact(c), limit=None))


# --- quality rules and warehouse checks ------------------------------------


def _quality_tables(c):
    a = SC.reviewed_alerts(c)
    return {"location": c.location, "parameter": c.parameter, "sensor": c.sensor,
            "measurement_raw": c.measurement, "threshold_rule": c.threshold_rule,
            "pollution_alert": a, "ingestion_run_log": _runs(c).withColumn("records_requested", F.lit(0)),  # never written: its default
            "raw_api_response": _location_records(c), "pollution_alert_outbox": SC.outbox(c),
            "dim_location": SC.dim_location_history(c), "dim_sensor": SC.dim_sensor_history(c),
            "dim_risk_class": dims.dim_risk_class(c.spark), "dim_date": dims.dim_date(c.spark),
            "dim_time": dims.dim_time(c.spark)}


DQ_TABLES_SQL = OUTBOX_SQL + RUNS_SQL + LOC_HIST + SEN_HIST + """
, raw_pages AS (
  SELECT location_id AS source_id, '/v3/locations' AS endpoint, '/v3/locations/' || location_id AS url, '{}' AS response_body FROM location
  UNION ALL SELECT location_id, '/v3/locations/{id}/sensors', '/v3/locations/' || location_id || '/sensors', '{}'
  FROM location WHERE location_id % 4 = 0 AND location_id IN (SELECT location_id FROM sensor))
"""


@register("dq_rules", DQ_TABLES_SQL + checks.counts_sql(broken=False))
def _dq_rules(spark, sf):
    """Violation counts per rule and table (one pass per table)."""
    return QL.row_rule_counts(_quality_tables(core(spark, sf)))


@register("dq_rules_broken", DQ_TABLES_SQL + checks.counts_sql(broken=True))
def _dq_rules_broken(spark, sf):
    """C1-C8, C11 on rows derived from the same tables that break every rule."""
    tables = _quality_tables(core(spark, sf))
    return QL.row_rule_counts({t: df.select(*[F.expr(e).alias(c) if (e := checks.replaced(t).get(c)) else c
                                              for c in df.columns]) for t, df in tables.items()})


def _key_tables(c):
    """Every table with a key or a reference, dimensions with their versions."""
    t = _quality_tables(c)
    dims_ = {"dim_location": ("source_location_id", "location_key"), "dim_sensor": ("source_sensor_id", "sensor_key")}
    for name, (source, key) in dims_.items():
        t[name] = scd2.with_surrogate(t[name], source, key)
    i = _inputs(c)
    keys = {k: scd2.with_surrogate(scd2.current(SC.published(c, d)), s, k).select(s, k) for d, (s, k) in dims_.items()}
    predictions = FT.prediction_rows(i, FT.fixed_linear_score(i), "fixed_linear", CREATED_AT).withColumnsRenamed(
        {"date_key": "target_date_key", "time_key": "target_time_key"}) \
        .join(keys["location_key"], "source_location_id").join(keys["sensor_key"], "source_sensor_id") \
        .join(SC.published(c, "dim_parameter").select(F.col("code").alias("parameter_code"), "parameter_key"), "parameter_code")
    return {**t, "dim_parameter": SC.published(c, "dim_parameter"), "fact_measurement": published_fact(c),
            "fact_alert": SC.published(c, "fact_alert"), "fact_prediction": predictions}


DQ_KEYS_SQL = OUTBOX_SQL + RUNS_SQL + LOC_HIST + SEN_HIST + INPUTS_SQL + FACT_ALERT_SQL.removeprefix(ALERTS) \
    + checks.KEY_TABLES_SQL.replace("{score_risk}", RISK_OF(SCORE_SQL))


@register("dq_keys", DQ_KEYS_SQL + checks.key_counts_sql(broken=False))
def _dq_keys(spark, sf):
    """Every unique key and reference, in one pass over the tables."""
    return QL.key_rule_counts(_key_tables(core(spark, sf)))


@register("dq_keys_broken", DQ_KEYS_SQL + checks.key_counts_sql(broken=True))
def _dq_keys_broken(spark, sf):
    """C9, C10, A21 on tables with repeated rows and references that lead nowhere."""
    tables = _key_tables(core(spark, sf))
    out = {}
    for t, df in tables.items():
        key, repeated, replaced = checks.KEY_BREAKS.get(t, (None, None, {}))
        df = df.select(*[F.expr(e).alias(col) if (e := replaced.get(col)) else col for col in df.columns])
        out[t] = df if key is None else df.unionByName(df.filter(F.expr(repeated)))
    return QL.key_rule_counts(out)


@register("dq_duplicates", DQ_KEYS_SQL + checks.key_counts_sql(broken=False, kinds=("C9",)))
def _dq_duplicates(spark, sf):
    """Duplicate keys per unique constraint (incl. partial unique on is_current)."""
    return QL.key_rule_counts(_key_tables(core(spark, sf)), foreign=[])


@register("dq_orphans", ALERTS + """
SELECT 'C10_customer_without_nation' AS rule, 'customer' AS table_name,
       (SELECT count(*) FROM customer c WHERE c.c_nationkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)) AS bad_count
UNION ALL SELECT 'C10_order_without_customer', 'orders',
       (SELECT count(*) FROM orders o WHERE o.o_custkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
UNION ALL SELECT 'C10_item_without_order', 'lineitem',
       (SELECT count(*) FROM lineitem l WHERE l.l_orderkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
UNION ALL SELECT 'C10_event_without_customer', 'events',
       (SELECT count(*) FROM events e WHERE e.user_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id))
""")
def _dq_orphans(spark, sf):
    """C10 on other tables: the same pass with references given by the caller."""
    c = core(spark, sf)
    tables = {t: c.raw(t) for t in ("customer", "nation", "orders", "lineitem", "events")}
    return QL.key_rule_counts(tables, unique=[], foreign=[
        ("C10_customer_without_nation", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
        ("C10_order_without_customer", "orders", ["o_custkey"], "customer", ["c_custkey"]),
        ("C10_item_without_order", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
        ("C10_event_without_customer", "events", ["user_id"], "customer", ["c_custkey"])])


@register("dw_shape", INPUTS_SQL + FACT_ALERT_SQL + checks.DIMS_SQL + """
SELECT 'dim_date' AS table_name, (SELECT count(*) FROM dim_date) AS row_count
UNION ALL SELECT 'dim_time', (SELECT count(*) FROM dim_time)
UNION ALL SELECT 'dim_risk_class', (SELECT count(*) FROM dim_risk_class)
UNION ALL SELECT 'dim_parameter', (SELECT count(*) FROM parameter)
UNION ALL SELECT 'dim_location', (SELECT count(*) FROM cur_loc)
UNION ALL SELECT 'dim_sensor', (SELECT count(*) FROM cur_sen)
UNION ALL SELECT 'fact_measurement', (SELECT count(*) FROM fact_m)
UNION ALL SELECT 'fact_alert', (SELECT count(*) FROM fact_a)
UNION ALL SELECT 'fact_prediction', (SELECT count(*) FROM inputs)
""")
def _dw_shape(spark, sf):
    """V1: the nine tables of the star schema and their rows after a first load."""
    c = core(spark, sf)
    i = _inputs(c)
    tables = {"dim_date": dims.dim_date(spark), "dim_time": dims.dim_time(spark), "dim_risk_class": dims.dim_risk_class(spark),
              **{t: SC.published(c, t) for t in ("dim_parameter", "dim_location", "dim_sensor", "fact_measurement", "fact_alert")},
              "fact_prediction": FT.prediction_rows(i, FT.fixed_linear_score(i), "fixed_linear", CREATED_AT)}
    return QL.rowcount_audit(tables)


@register("dw_verify", LOC_HIST + SEN_HIST + FIRST_LOAD + """
, f1 AS (SELECT f.*, d.valid_from AS loc_valid_from FROM fact_m f
         JOIN dim_loc1 d ON d.source_location_id = f.source_location_id AND d.is_current)
SELECT 'V1_dim_date_rows' AS check_name,
       (SELECT count(*) FROM generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS value
UNION ALL SELECT 'V1_dim_time_rows', 1440
UNION ALL SELECT 'V1_dim_risk_class_rows', 4
UNION ALL SELECT 'V2_fact_rows', (SELECT count(*) FROM f1)
UNION ALL SELECT 'V2_facts_missing_dimension',
       (SELECT count(*) FROM f1 WHERE date_key NOT IN (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER)
              FROM generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY) t(d))
              OR risk_class_key IS NULL OR parameter_code IS NULL)
UNION ALL SELECT 'V2_duplicate_facts',
       (SELECT count(*) FROM (SELECT source_measurement_id FROM f1 GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'V2_outside_band',
       (SELECT count(*) FROM f1 WHERE NOT (
          (risk_class_key = 1 AND measurement_value >= 0 AND measurement_value < 10) OR
          (risk_class_key = 2 AND measurement_value >= 10 AND measurement_value < 25) OR
          (risk_class_key = 3 AND measurement_value >= 25 AND measurement_value < 50) OR
          (risk_class_key = 4 AND measurement_value >= 50)))
UNION ALL SELECT 'V3_sources_without_one_current',
       (SELECT count(*) FROM (SELECT source_location_id FROM dim_loc2 GROUP BY 1
                              HAVING count(*) FILTER (WHERE is_current) <> 1))
UNION ALL SELECT 'V3_expired_not_closed',
       (SELECT count(*) FROM dim_loc2 WHERE NOT is_current AND valid_to IS NULL)
UNION ALL SELECT 'V3_expired_versions', (SELECT count(*) FROM dim_loc2 WHERE NOT is_current)
UNION ALL SELECT 'V3_facts_on_expired_version',
       (SELECT count(*) FROM f1 JOIN dim_loc2 d ON d.source_location_id = f1.source_location_id
                              AND d.valid_from = f1.loc_valid_from WHERE NOT d.is_current)
UNION ALL SELECT 'V2_facts_missing_time',
       (SELECT count(*) FROM f1 WHERE time_key // 100 NOT BETWEEN 0 AND 23 OR time_key % 100 > 59)
UNION ALL SELECT 'V2_facts_missing_location',
       (SELECT count(*) FROM fact_m f WHERE f.source_location_id IN (SELECT source_location_id FROM f1)
          AND NOT EXISTS (SELECT 1 FROM dim_loc1 d WHERE d.source_location_id = f.source_location_id AND d.is_current))
UNION ALL SELECT 'V2_facts_missing_sensor',
       (SELECT count(*) FROM f1
         WHERE NOT EXISTS (SELECT 1 FROM sensor s WHERE s.sensor_id = f1.source_sensor_id AND s.is_active))
UNION ALL SELECT 'V2_facts_missing_parameter',
       (SELECT count(*) FROM f1 WHERE NOT EXISTS (SELECT 1 FROM parameter p WHERE p.code = f1.parameter_code))
UNION ALL SELECT 'V3_sensors_without_one_current',
       (SELECT count(*) FROM (SELECT source_sensor_id FROM dim_sen2 GROUP BY 1
                              HAVING count(*) FILTER (WHERE is_current) <> 1))
UNION ALL SELECT 'V3_sensor_expired_not_closed',
       (SELECT count(*) FROM dim_sen2 WHERE NOT is_current AND valid_to IS NULL)
UNION ALL SELECT 'V3_sensor_expired_versions', (SELECT count(*) FROM dim_sen2 WHERE NOT is_current)
""")
def _dw_verify(spark, sf):
    """V1-V3: dimension sizes, fact integrity, SCD2 history invariants."""
    c = core(spark, sf)
    d0 = scd2.empty_location_dim(spark, c.location)
    d1 = scd2.sync_locations(SC.location_snapshot_1(c.location), d0, SC.AS_OF_1)
    d2 = scd2.sync_locations(SC.location_snapshot_2(c.location), d1, SC.AS_OF_2)
    s1, s2 = SC.dim_sensor_first_load(c), SC.dim_sensor_history(c)
    f1 = facts.load_measurement_facts(c, d1, s1)
    # every check below reads these: compute them once, cut lineage in the shared folder
    d1, d2, s2, f1 = d1.checkpoint(), d2.checkpoint(), s2.checkpoint(), f1.checkpoint()
    dd = dims.dim_date(spark).select("date_key")
    n = lambda name, df: df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
        F.lit(name).alias("check_name"), "value")
    band = F.col("risk_class_key") == S.risk_class_key("measurement_value")
    versions = d2.select("source_location_id", "valid_from", "is_current")
    f1v = f1.join(d1.filter("is_current").select(F.xxhash64("source_location_id", "valid_from").alias("location_key"),
                                                 F.col("valid_from").alias("loc_valid_from")), "location_key")
    return QL.union_all([
        n("V1_dim_date_rows", dims.dim_date(spark)),
        n("V1_dim_time_rows", dims.dim_time(spark)),
        n("V1_dim_risk_class_rows", dims.dim_risk_class(spark)),
        n("V2_fact_rows", f1),
        n("V2_facts_missing_dimension",
          f1.join(F.broadcast(dd), "date_key", "left_anti").unionByName(
              f1.filter(F.col("risk_class_key").isNull() | F.col("parameter_code").isNull()))),
        n("V2_duplicate_facts", QL.duplicate_keys(f1, ["source_measurement_id"])),
        n("V2_outside_band", f1.filter(~band)),
        n("V3_sources_without_one_current",
          d2.groupBy("source_location_id").agg(F.count_if("is_current").alias("k")).filter("k <> 1")),
        n("V3_expired_not_closed", d2.filter(~F.col("is_current") & F.col("valid_to").isNull())),
        n("V3_expired_versions", d2.filter(~F.col("is_current"))),
        n("V3_facts_on_expired_version",
          f1v.join(versions.withColumnRenamed("valid_from", "loc_valid_from"),
                   ["source_location_id", "loc_valid_from"]).filter(~F.col("is_current"))),
        n("V2_facts_missing_time", QL.orphans(f1, dims.dim_time(spark), ["time_key"], ["time_key"])),
        n("V2_facts_missing_location", QL.orphans(
            f1, d1.select(F.xxhash64("source_location_id", "valid_from").alias("k")), ["location_key"], ["k"])),
        n("V2_facts_missing_sensor", QL.orphans(
            f1, s1.select(F.xxhash64("source_sensor_id", "valid_from").alias("k")), ["sensor_key"], ["k"])),
        n("V2_facts_missing_parameter", QL.orphans(f1, c.parameter, ["parameter_code"], ["code"])),
        n("V3_sensors_without_one_current",
          s2.groupBy("source_sensor_id").agg(F.count_if("is_current").alias("k")).filter("k <> 1")),
        n("V3_sensor_expired_not_closed", s2.filter(~F.col("is_current") & F.col("valid_to").isNull())),
        n("V3_sensor_expired_versions", s2.filter(~F.col("is_current"))),
    ])


@register("rowcount_audit", ALERTS + FIRST_LOAD + """
SELECT 'parameter' AS table_name, (SELECT count(*) FROM parameter) AS row_count
UNION ALL SELECT 'location', (SELECT count(*) FROM location)
UNION ALL SELECT 'sensor', (SELECT count(*) FROM sensor)
UNION ALL SELECT 'measurement_raw', (SELECT count(*) FROM m)
UNION ALL SELECT 'threshold_rule', (SELECT count(*) FROM threshold_rule)
UNION ALL SELECT 'pollution_alert', (SELECT count(*) FROM alerts)
UNION ALL SELECT 'fact_air_quality_measurement', (SELECT count(*) FROM fact_m)
""")
def _rowcount_audit(spark, sf):
    """UNION ALL of table row counts."""
    c = core(spark, sf)
    return QL.rowcount_audit({"parameter": c.parameter, "location": c.location, "sensor": c.sensor,
                              "measurement_raw": c.measurement, "threshold_rule": c.threshold_rule,
                              "pollution_alert": SC.stored_alerts(c), "fact_air_quality_measurement": published_fact(c)})


# --- bronze: landing, parsing, scope, first writer, upserts -----------------


def _landing_name(c, kind: str) -> str:
    """Landing folder of the session's derived pages: keyed by the input
    files and the code that builds the pages (never by a process-local id)."""
    import sys

    from aerolith.session import code_version
    from aerolith.sources import driver_tables
    return f"{kind}-{c.inputs}-{code_version(B, driver_tables, sys.modules[__name__])}"


def _measurement_pages(c):
    return B.land_once(c.spark, B.measurement_pages(c.raw("events"), c.parameter), _landing_name(c, "m"))


def _parsed_measurements(c):
    return B.parse_measurements(B.unnest(_measurement_pages(c), B.MEASUREMENT_JSON))


@register("bronze_measurements", """
SELECT e.user_id * 1000 + p.parameter_id AS sensor_id, e.ts AS measured_at,
       CASE WHEN e.event_id % 50 <> 7 THEN CAST(CAST(e.value AS DECIMAL(12,4)) AS DOUBLE) END AS value,
       'ug/m3' AS unit,
       CASE WHEN e.event_id % 50 = 7 THEN 'measurement skipped: missing time or value' END AS error
FROM events e JOIN parameter p ON p.code = e.event_type
""")
def _bronze_measurements(spark, sf):
    """S1 + S2 + S6 + F1 + F4: landed JSON pages -> parsed readings with error tags."""
    p = _parsed_measurements(core(spark, sf))
    return p.select("sensor_id", "measured_at", F.col("value").cast("double").alias("value"), "unit", "error")


@register("unit_normalize", """
SELECT CASE WHEN event_id % 3 = 0 THEN 'µg/m³' ELSE 'ug/m3' END AS raw_unit, 'ug/m3' AS unit,
       count(*) AS records
FROM events GROUP BY 1
""")
def _unit_normalize(spark, sf):
    """raw units in the pages and their normalised form."""
    pages = _measurement_pages(core(spark, sf))
    rec = B.unnest(pages, B.MEASUREMENT_JSON)
    return rec.groupBy(F.col("rec")["parameter"]["units"].alias("raw_unit")).agg(F.count(F.lit(1)).alias("records")) \
        .select("raw_unit", S.normalize_unit("raw_unit").alias("unit"), "records")


@register("json_props_parse", """
SELECT measurement_id, sensor_id, CAST(json_extract(raw_payload, '$.k') AS BIGINT) AS k FROM m
""")
def _json_props_parse(spark, sf):
    """JSONB payload column parsed with a declared schema (from_json)."""
    m = core(spark, sf).measurement
    return m.select("measurement_id", "sensor_id",
                    F.from_json("raw_payload", "k BIGINT")["k"].alias("k"))


def _location_records(c):
    pages = B.land_once(c.spark, B.location_pages(c.location, c.sensor, c.parameter), _landing_name(c, "l"))
    return pages


@register("location_scope", """
, parsed AS (
  SELECT location_id,
         CASE WHEN location_id % 11 = 5 THEN 'OpenAQ location ' || CAST(location_id AS VARCHAR) ELSE name END AS name,
         city, country,
         CASE WHEN location_id % 11 = 5 THEN '' ELSE name END AS raw_name
  FROM location)
SELECT location_id, name, city, country FROM parsed
WHERE lower(concat_ws(' ', city, NULLIF(raw_name, ''))) LIKE '%nation_1%'
   OR lower(concat_ws(' ', city, NULLIF(raw_name, ''))) LIKE '%nation_22%'
""")
def _location_scope(spark, sf):
    """S3 + F2/F3 + S7: parsed location pages in the city scope (substring match)."""
    pages = _location_records(core(spark, sf))
    locs = B.distinct_locations(
        B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON)))
    return B.in_scope(locs, cities=["Nation_1", "NATION_22"]).select("location_id", "name", "city", "country")


@register("sensors_from_pages", """
SELECT s.sensor_id, s.location_id, p.code AS parameter_code, p.display_name AS parameter_name, s.unit
FROM sensor s JOIN parameter p ON p.parameter_id = s.parameter_id
""")
def _sensors_from_pages(spark, sf):
    """S4 + S5: embedded sensors, sensor pages only for locations without them."""
    pages = _location_records(core(spark, sf))
    locs = B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON))
    fallback = pages.filter(F.col("endpoint") == "/v3/locations/{id}/sensors")
    return B.sensors_of(locs, fallback).select("sensor_id", "location_id", "parameter_code", "parameter_name", "unit")


@register("dedupe_first_writer", """
SELECT e.user_id * 1000 + p.parameter_id AS sensor_id, e.ts AS measured_at,
       CAST(CAST(e.value AS DECIMAL(12,4)) AS DOUBLE) AS value
FROM events e JOIN parameter p ON p.code = e.event_type
WHERE e.event_id % 50 <> 7
""")
def _dedupe_first_writer(spark, sf):
    """Original pages plus an overlap replay (last 12 h re-sent with
    corrected values, later run): first writer wins per (sensor, time)."""
    c = core(spark, sf)
    ev = c.raw("events")
    hw = ev.agg(F.max("ts")).scalar()
    replay = ev.filter(F.col("ts") > F.timestamp_add("HOUR", F.lit(-12), hw)).select(
        (F.col("event_id") + 10_000_000).alias("event_id"), "ts", "user_id", "event_type",
        (F.col("value") + 1).alias("value"), "props")
    rp = B.measurement_pages(replay, c.parameter).withColumn("run_id", F.lit(99999999))
    pages = _measurement_pages(c).unionByName(rp)
    parsed = B.parse_measurements(B.unnest(pages, B.MEASUREMENT_JSON)).filter(F.col("error").isNull())
    kept = B.insert_if_absent(parsed.select("sensor_id", "measured_at", "value", "run_id", "page_no", "position"),
                              None)
    return kept.select("sensor_id", "measured_at", F.col("value").cast("double").alias("value"))


@register("bronze_run_counts", """
, e AS (SELECT e.*, p.parameter_id, p.display_name, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS run_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t, user_id * 1000 + parameter_id AS sensor_id
        FROM events e JOIN parameter p ON p.code = e.event_type)
, bad AS (
  SELECT run_id, sensor_id, ts, event_id,
         'sensor ' || sensor_id || ' measurement skipped at ' || t || ' for parameter ' || event_type
         || ' with value None: Measurement payload missing datetime/value: {' || CASE WHEN event_id % 3 <> 2 THEN '"unit":"ug/m3",' ELSE '' END
         || '"parameter":{"id":' || parameter_id || ',"name":"' || event_type || '","code":"' || event_type || '","displayName":"'
         || display_name || '","units":"' || CASE WHEN event_id % 3 = 0 THEN 'µg/m³' ELSE 'ug/m3' END || '"},"datetime":{'
         || CASE WHEN event_id % 4 = 0 THEN '"utc":"' || t || '"' ELSE '' END || '},"period":{"datetimeFrom":{'
         || CASE WHEN event_id % 4 = 1 THEN '"utc":"' || t || '"' ELSE '' END || '}}'
         || CASE WHEN event_id % 4 = 2 THEN ',"date":"' || t || '"' WHEN event_id % 4 = 3 THEN ',"datetimeUtc":"' || t || '"' ELSE '' END
         || '}' AS message
  FROM e WHERE event_id % 50 = 7)
, txt AS (SELECT run_id, string_agg(message, ' | ' ORDER BY sensor_id, ts, event_id) AS s FROM bad GROUP BY run_id)
SELECT e.run_id, count(*) FILTER (WHERE event_id % 50 <> 7) AS records_inserted,
       count(*) FILTER (WHERE event_id % 50 = 7) AS records_failed,
       CASE WHEN count(*) FILTER (WHERE event_id % 50 = 7) > 0 THEN 'partial' ELSE 'succeeded' END AS status,
       any_value(CASE WHEN length(s) > 4000 THEN substr(s, 1, 3997) || '...' ELSE s END) AS error_message
FROM e LEFT JOIN txt USING (run_id) GROUP BY e.run_id
""")
def _bronze_run_counts(spark, sf):
    """Per run, rows kept and failed, status, capped error text."""
    c = core(spark, sf)
    parsed = _parsed_measurements(c)
    good = parsed.filter(F.col("error").isNull())
    kept = B.insert_if_absent(good.select("sensor_id", "measured_at", "run_id", "page_no", "position"), None)
    return B.run_counts(parsed, kept)


@register("upsert_location", """
, cur AS (SELECT * FROM location WHERE location_id % 20 <> 2)
SELECT l.location_id,
       CASE WHEN l.location_id % 11 = 5 THEN 'OpenAQ location ' || CAST(l.location_id AS VARCHAR) ELSE l.name END AS name,
       l.city, l.country, CAST(l.latitude AS DOUBLE) AS latitude, CAST(l.longitude AS DOUBLE) AS longitude,
       COALESCE(c.first_seen_at, TIMESTAMP '2024-02-01 00:00:00') AS first_seen_at,
       TIMESTAMP '2024-02-01 00:00:00' AS last_seen_at, true AS is_active
FROM location l LEFT JOIN cur c ON c.location_id = l.location_id
""")
def _upsert_location(spark, sf):
    """Location upsert from parsed pages: listed columns updated,
    first_seen_at kept, last_seen_at = now, is_active = true."""
    c = core(spark, sf)
    pages = _location_records(c)
    locs = B.distinct_locations(
        B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON)))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    new = locs.select("location_id", "name", "city", "country", "latitude", "longitude",
                      now.alias("first_seen_at"), now.alias("last_seen_at"), F.lit(True).alias("is_active"))
    cur = c.location.filter((F.col("location_id") % 20) != 2).select(
        "location_id", "name", "city", "country", "latitude", "longitude", "first_seen_at", "last_seen_at",
        "is_active")
    up = dims.upsert_by_key(new, cur, ["location_id"],
                            update=["name", "city", "country", "latitude", "longitude", "last_seen_at", "is_active"])
    return up.select("location_id", "name", "city", "country", F.col("latitude").cast("double").alias("latitude"),
                     F.col("longitude").cast("double").alias("longitude"), "first_seen_at", "last_seen_at",
                     "is_active")


@register("upsert_sensor", """
, cur AS (SELECT * FROM sensor WHERE sensor_id % 20 <> 2)
SELECT s.sensor_id, s.location_id, s.parameter_id, s.unit,
       COALESCE(c.first_seen_at, TIMESTAMP '2024-02-01 00:00:00') AS first_seen_at,
       TIMESTAMP '2024-02-01 00:00:00' AS last_seen_at, true AS is_active
FROM sensor s LEFT JOIN cur c ON c.sensor_id = s.sensor_id
""")
def _upsert_sensor(spark, sf):
    """Sensor upsert from parsed pages over a stale snapshot (sensors
    missing, units and locations changed)."""
    c = core(spark, sf)
    pages = _location_records(c)
    locs = B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON))
    found = B.sensors_of(locs, pages.filter(F.col("endpoint") == "/v3/locations/{id}/sensors"))
    new = found.join(c.parameter.select(F.col("code").alias("parameter_code"), "parameter_id"), "parameter_code") \
        .select("sensor_id", "location_id", "parameter_id", "unit")
    stale = c.sensor.filter(F.col("sensor_id") % 20 != 2) \
        .withColumn("unit", F.when(F.col("sensor_id") % 3 == 0, "ppm").otherwise(F.col("unit"))) \
        .withColumn("location_id", F.when(F.col("sensor_id") % 7 == 0, F.lit(-1)).otherwise(F.col("location_id")))
    return B.upsert_sensors(new, stale, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@register("upsert_parameter", """
, cur AS (SELECT parameter_id, code FROM parameter WHERE parameter_id % 2 = 1)
, fresh AS (SELECT code, row_number() OVER (ORDER BY code) + (SELECT coalesce(max(parameter_id), 0) FROM cur) AS new_id
            FROM parameter WHERE code NOT IN (SELECT code FROM cur))
SELECT CAST(COALESCE(c.parameter_id, f.new_id) AS INTEGER) AS parameter_id, p.code, p.display_name, p.preferred_unit,
       p.parameter_id AS openaq_parameter_id,
       CASE WHEN c.code IS NOT NULL THEN 'kept' END AS description
FROM parameter p LEFT JOIN cur c ON c.code = p.code LEFT JOIN fresh f ON f.code = p.code
WHERE EXISTS (SELECT 1 FROM sensor s WHERE s.parameter_id = p.parameter_id)
   OR c.code IS NOT NULL
""")
def _upsert_parameter(spark, sf):
    """Parameter upsert from the sensor records over a stale snapshot:
    description set on insert only, new codes get the next ids."""
    c = core(spark, sf)
    pages = _location_records(c)
    locs = B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON))
    recs = B.sensor_records(locs, pages.filter(F.col("endpoint") == "/v3/locations/{id}/sensors"))
    stale = c.parameter.filter(F.col("parameter_id") % 2 == 1).select(
        "parameter_id", F.lit(-1).alias("openaq_parameter_id"), "code", F.lower("code").alias("display_name"),
        F.lit("ppm").alias("preferred_unit"), F.lit("kept").alias("description"))
    return B.upsert_parameters(B.parameters_of(recs), stale) \
        .select("parameter_id", "code", "display_name", "preferred_unit", "openaq_parameter_id", "description")


@register("threshold_upsert", """
, cmd AS (
  SELECT t.parameter_id, t.city, t.warning_level, CAST(t.min_value + 5 AS DECIMAL(12,4)) AS min_value,
         true AS is_active
  FROM threshold_rule t WHERE t.warning_level = 'critical' AND NOT t.is_active
  UNION ALL
  SELECT DISTINCT s.parameter_id, l.country, 'high', CAST(30 AS DECIMAL(12,4)), true
  FROM sensor s JOIN location l ON l.location_id = s.location_id)
SELECT COALESCE(c.parameter_id, t.parameter_id) AS parameter_id, COALESCE(c.city, t.city) AS city,
       COALESCE(c.warning_level, t.warning_level) AS warning_level,
       COALESCE(t.threshold_rule_id, (SELECT max(threshold_rule_id) FROM threshold_rule)
         + row_number() OVER (PARTITION BY t.threshold_rule_id IS NULL
                              ORDER BY c.parameter_id, c.city, c.warning_level)) AS threshold_rule_id,
       CAST(COALESCE(c.min_value, t.min_value) AS DOUBLE) AS min_value,
       COALESCE(c.is_active, t.is_active) AS is_active,
       CASE WHEN c.parameter_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.updated_at END AS updated_at
FROM cmd c FULL OUTER JOIN threshold_rule t
  ON t.parameter_id = c.parameter_id AND t.city = c.city AND t.warning_level = c.warning_level
""")
def _threshold_upsert(spark, sf):
    """Re-enable inactive critical rules (+5), add 'high' rules per country;
    commands naming an unknown parameter or invalid level are ignored, and so
    is an earlier command for the same rule."""
    c = core(spark, sf)
    p = c.parameter.select("parameter_id", F.col("code").alias("parameter_code"))
    inactive = c.threshold_rule.filter((F.col("warning_level") == "critical") & ~F.col("is_active")).join(
        p, "parameter_id").select("parameter_code", "city", "warning_level",
                                  (F.col("min_value") + 5).alias("min_value"), F.lit(True).alias("is_active"))
    per_country = c.sensor.join(c.location.select("location_id", "country"), "location_id").join(
        p, "parameter_id").select("parameter_code", F.col("country").alias("city")).distinct().select(
        "parameter_code", "city", F.lit("high").alias("warning_level"), F.lit(30).alias("min_value"),
        F.lit(True).alias("is_active"))
    unknown = per_country.select(F.lit("no_such_parameter").alias("parameter_code"), "city", "warning_level",
                                 "min_value", "is_active")
    bad_level = per_country.select("parameter_code", "city", F.lit("impossible").alias("warning_level"),
                                   "min_value", "is_active")
    cmds = inactive.unionByName(per_country).unionByName(unknown).unionByName(bad_level)
    at = F.to_timestamp_ntz(F.lit("2024-01-31 12:00:00"))
    earlier = cmds.withColumn("min_value", F.col("min_value") + 40).withColumn("is_active", F.lit(False)) \
        .withColumn("command_at", F.timestamp_add("HOUR", F.lit(-1), at))
    cmds = earlier.unionByName(cmds.withColumn("command_at", at))
    out = A.threshold_upsert(c.threshold_rule, c.parameter, cmds, "2024-02-01 00:00:00")
    return out.select("parameter_id", "city", "warning_level", "threshold_rule_id",
                      F.col("min_value").cast("double").alias("min_value"), "is_active", "updated_at")


@register("default_rules", """
, scope AS (SELECT DISTINCT l.country AS city, s.parameter_id
            FROM sensor s JOIN location l ON l.location_id = s.location_id
            UNION SELECT DISTINCT l.city, s.parameter_id
            FROM sensor s JOIN location l ON l.location_id = s.location_id)
, lv AS (SELECT * FROM (VALUES ('low', 0), ('moderate', 10), ('high', 25), ('critical', 50)) v(warning_level, base))
SELECT (SELECT max(threshold_rule_id) FROM threshold_rule)
         + row_number() OVER (ORDER BY sc.parameter_id, sc.city, lv.warning_level) AS threshold_rule_id,
       sc.city, sc.parameter_id, lv.warning_level, CAST(lv.base AS DOUBLE) AS min_value, true AS is_active
FROM scope sc, lv
WHERE NOT EXISTS (SELECT 1 FROM threshold_rule t WHERE t.parameter_id = sc.parameter_id AND t.city = sc.city
                    AND t.warning_level = lv.warning_level)
""")
def _default_rules(spark, sf):
    """Default rules for every in-scope (city, parameter) not yet covered
    (cities and countries of sensor locations; existing city rules untouched)."""
    c = core(spark, sf)
    sl = c.sensor.join(c.location.select("location_id", "city", "country"), "location_id")
    scope = sl.select(F.col("country").alias("city"), "parameter_id").unionByName(
        sl.select("city", "parameter_id")).distinct()
    out = A.default_rules(scope, c.threshold_rule)
    return out.select("threshold_rule_id", "city", "parameter_id", "warning_level",
                      F.col("min_value").cast("double").alias("min_value"), "is_active")


# --- streaming ---------------------------------------------------------------


def _overlap_replay(ev):
    """The last 12 hours again, with corrected values."""
    hw = ev.agg(F.max("ts")).scalar()
    return ev.filter(F.col("ts") > F.timestamp_add("HOUR", F.lit(-12), hw)).select(
        (F.col("event_id") + 10_000_000).alias("event_id"), "ts", "user_id", "event_type",
        (F.col("value") + 1).alias("value"), "props")


def _replayed_landing(c):
    """Landed pages of all events and, as a later run, of the overlap replay."""
    ev = c.raw("events")
    again = B.measurement_pages(_overlap_replay(ev), c.parameter).withColumn("run_id", F.lit(99999999))
    B.land_once(c.spark, B.measurement_pages(ev, c.parameter).unionByName(again), _landing_name(c, "r"))
    return B.landing_dir(c.spark, _landing_name(c, "r"))


_FEEDS: dict[tuple, ST.Feed] = {}


def _replayed_feed(c) -> ST.Feed:
    """The insert stream over these pages, run once for all its consumers."""
    landing = _replayed_landing(c)
    feed = _FEEDS.get((id(c.spark), landing))
    if feed is None or feed.spark is not c.spark:
        feed = _FEEDS[id(c.spark), landing] = ST.Feed(c.spark, "replayed", landing).land()
    return feed


@register("stream_hourly", """
, hw AS (SELECT max(measured_at) - INTERVAL 12 HOUR AS wm FROM readings)
SELECT date_trunc('hour', measured_at) AS measured_hour, city, parameter_code, unit,
       CAST(CAST(((2 * sum(CAST(round(value * 10000) AS HUGEINT)) * 10000 + NULLIF(count(value), 0)) // (2 * NULLIF(count(value), 0))) AS VARCHAR) || 'e-8' AS DOUBLE) AS average_value, count(*) AS measurement_count
FROM readings
WHERE measurement_id % 50 <> 7
GROUP BY 1, 2, 3, 4
HAVING date_trunc('hour', measured_at) + INTERVAL 1 HOUR <= (SELECT wm FROM hw)
""")
def _stream_hourly(spark, sf):
    """T8 + T2: streaming hourly windows, 12 h watermark, append mode (closed
    windows); replayed readings count once."""
    c = core(spark, sf)
    return ST.hourly_stream(_replayed_feed(c), c)


@register("stream_alerts", ALERTS + """
SELECT r.sensor_id, a.measurement_measured_at, a.threshold_rule_id, a.alert_level, a.status
FROM alerts a JOIN readings r ON r.measurement_id = a.measurement_id
WHERE a.measurement_id % 50 <> 7
""")
def _stream_alerts(spark, sf):
    """T4: alert generation as a stream-static join over the inserted readings
    (a replayed reading raises no second alert)."""
    c = core(spark, sf)
    return ST.alert_stream(_replayed_feed(c), c)


@register("stream_dedupe", """
SELECT e.user_id * 1000 + p.parameter_id AS sensor_id, e.ts AS measured_at,
       CAST(CAST(e.value AS DECIMAL(12,4)) AS DOUBLE) AS value
FROM events e JOIN parameter p ON p.code = e.event_type
WHERE e.event_id % 50 <> 7
""")
def _stream_dedupe(spark, sf):
    """Original pages, then a 12 h overlap replay with corrected values,
    through the same checkpointed stream: first writer wins."""
    c = core(spark, sf)
    d = ST.new_stream_dirs(spark, "dedupe")
    ev = c.raw("events")
    B.land(B.measurement_pages(ev, c.parameter), d["landing"])
    ST.first_writer_stream(spark, d["landing"], d["table"], d["checkpoint"])
    B.land(B.measurement_pages(_overlap_replay(ev), c.parameter).withColumn("run_id", F.lit(99999999)), d["landing"])
    t = ST.first_writer_stream(spark, d["landing"], d["table"], d["checkpoint"])
    return t.select("sensor_id", "measured_at", F.col("value").cast("double").alias("value"))


# --- grid interpolation and forecasts ----------------------------------------


def _hourly_means(c):
    return R.hourly_mean(reads.hourly_series(c, limit=None, decimal_mean=True)).select(
        "city", "parameter_code", "measured_hour", F.col("average_value").alias("hourly_mean"))


def _filled(keys: str, at: str, step: str) -> str:
    """CTE ``filled``: the grid of the series ``hm`` (keys, at, v) with pos and n."""
    on = " AND ".join(f"grid.{k} = hm.{k}" for k in keys.split(", "))
    cols = ", ".join(f"grid.{k}" for k in keys.split(", "))
    over = lambda fn, c, frame: (f"{fn}({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {at} ROWS BETWEEN {frame})")
    back, ahead = "UNBOUNDED PRECEDING AND CURRENT ROW", "CURRENT ROW AND UNBOUNDED FOLLOWING"
    known = "CASE WHEN v IS NOT NULL THEN secs END"
    return f"""
, b AS (SELECT {keys}, min({at}) AS lo, max({at}) AS hi, count(*) AS points FROM hm GROUP BY {keys})
, grid AS (SELECT {keys}, points, lo, hi, UNNEST(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 {step})) AS {at} FROM b)
, g AS (SELECT {cols}, points, lo, hi, grid.{at}, hm.v, epoch(grid.{at}) AS secs
        FROM grid LEFT JOIN hm ON {on} AND hm.{at} = grid.{at})
, w AS (SELECT *, {over('last_value', 'v', back)} AS pv, {over('last_value', known, back)} AS pt,
               {over('first_value', 'v', ahead)} AS nv, {over('first_value', known, ahead)} AS nt FROM g)
, filled AS (SELECT *, CASE WHEN v IS NOT NULL THEN v WHEN nt = pt THEN pv ELSE pv + (nv - pv) * (secs - pt) / (nt - pt) END AS y,
                    row_number() OVER (PARTITION BY {keys} ORDER BY {at}) - 1 AS pos, count(*) OVER (PARTITION BY {keys}) AS n FROM w)
"""


HOURLY_GRID = HOURLY_FULL + """
, hm AS (SELECT measured_hour, city, parameter_code, CAST(CAST(((2 * sum(CAST(avg_units8 AS HUGEINT)) * 10000 + NULLIF(count(avg_units8), 0)) // (2 * NULLIF(count(avg_units8), 0))) AS VARCHAR) || 'e-12' AS DOUBLE) AS v
         FROM hourly GROUP BY ALL)
""" + _filled("city, parameter_code", "measured_hour", "HOUR")


@register("grid_interpolate", HOURLY_GRID + """
SELECT city, parameter_code, measured_hour, y AS hourly_mean, v IS NOT NULL AS is_observed FROM filled
""")
def _grid_interpolate(spark, sf):
    """Hourly grid per (city, parameter) with linear interpolation."""
    h = _hourly_means(core(spark, sf))
    return FC.regular_grid(h, ["city", "parameter_code"], "measured_hour", "hourly_mean", "1 hour")


def _fitted(keys: str, points: str, period: float, phase: str, least: int, at: str, lo: str) -> str:
    """CTE ``fitted``: the least-squares curve at ``points`` (keys, at, pos, lo, n, y: null
    where it is predicted only). Each column is made orthogonal to those before
    over the known points, one after another, and the value regressed on them."""
    over = lambda e: f"sum(CASE WHEN y IS NOT NULL THEN {e} END) OVER (PARTITION BY {keys})"
    w = f"(2 * pi() / {period})"
    a = f"({w} * ({phase.format(at)} - {phase.format(lo)} - (n - 1) / 2.0::DOUBLE))"
    sql = f"""
, x0 AS (SELECT *, pos - (n - 1) / 2.0::DOUBLE AS q1, 2 * sin({a} / 2) * sin({a} / 2) AS f2,
                sin({a}) - CASE WHEN n * {w} < 2 * pi() THEN {w} * (pos - (n - 1) / 2.0::DOUBLE) ELSE 0 END AS f3
         FROM ({points}) WHERE points >= {least})
, x1 AS (SELECT *, f2 - {over('f2')} / n - q1 * {over('f2 * q1')} / {over('q1 * q1')} AS q2,
                f3 - {over('f3')} / n - q1 * {over('f3 * q1')} / {over('q1 * q1')} AS g3 FROM x0)
, x2 AS (SELECT *, g3 - q2 * {over('g3 * q2')} / {over('q2 * q2')} AS q3 FROM x1)
, fitted AS (SELECT *, {over('y')} / n + q1 * {over('y * q1')} / {over('q1 * q1')}
                       + q2 * {over('y * q2')} / {over('q2 * q2')} + q3 * {over('y * q3')} / {over('q3 * q3')} AS curve FROM x2)
"""
    return sql


@register("forecast_hourly", HOURLY_GRID + _fitted("city, parameter_code", """
    SELECT city, parameter_code, measured_hour, pos, lo, n, y, points FROM filled
    UNION ALL SELECT city, parameter_code, hi + to_hours(k), n - 1 + k, lo, n, NULL, points
    FROM (SELECT DISTINCT city, parameter_code, lo, hi, n, points FROM filled), range(1, 73) r(k)""",
    24.0, "hour({})", 6, "measured_hour", "lo") + """
SELECT city, parameter_code, measured_hour, round(greatest(curve, 0), 6) AS forecast_value FROM fitted WHERE y IS NULL
""")
def _forecast_hourly(spark, sf):
    """M9 + F18: 72 h forecast per (city, parameter) from [1, t, sin/cos 24 h]
    least squares, to six places."""
    f = FC.hourly_forecast(_hourly_means(core(spark, sf)), ["city", "parameter_code"])
    return f.withColumn("forecast_value", F.round("forecast_value", 6))


@register("forecast_daily", HOURLY_FULL + """
, hm AS (SELECT CAST(measured_hour AS DATE) AS day, parameter_code, CAST(CAST(((2 * sum(CAST(avg_units8 AS HUGEINT)) * 10000 + NULLIF(count(avg_units8), 0)) // (2 * NULLIF(count(avg_units8), 0))) AS VARCHAR) || 'e-12' AS DOUBLE) AS v
         FROM hourly GROUP BY ALL)
""" + _filled("parameter_code", "day", "DAY") + _fitted("parameter_code", """
    SELECT parameter_code, day, pos, lo, n, y, points FROM filled
    UNION ALL SELECT parameter_code, hi + to_days(CAST(k AS INTEGER)), n - 1 + k, lo, n, NULL, points
    FROM (SELECT DISTINCT parameter_code, lo, hi, n, points FROM filled), range(1, 15) r(k)""",
    365.25, "dayofyear({})", 4, "day", "lo") + """
SELECT parameter_code, CAST(day AS DATE) AS day, round(greatest(curve, 0), 6) AS predicted_daily_mean FROM fitted
""")
def _forecast_daily(spark, sf):
    """M10 + F18: daily curve per parameter over history + 14 days, yearly
    seasonality, to six places."""
    d = R.daily_mean(reads.hourly_series(core(spark, sf), limit=None, decimal_mean=True))
    return FC.daily_forecast(d, ["parameter_code"]).withColumn("predicted_daily_mean", F.round("predicted_daily_mean", 6))


# --- Spark ML train / select / save / load / score ----------------------------


_TRAINED: dict = {}


def _train(c):
    """One fit per core (both ML queries share it)."""
    from aerolith.sources.store import PUBLISH_LOCK
    with PUBLISH_LOCK:
        if id(c) not in _TRAINED or _TRAINED[id(c)][0] is not c:
            split = FT.chronological_split(_features(c))
            _TRAINED[id(c)] = (c, ML.evaluate(split))
        return _TRAINED[id(c)][1]


@register("ml_model_metrics")
def _ml_model_metrics(spark, sf):
    """M3-M6: both candidates' MAE/RMSE/R2 on the chronological test split, chosen flag."""
    _model, metrics = _train(core(spark, sf))
    return metrics


@register("ml_train_predict")
def _ml_train_predict(spark, sf):
    """M3-M8 + S16 + E9: train, pick, save, reload, score the latest inputs, build prediction rows."""
    c = core(spark, sf)
    model, metrics = _train(c)
    path = scratch_path(spark, "models", uuid.uuid4().hex[:12])
    ML.save(model, metrics, path, FT.MODEL_VERSION, CREATED_AT)
    loaded, bundle = ML.load(spark, path)
    scored = ML.score(loaded, _inputs(c))
    rows = FT.prediction_rows(scored, F.col("prediction"), bundle["model_name"], CREATED_AT)
    return FT.load_prediction_facts(rows)


# --- whole load, seeds, rewrite, back-fill, dashboard filter, caps --------------


@register("etl_load_counts", ALERTS + FIRST_LOAD + """
SELECT (SELECT count(*) FROM parameter) AS parameters,
       (SELECT count(*) FROM location WHERE is_active) AS locations,
       (SELECT count(*) FROM sensor WHERE is_active) AS sensors,
       (SELECT count(*) FROM fact_m) AS readings,
       (SELECT count(*) FROM alerts a JOIN m ON m.measurement_id = a.measurement_id
          JOIN sensor s ON s.sensor_id = m.sensor_id
          JOIN location l ON l.location_id = s.location_id AND l.is_active) AS alerts
""")
def _etl_load_counts(spark, sf):
    """First whole load into an empty warehouse; the five counts."""
    c = core(spark, sf)
    root = scratch_path(spark, "warehouse", uuid.uuid4().hex[:12])
    n = PL.run_etl(spark, c, root, SC.stored_alerts(c), SC.AS_OF_1)
    return spark.createDataFrame([tuple(int(n[k]) for k in ("parameters", "locations", "sensors", "readings",
                                                           "alerts"))],
                                 "parameters long, locations long, sensors long, readings long, alerts long")


@register("seed_parameters", """
, seeds AS (SELECT * FROM (VALUES
    (2, 'pm25', 'PM2.5', 'Fine particulate matter with diameter smaller than 2.5 micrometers', 'ug/m3'),
    (1, 'pm10', 'PM10', 'Particulate matter with diameter smaller than 10 micrometers', 'ug/m3'),
    (7, 'no2', 'NO2', 'Nitrogen dioxide', 'ug/m3'),
    (3, 'o3', 'O3', 'Ozone', 'ug/m3')) v(openaq_parameter_id, code, display_name, description, preferred_unit))
SELECT code, parameter_id, openaq_parameter_id, display_name, description, preferred_unit FROM parameter
WHERE code NOT IN (SELECT code FROM seeds)
UNION ALL
SELECT s.code, COALESCE(p.parameter_id, 100 + s.openaq_parameter_id), s.openaq_parameter_id, s.display_name,
       s.description, s.preferred_unit
FROM seeds s LEFT JOIN parameter p ON p.code = s.code
""")
def _seed_parameters(spark, sf):
    """Seeded parameters applied over the stored ones (overwrite by code)."""
    out = SD.seed_parameters(spark, core(spark, sf).parameter)
    return out.select("code", "parameter_id", "openaq_parameter_id", "display_name", "description",
                      "preferred_unit")


@register("partition_rewrite", """
SELECT measured_month, count(*) AS readings, min(measurement_id) AS min_id, max(measurement_id) AS max_id,
       CAST(sum(measurement_id) AS BIGINT) AS id_sum
FROM m GROUP BY 1
""")
def _partition_rewrite(spark, sf):
    """An unpartitioned copy of the readings rewritten as month partitions, ids kept."""
    c = core(spark, sf)
    base = scratch_path(spark, "rewrite", uuid.uuid4().hex[:12])
    c.measurement.drop("measured_month").write.mode("overwrite").parquet(base + "/flat")
    t = PL.rewrite_partitioned(spark, base + "/flat", base + "/by_month")
    return t.groupBy("measured_month").agg(F.count(F.lit(1)).alias("readings"),
                                           F.min("measurement_id").alias("min_id"),
                                           F.max("measurement_id").alias("max_id"),
                                           F.sum("measurement_id").alias("id_sum"))


MONTHS_SQL = """
, spread AS (SELECT measurement_id, value, measured_at + to_months(CAST(sensor_id % 7 AS INTEGER)) AS moved_at FROM m)
, by_month AS (SELECT *, CAST(date_trunc('month', moved_at) AS DATE) AS measured_month FROM spread)
"""


def _by_month(c):
    """S13 + S14: readings spread over seven months, written without partitions, rewritten by month."""
    base = scratch_path(c.spark, "rewrite", uuid.uuid4().hex[:12])
    later = F.expr("measured_at + make_ym_interval(0, CAST(sensor_id % 7 AS INT))")
    c.measurement.select("measurement_id", "value", later.alias("measured_at")).write.mode("overwrite").parquet(base + "/flat")
    return PL.rewrite_partitioned(c.spark, base + "/flat", base + "/by_month")


@register("partition_rewrite_months", MONTHS_SQL + """
SELECT measured_month, count(*) AS readings, min(measurement_id) AS min_id, max(measurement_id) AS max_id FROM by_month GROUP BY 1
""")
def _partition_rewrite_months(spark, sf):
    """S13 + S14: several month partitions, ids kept."""
    return _by_month(core(spark, sf)).groupBy("measured_month").agg(
        F.count(F.lit(1)).alias("readings"), F.min("measurement_id").alias("min_id"), F.max("measurement_id").alias("max_id"))


@register("weekend_readings_by_quarter", MONTHS_SQL + """
SELECT CAST(quarter(moved_at) AS INTEGER) AS quarter, CAST(isodow(moved_at) AS INTEGER) AS weekday, count(*) AS readings,
       max(CAST(value AS DOUBLE)) AS max_value
FROM by_month WHERE quarter(moved_at) = 2 AND isodow(moved_at) IN (6, 7) GROUP BY ALL
""")
def _weekend_readings_by_quarter(spark, sf):
    """V4 + E1: a filter on the date dimension prunes the months that are read."""
    c = core(spark, sf)
    days = dims.dim_date(spark).filter("quarter = 2 AND is_weekend").select("full_date", "quarter", "weekday")
    return FT.by_date(_by_month(c), days).groupBy("quarter", "weekday").agg(
        F.count(F.lit(1)).alias("readings"), F.max(F.col("value").cast("double")).alias("max_value"))


@register("alert_time_backfill", ALERTS + """
SELECT pollution_alert_id, measurement_measured_at FROM alerts
""")
def _alert_time_backfill(spark, sf):
    """Alert rows missing their reading time get it from the reading by id."""
    c = core(spark, sf)
    a = SC.stored_alerts(c)
    blank = a.withColumn("measurement_measured_at",
                         F.when(F.col("pollution_alert_id") % 2 == 0, F.col("measurement_measured_at")))
    out = dims.backfill_from_parent(blank, c.measurement, ["measurement_id"], ["measurement_id"],
                                    "measurement_measured_at", "measured_at")
    return out.select("pollution_alert_id", "measurement_measured_at")


@register("dashboard_view", """
SELECT measured_at, city, location_name, parameter_code, CAST(value AS DOUBLE) AS value
FROM readings
WHERE parameter_code = 'purchase'
  AND measured_at >= TIMESTAMP '2024-01-03 00:00:00' AND measured_at < TIMESTAMP '2024-01-11 00:00:00'
""")
def _dashboard_view(spark, sf):
    """Dashboard filter: city 'All', one parameter, day range [start, end + 1 day)."""
    r = reads.readings(core(spark, sf))
    r = all_option(r, "city", "All")
    r = all_option(r, "parameter_code", "purchase")
    r = day_range(r, "measured_at", "2024-01-03", "2024-01-10", month_column="measured_month")
    return r.select("measured_at", "city", "location_name", "parameter_code",
                    F.col("value").cast("double").alias("value"))


@register("location_scope_capped", """
SELECT location_id, name, city FROM (
  SELECT location_id, CASE WHEN location_id % 11 = 5 THEN 'OpenAQ location ' || CAST(location_id AS VARCHAR)
                           ELSE name END AS name, city,
         CASE WHEN location_id % 11 = 5 THEN NULL ELSE name END AS raw_name
  FROM location)
WHERE lower(concat_ws(' ', city, raw_name)) LIKE '%nation_2%'
ORDER BY location_id LIMIT 50
""")
def _location_scope_capped(spark, sf):
    """S7 + S8: in-scope locations from the pages, capped to the first 50 in page order."""
    pages = _location_records(core(spark, sf))
    locs = B.distinct_locations(
        B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON)))
    return B.first_n(B.in_scope(locs, cities=["nation_2"]), ["location_id"], 50).select("location_id", "name",
                                                                                        "city")


@register("open_alerts_first10", ALERTS_ENRICHED + """
SELECT pollution_alert_id, generated_at, alert_level, city, location_name, parameter_code
FROM ae WHERE status = 'open'
ORDER BY generated_at DESC, pollution_alert_id DESC LIMIT 10
""")
def _open_alerts_first10(spark, sf):
    """P8 + L8: the first ten open alerts of the newest-first alert list."""
    a = _alerts_enriched(core(spark, sf)).filter(F.col("status") == "open")
    return a.select("pollution_alert_id", "generated_at", "alert_level", "city", "location_name",
                    "parameter_code").orderBy(F.desc("generated_at"), F.desc("pollution_alert_id")).limit(10)


@register("sensors_in_scope_capped", """
SELECT s.sensor_id, s.location_id, p.code AS parameter_code
FROM sensor s JOIN parameter p ON p.parameter_id = s.parameter_id
WHERE lower(p.code) IN ('click', 'view')
ORDER BY s.location_id, s.sensor_id
LIMIT 100
""")
def _sensors_in_scope_capped(spark, sf):
    """S7 (sensor scope by parameter name) + S8 (first N sensors overall, page order)."""
    pages = _location_records(core(spark, sf))
    locs = B.parse_locations(B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON))
    fallback = pages.filter(F.col("endpoint") == "/v3/locations/{id}/sensors")
    sensors = B.sensors_of(locs, fallback, parameters=["click", "VIEW"])
    return B.first_n(sensors, ["location_id", "sensor_id"], 100).select("sensor_id", "location_id", "parameter_code")


# queries of their own modules, registered with these
from aerolith.plans import ingest_queries, stream_queries  # noqa: E402,F401
