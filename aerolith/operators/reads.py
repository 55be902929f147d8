"""Read models Q1-Q8 (the API's list endpoints) as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import scalars as S
from aerolith.operators.filters import optional_eq, time_bounds, top_n


def readings(core, columns: tuple = ()) -> DataFrame:
    """Reading -> sensor -> location -> parameter (inner equi chain).

    Dimension sides are scanned from stored Parquet, so the planner broadcasts
    them by measured file size and falls back to a shuffle join beyond the
    threshold; AQE re-checks at runtime.
    """
    m = core.measurement.select("measurement_id", "sensor_id", "measured_at", "value", "unit",
                                "ingestion_run_id", "measured_month", *columns)
    s = core.sensor.select("sensor_id", "location_id", "parameter_id")
    l_ = core.location.select("location_id", "city", F.col("name").alias("location_name"), "nation_key")
    p = core.parameter.select("parameter_id", F.col("code").alias("parameter_code"),
                              F.col("display_name").alias("parameter_name"))
    return m.join(s, "sensor_id").join(l_, "location_id").join(p, "parameter_id")


def locations_summary(core) -> DataFrame:
    """Q1: active locations with active sensor count and latest reading time.

    Readings are aggregated per sensor first (map-side partial aggregation), so
    the location-level join sees one row per sensor instead of every reading.
    """
    latest = core.measurement.groupBy("sensor_id").agg(F.max("measured_at").alias("latest_at"))
    s = core.sensor.select("sensor_id", "location_id", F.col("is_active").alias("sensor_active"))
    per_sensor = s.join(latest, "sensor_id", "left")
    loc = core.location.filter("is_active")
    joined = loc.join(per_sensor, "location_id", "left")
    return joined.groupBy("location_id", "openaq_location_id", "name", "city", "country",
                          "latitude", "longitude", "timezone").agg(
        F.countDistinct(F.when(F.col("sensor_active"), F.col("sensor_id"))).alias("active_sensor_count"),
        F.max("latest_at").alias("latest_measurement_at"),
    ).select("location_id", "openaq_location_id", "name", "city", "country",
             F.col("latitude").cast("double").alias("latitude"),
             F.col("longitude").cast("double").alias("longitude"),
             "timezone", "active_sensor_count", "latest_measurement_at") \
        .orderBy("city", "name", "location_id")


def measurements_list(core, city=None, parameter=None, date_from=None, date_to=None,
                      limit: int = 200) -> DataFrame:
    """Q2: readings newest first (limit 1..10000)."""
    r = readings(core)
    r = optional_eq(r, "city", city)
    r = optional_eq(r, "parameter_code", parameter)
    r = time_bounds(r, "measured_at", date_from, date_to, month_column="measured_month")
    out = r.select("measurement_id", "measured_at", F.col("value").cast("double").alias("value"),
                   "unit", "city", "location_name", "parameter_code", "parameter_name",
                   "sensor_id", "ingestion_run_id")
    return top_n(out, [F.desc("measured_at"), F.desc("measurement_id")], limit, 1, 10000)


def hourly_series(core, city=None, parameter=None, date_from=None, date_to=None,
                  limit: int | None = 10000, decimal_mean: bool = False) -> DataFrame:
    """Q3: hourly mean and count per (hour, city, parameter, unit) (A3 + L2).

    The mean is taken over the decimal values (exact, order-independent);
    ``decimal_mean`` keeps it decimal for means of means (A6, A7)."""
    r = readings(core)
    r = optional_eq(r, "city", city)
    r = optional_eq(r, "parameter_code", parameter)
    r = time_bounds(r, "measured_at", date_from, date_to, month_column="measured_month")
    agg = r.groupBy(S.hour_floor("measured_at").alias("measured_hour"), "city", "parameter_code", "unit") \
        .agg((F.avg("value") if decimal_mean else S.exact_mean("value")).alias("average_value"),
             F.count(F.lit(1)).alias("measurement_count"))
    return top_n(agg, [F.desc("measured_hour"), "city", "parameter_code", "unit"], limit, 1, 50000)


def thresholds_list(core, rules: DataFrame | None = None, city=None, parameter=None) -> DataFrame:
    """Q5: rules with their parameter, ordered by city, code, minimum."""
    rules = core.threshold_rule if rules is None else rules
    p = core.parameter.select("parameter_id", F.col("code").alias("parameter_code"),
                              F.col("display_name").alias("parameter_name"))
    r = rules.join(p, "parameter_id")
    r = optional_eq(r, "city", city)
    r = optional_eq(r, "parameter_code", parameter)
    return r.select("threshold_rule_id", "parameter_id", "parameter_code", "parameter_name", "city",
                    "warning_level", F.col("min_value").cast("double").alias("min_value"),
                    "is_active", "updated_at") \
        .orderBy("city", "parameter_code", "min_value", "threshold_rule_id")


def station_series(core, city=None, station=None, parameter=None) -> DataFrame:
    """Q8: station drill-down, oldest first."""
    r = readings(core)
    r = optional_eq(r, "city", city)
    r = optional_eq(r, "location_name", station)
    r = optional_eq(r, "parameter_code", parameter)
    return r.select("measured_at", "city", "location_name", "parameter_code",
                    F.col("value").cast("double").alias("value"), "unit", "sensor_id") \
        .orderBy("city", "location_name", "parameter_code", "measured_at", "sensor_id")


def alerts_list(core, alerts_df: DataFrame, city=None, parameter=None, status=None,
                limit: int = 200) -> DataFrame:
    """Q4: J11 alert -> reading -> rule -> sensor -> location -> parameter."""
    r = readings(core).select(F.col("measurement_id"), F.col("measured_at").alias("measurement_measured_at"),
                              F.col("measured_at"), "value", "unit", "city", "location_name",
                              "parameter_code", "parameter_name")
    t = core.threshold_rule.select("threshold_rule_id", F.col("min_value").alias("threshold_value"))
    j = alerts_df.join(r, ["measurement_id", "measurement_measured_at"]).join(t, "threshold_rule_id")
    j = optional_eq(j, "city", city)
    j = optional_eq(j, "parameter_code", parameter)
    j = optional_eq(j, "status", status)
    out = j.select("pollution_alert_id", "generated_at", "alert_level", "status",
                   F.col("value").cast("double").alias("measurement_value"),
                   F.col("unit").alias("measurement_unit"), "measured_at", "city", "location_name",
                   "parameter_code", "parameter_name",
                   F.col("threshold_value").cast("double").alias("threshold_value"), "reviewed_at", "notes")
    return top_n(out, [F.desc("generated_at"), F.desc("pollution_alert_id")], limit, 1, 1000)
