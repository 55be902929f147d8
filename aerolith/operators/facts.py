"""Fact loads E7, E8 (idempotent, insert-only) and the negative purge P5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import scalars as S
from aerolith.operators import scd2


def quality_filter(m: DataFrame, value: str = "value") -> DataFrame:
    """Not null, >= 0, < 100000."""
    v = F.col(value)
    return m.filter(v.isNotNull() & (v >= 0) & (v < S.VALUE_OPEN_MAX))


READING_COLS = ["measurement_id", "sensor_id", "measured_at", "value", "unit", "ingestion_run_id"]


def _parameters(core, dim_parameter: DataFrame | None) -> DataFrame:
    """parameter_id, code and the dimension's key (in a first load the source id)."""
    if dim_parameter is None:
        return core.parameter.select("parameter_id", F.col("code").alias("parameter_code"), F.col("parameter_id").alias("parameter_key"))
    return dim_parameter.select(F.col("source_parameter_id").alias("parameter_id"), F.col("code").alias("parameter_code"), "parameter_key")


def load_measurement_facts(core, dim_location: DataFrame, dim_sensor: DataFrame, existing: DataFrame | None = None,
                           incremental: bool = False, dim_parameter: DataFrame | None = None) -> DataFrame:
    """New reading facts.

    Readings join their *current* sensor and location versions (J3) and the
    parameter; readings without a current version drop out now and are picked
    up by a later run (the anti join makes the load idempotent, J6). The risk
    band (J4) is a CASE over the four fixed bands. ``incremental``: see
    ``not_stored``.
    """
    m = quality_filter(core.measurement.select(*READING_COLS))
    if existing is not None and not incremental:
        m = m.join(existing.select(F.col("source_measurement_id").alias("measurement_id")),
                   "measurement_id", "left_anti")
    s = core.sensor.select("sensor_id", "location_id", "parameter_id")
    ds = scd2.with_surrogate(scd2.current(dim_sensor), "source_sensor_id", "sensor_key") \
        .select(F.col("source_sensor_id").alias("sensor_id"), "sensor_key")
    dl = scd2.with_surrogate(scd2.current(dim_location), "source_location_id", "location_key") \
        .select(F.col("source_location_id").alias("location_id"), "location_key")
    p = _parameters(core, dim_parameter)
    j = m.join(s, "sensor_id").join(ds, "sensor_id").join(dl, "location_id").join(p, "parameter_id")
    rows = j.select(
        F.col("measurement_id").alias("source_measurement_id"),
        "location_key", "sensor_key", "parameter_key",
        F.col("location_id").alias("source_location_id"),
        F.col("sensor_id").alias("source_sensor_id"),
        "parameter_code",
        S.date_key("measured_at").alias("date_key"),
        S.time_key("measured_at").alias("time_key"),
        S.risk_class_key("value").alias("risk_class_key"),
        "measured_at",
        F.col("value").cast("double").alias("measurement_value"),
        "unit", "ingestion_run_id",
    )
    return not_stored(rows, existing) if existing is not None and incremental else rows


def not_stored(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Loadable reading facts that are not stored yet, without joining every id.

    Stored facts of a (run, sensor) are always among its loadable ones while
    the sensor is loadable (readings are never changed or removed), so equal
    counts mean equal rows. Only groups whose counts differ are anti joined by
    id. Exact after a full load, with late readings of old runs and with
    sensors that become loadable later; it needs no stored watermark.
    """
    group = ["ingestion_run_id", "source_sensor_id"]

    def counts(df, run, sensor, n):
        return df.select(*[F.col(c).alias(a) for c, a in zip(group, (run, sensor))]) \
            .groupBy(run, sensor).agg(F.count(F.lit(1)).alias(n))

    def within(df, groups, how):
        return df.join(groups, F.col(group[0]).eqNullSafe(F.col("__run")) &
                       F.col(group[1]).eqNullSafe(F.col("__sensor")), how)
    loadable = counts(rows, "__run", "__sensor", "__n")
    stored = counts(existing, "__run_m", "__sensor_m", "__m")
    changed = loadable.join(stored, F.col("__run").eqNullSafe(F.col("__run_m")) &
                            F.col("__sensor").eqNullSafe(F.col("__sensor_m")), "left") \
        .filter(F.col("__n") != F.coalesce("__m", F.lit(0))).select("__run", "__sensor")
    seen = within(existing, changed, "left_semi").select("source_measurement_id")
    return within(rows, changed, "left_semi").join(seen, "source_measurement_id", "left_anti")


def load_alert_facts(core, alerts: DataFrame, dim_location: DataFrame, existing: DataFrame | None = None,
                     dim_parameter: DataFrame | None = None) -> DataFrame:
    """New alert facts. Alert -> reading by (id, time) (J10), -> sensor ->
    current location version, -> parameter; risk key by alert level code (J5).
    Insert-only: later status changes do not reach the fact."""
    a = alerts
    if existing is not None:
        a = a.join(existing.select(F.col("source_alert_id").alias("pollution_alert_id")),
                   "pollution_alert_id", "left_anti")
    m = core.measurement.select("measurement_id", F.col("measured_at").alias("measurement_measured_at"),
                                "sensor_id", "value")
    s = core.sensor.select("sensor_id", "location_id", "parameter_id")
    dl = scd2.with_surrogate(scd2.current(dim_location), "source_location_id", "location_key") \
        .select(F.col("source_location_id").alias("location_id"), "location_key")
    p = _parameters(core, dim_parameter)
    j = a.join(m, ["measurement_id", "measurement_measured_at"]).join(s, "sensor_id") \
        .join(dl, "location_id").join(p, "parameter_id")
    return j.select(
        F.col("pollution_alert_id").alias("source_alert_id"),
        "location_key", "parameter_key",
        F.col("location_id").alias("source_location_id"),
        "parameter_code",
        S.risk_key_for_code("alert_level").alias("risk_class_key"),
        S.date_key("generated_at").alias("date_key"),
        S.time_key("generated_at").alias("time_key"),
        "alert_level",
        F.col("status").alias("alert_status"),
        F.col("value").cast("double").alias("measurement_value"),
        "generated_at",
    )


def purge_negative(fact: DataFrame, value: str = "measurement_value") -> DataFrame:
    """P5: rewrite of a fact without negative values (NULLs are kept)."""
    return fact.filter(F.col(value).isNull() | (F.col(value) >= 0))


def refresh_alert_status(fact: DataFrame, alerts: DataFrame) -> DataFrame:
    """Option to the insert-only alert fact: take the current status of each
    alert (a keyed update; facts without a stored alert keep theirs)."""
    cur = alerts.select(F.col("pollution_alert_id").alias("source_alert_id"), F.col("status").alias("__status"))
    return fact.join(cur, "source_alert_id", "left") \
        .withColumn("alert_status", F.coalesce("__status", "alert_status")).drop("__status")
