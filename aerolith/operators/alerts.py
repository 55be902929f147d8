"""Alert generation (T4/J13/W9), outbox (T5/T6), review (E12), rule upserts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.operators.dims import last_per_key, upsert_by_key, with_new_ids


def rule_bands(rules: DataFrame) -> DataFrame:
    """Turn the active, non-low rules of each (parameter, city) into disjoint
    value bands ``[lo, hi)``.

    The trigger picks, per reading, the rule with the highest ``min_value``
    (then highest id) not above the value. Ordered by (min, id), that winner
    owns exactly the interval up to the next rule's minimum, so equal minimums
    give empty bands to the lower ids. With disjoint bands every reading
    matches at most one rule: an equi join on (parameter, city) plus a range
    residual, no ranking and no shuffle of the readings. The window runs over
    the rule table (a few rows per city and parameter), not over readings.
    """
    r = rules.filter(F.col("is_active") & (F.col("warning_level") != "low"))
    w = Window.partitionBy("parameter_id", "city").orderBy("min_value", "threshold_rule_id")
    return r.select("parameter_id", "city", "threshold_rule_id", "warning_level",
                    F.col("min_value").alias("band_lo"),
                    F.lead("min_value").over(w).alias("band_hi"))


def generate_alerts(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """At most one open alert per reading.

    ``readings`` needs measurement_id, measured_at, value, parameter_id, city.
    The alert id is the reading id (the unique (measurement, rule) pair
    collapses to one alert per reading); generated_at is the reading time.
    """
    b = rule_bands(rules)
    cond = (readings["parameter_id"] == b["parameter_id"]) & (readings["city"] == b["city"]) & \
        (readings["value"] >= b["band_lo"]) & (b["band_hi"].isNull() | (readings["value"] < b["band_hi"]))
    j = readings.join(b, cond, "inner")
    return j.select(
        readings["measurement_id"].alias("pollution_alert_id"),
        readings["measurement_id"],
        readings["measured_at"].alias("measurement_measured_at"),
        b["threshold_rule_id"],
        b["warning_level"].alias("alert_level"),
        F.lit("open").alias("status"),
        readings["measured_at"].alias("generated_at"),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        F.lit(None).cast("string").alias("notes"),
    )


def alert_readings(core) -> DataFrame:
    """Readings with the columns the alert trigger reads (sensor -> location)."""
    m = core.measurement.select("measurement_id", "sensor_id", "measured_at", "value")
    s = core.sensor.select("sensor_id", "location_id", "parameter_id")
    loc = core.location.select("location_id", "city")
    return m.join(s, "sensor_id").join(loc, "location_id")


def alerts(core) -> DataFrame:
    return generate_alerts(alert_readings(core), core.threshold_rule)


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def alert_payload(df: DataFrame):
    """F16: payload with explicit nulls; times as ISO text."""
    return S.json_object_keep_nulls(alert_level=F.col("alert_level"),
                                    generated_at=_ts_text(F.col("generated_at")),
                                    reviewed_at=_ts_text(F.col("reviewed_at")),
                                    notes=F.col("notes"))


def outbox_events(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """T5: outbox events from a snapshot diff of the alert table.

    New alert -> 'created' (previous status NULL); existing alert whose status
    really changed (null-safe) -> 'status_changed'; notes-only edits emit
    nothing. Full outer join on the alert id.
    """
    keep = ["pollution_alert_id", "measurement_id", "measurement_measured_at", "threshold_rule_id",
            "alert_level", "status", "generated_at", "reviewed_at", "notes"]
    a = after.select(*keep)
    if before is None:
        created = a.select("*", F.lit("created").alias("event_type"),
                           F.lit(None).cast("string").alias("previous_status"))
    else:
        b = before.select("pollution_alert_id", F.col("status").alias("previous_status"),
                          F.lit(True).alias("__seen"))
        j = a.join(b, "pollution_alert_id", "left")
        j = j.filter(F.col("__seen").isNull() | ~F.col("status").eqNullSafe(F.col("previous_status")))
        created = j.select(*keep, F.when(F.col("__seen").isNull(), "created").otherwise("status_changed")
                           .alias("event_type"),
                           F.when(F.col("__seen").isNull(), F.lit(None)).otherwise(F.col("previous_status"))
                           .cast("string").alias("previous_status"))
    return created.select("pollution_alert_id", "measurement_id", "measurement_measured_at", "threshold_rule_id",
                          "event_type", "previous_status", F.col("status").alias("current_status"),
                          alert_payload(created).alias("payload"),
                          F.coalesce("reviewed_at", "generated_at").alias("created_at"),
                          F.lit(None).cast("timestamp_ntz").alias("processed_at"))


def pending_outbox(outbox: DataFrame, limit: int | None = None) -> DataFrame:
    """Unprocessed events oldest first."""
    p = outbox.filter(F.col("processed_at").isNull())
    p = p.orderBy("created_at", "pollution_alert_id", "event_type")
    return p.limit(limit) if limit else p


def review_alerts(alerts_df: DataFrame, commands: DataFrame) -> DataFrame:
    """Apply review commands (pollution_alert_id, status, notes, command_at).

    notes = coalesce(new, old); reviewed_at = coalesce(old, command time) when
    the new status is reviewed or closed, else unchanged. Commands for unknown
    ids match nothing (not found). Invalid statuses are rejected upstream (P10).
    Commands for one alert are folded as if applied one after another: the last
    status, the last note given, the earliest time of a review or closure.
    """
    order = F.struct("command_at", "status", "notes")
    decided = F.col("status").isin("reviewed", "closed")
    c = commands.groupBy("pollution_alert_id").agg(
        F.max_by("status", order).alias("__new_status"),
        F.max_by("notes", F.when(F.col("notes").isNotNull(), order)).alias("__new_notes"),
        F.min(F.when(decided, F.col("command_at"))).alias("__at"))
    j = alerts_df.join(c, "pollution_alert_id", "left")
    has = F.col("__new_status").isNotNull()
    status = F.when(has, F.col("__new_status")).otherwise(F.col("status"))
    reviewed = F.coalesce(F.col("reviewed_at"), F.col("__at"))
    notes = F.when(has, F.coalesce(F.col("__new_notes"), F.col("notes"))).otherwise(F.col("notes"))
    cols = [c_ for c_ in alerts_df.columns if c_ not in ("status", "reviewed_at", "notes")]
    return j.select(*cols, status.alias("status"), reviewed.alias("reviewed_at"), notes.alias("notes"))


def valid_review_commands(commands: DataFrame) -> DataFrame:
    """P10: keep commands whose status is a known alert status."""
    return commands.filter(F.col("status").isin(*S.ALERT_STATUSES))


def threshold_upsert(rules: DataFrame, parameter: DataFrame, commands: DataFrame, at) -> DataFrame:
    """Upsert rules by (parameter, city, warning_level).

    Commands carry a parameter *code*; unknown codes match no parameter and
    change nothing. Updated/inserted rows get min_value, is_active, updated_at;
    inserted ones the next rule ids. Commands with an invalid level or a
    negative minimum are rejected (P10). Of several commands for one rule the
    last by ``command_at`` (where given) counts.
    """
    if isinstance(at, str):
        at = dt.datetime.fromisoformat(at)
    cmd = commands.filter(F.col("warning_level").isin(*S.WARNING_LEVELS) & (F.col("min_value") >= 0))
    cmd = cmd.join(parameter.select(F.col("code").alias("parameter_code"), "parameter_id"), "parameter_code")
    key = ["parameter_id", "city", "warning_level"]
    when = ["command_at"] if "command_at" in commands.columns else []
    new = last_per_key(cmd.select(*key, F.col("min_value").cast("decimal(12,4)").alias("min_value"), "is_active",
                                  *when), key, when)
    new = with_new_ids(new.drop(*when), rules, key, "threshold_rule_id") \
        .withColumn("updated_at", F.lit(at).cast("timestamp_ntz"))
    cur = rules.select("parameter_id", "city", "warning_level", "threshold_rule_id", "min_value",
                       "is_active", "updated_at")
    return upsert_by_key(new, cur, key, update=["min_value", "is_active", "updated_at"])


def default_rules(scope: DataFrame, existing: DataFrame, parameter_id_col: str = "parameter_id") -> DataFrame:
    """Default rules (the four levels) for every (city, parameter) in
    ``scope``; rows whose key already exists are left alone (do nothing on
    conflict); new ones get the next rule ids. Levels come from ``explode`` of
    a literal array."""
    from aerolith.sources.driver_tables import LEVEL_BASE_MIN
    levels = F.array(*[F.struct(F.lit(code).alias("warning_level"), F.lit(base).alias("base"))
                       for code, _i, base in LEVEL_BASE_MIN])
    cand = scope.select("city", parameter_id_col, F.explode(levels).alias("lv")).select(
        "city", F.col(parameter_id_col).alias("parameter_id"),
        F.col("lv.warning_level").alias("warning_level"),
        F.col("lv.base").cast("decimal(12,4)").alias("min_value"), F.lit(True).alias("is_active"))
    key = ["parameter_id", "city", "warning_level"]
    new = cand.dropDuplicates(key).join(existing.select(*key), key, "left_anti")
    return with_new_ids(new, existing, key, "threshold_rule_id")


def review_not_found(alerts_df: DataFrame, commands: DataFrame) -> DataFrame:
    """Review commands naming no stored alert (the 'not found' answers)."""
    return commands.join(alerts_df.select("pollution_alert_id"), "pollution_alert_id", "left_anti")


def threshold_update_by_id(rules: DataFrame, parameter: DataFrame, commands: DataFrame, at) -> tuple:
    """E11 (by id): full-row update of rules named by ``threshold_rule_id``.

    Commands carry parameter_code, city, warning_level, min_value, is_active.
    Returns (new rules, rejected commands with a reason): unknown rule id ->
    'not found'; unknown parameter code, invalid level or negative minimum ->
    'invalid'. Valid commands replace every listed column and stamp
    ``updated_at``; of several for one rule the last by ``command_at`` (where
    given) counts."""
    if isinstance(at, str):
        at = dt.datetime.fromisoformat(at)
    p = parameter.select(F.col("code").alias("parameter_code"), F.col("parameter_id").alias("__pid"))
    c = commands.join(p, "parameter_code", "left") \
        .join(rules.select("threshold_rule_id", F.lit(True).alias("__exists")), "threshold_rule_id", "left")
    reason = (F.when(F.col("__exists").isNull(), F.lit("not found"))
              .when(F.col("__pid").isNull() | ~F.col("warning_level").isin(*S.WARNING_LEVELS)
                    | (F.col("min_value") < 0), F.lit("invalid")))
    c = c.withColumn("reason", reason)
    when = ["command_at"] if "command_at" in commands.columns else []
    ok = c.filter(F.col("reason").isNull()).select(
        "threshold_rule_id", F.col("__pid").cast("int").alias("parameter_id"), "city", "warning_level",
        F.col("min_value").cast("decimal(12,4)").alias("min_value"), "is_active",
        F.lit(at).cast("timestamp_ntz").alias("updated_at"), *when)
    ok = last_per_key(ok, ["threshold_rule_id"], when).drop(*when)
    cols = ["parameter_id", "city", "warning_level", "min_value", "is_active", "updated_at"]
    new = upsert_by_key(ok, rules.select("threshold_rule_id", *cols), ["threshold_rule_id"], update=cols)
    return new, c.filter(F.col("reason").isNotNull()).select(*commands.columns, "reason")
