"""Ingestion run log (S18), run status (T7), run reads (Q6, A5, A16, A17), lower bound."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.operators.filters import edge_months, top_n

#: no error message is shorter, so few of a run's messages can fit its text
LEAST_MESSAGE = 12

RUN_COLS = ["ingestion_run_id", "run_type", "status", "started_at", "finished_at",
            "records_inserted", "records_failed", "error_message"]


def run_status(records_failed, run_error) -> F.Column:
    """Failed on a run-level error, partial when anything failed, else succeeded."""
    return (F.when(run_error, F.lit("failed"))
            .when(records_failed > 0, F.lit("partial"))
            .otherwise(F.lit("succeeded")))


def error_texts(errors: DataFrame, key: list[str], order: str, message: str,
                cap: int = S.ERROR_TEXT_CAP, least: int = LEAST_MESSAGE) -> DataFrame:
    """per ``key`` the messages in the given order, joined by ' | ' and
    capped, as ``error_message``.

    Only messages that begin within the cap can be seen, and at ``least``
    characters each no more than cap / (least + 3) of them do: a ranking keeps
    that many rows a key (each task its own first ones before the shuffle), a
    running length cuts them to those within the cap, and these are joined. So
    a run with any number of errors collects a bounded text.
    """
    w = Window.partitionBy(*key).orderBy(order)
    most = cap // (least + 3) + 2
    text = F.substring(F.col(message), 1, cap + 1)
    first = (errors.select(*key, order, text.alias("__text")).withColumn("__rank", F.row_number().over(w))
             .filter(F.col("__rank") <= most))
    before = F.sum(F.length("__text") + 3).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # one message past the cap is kept, so that a longer text is seen to be longer
    first = first.withColumn("__before", F.coalesce(before, F.lit(0))).filter(F.col("__before") <= cap + 3)
    listed = F.array_sort(F.collect_list(F.struct("__rank", "__text")))
    return first.groupBy(*key).agg(listed.alias("__list")).select(
        *key, S.cap_text(F.array_join(F.transform("__list", lambda x: x["__text"]), " | "), cap).alias("error_message"))


def run_events_from_readings(measurement: DataFrame) -> DataFrame:
    """One ingestion run per reading day, as an append-only event log: an
    'open' row when the run starts and a 'close' row with the outcome.

    Outcome by day of month (fixed scenario): day mod 4 = 2 -> some readings
    rejected (partial), day mod 4 = 3 -> run-level error (failed).
    """
    per = measurement.groupBy("ingestion_run_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("measured_at").alias("started_at"),
        F.max("measured_at").alias("finished_at"))
    day = F.col("ingestion_run_id") % 100
    failed = F.when(day % 4 == 2, F.col("n") % 5 + 1).when(day % 4 == 3, F.lit(1)).otherwise(F.lit(0))
    run_error = day % 4 == 3
    closed = per.select(
        "ingestion_run_id", F.lit(2).alias("event_seq"), F.lit("incremental").alias("run_type"),
        run_status(failed, run_error).alias("status"), "started_at", "finished_at",
        F.when(run_error, F.lit(0)).otherwise(F.col("n") - failed).cast("int").alias("records_inserted"),
        failed.cast("int").alias("records_failed"),
        F.when(run_error, F.lit("run failed"))
        .when(failed > 0, F.concat(F.lit("measurement skipped: "), failed.cast("string"), F.lit(" invalid")))
        .alias("error_message"))
    opened = per.select(
        "ingestion_run_id", F.lit(1).alias("event_seq"), F.lit("incremental").alias("run_type"),
        F.lit("running").alias("status"), "started_at", F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.lit(0).alias("records_inserted"), F.lit(0).alias("records_failed"),
        F.lit(None).cast("string").alias("error_message"))
    return opened.unionByName(closed)


def fold_runs(events: DataFrame) -> DataFrame:
    """Latest event per run (max_by over the event sequence; partial
    aggregation keeps one row per run per task before the shuffle)."""
    latest = F.max_by(F.struct(*[c for c in RUN_COLS if c != "ingestion_run_id"]), F.col("event_seq"))
    return events.groupBy("ingestion_run_id").agg(latest.alias("r")).select("ingestion_run_id", "r.*")


def runs_list(runs: DataFrame, limit: int = 50) -> DataFrame:
    """Q6/L4: newest runs first (limit 1..200)."""
    return top_n(runs.select(*RUN_COLS), [F.desc("started_at"), F.desc("ingestion_run_id")], limit, 1, 200)


def run_kpis(runs: DataFrame) -> DataFrame:
    """Runs, failed-or-partial runs, rows inserted, rows failed."""
    return runs.agg(F.count(F.lit(1)).alias("runs"),
                    F.count_if(F.col("status").isin("failed", "partial")).alias("failed_or_partial"),
                    F.sum("records_inserted").cast("bigint").alias("rows_inserted"),
                    F.sum("records_failed").cast("bigint").alias("rows_failed"))


def run_status_counts(runs: DataFrame) -> DataFrame:
    """A17."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


def last_success(runs: DataFrame) -> DataFrame:
    """A5: max(coalesce(finished, started)) over succeeded runs (partial does not count)."""
    return runs.filter(F.col("status") == "succeeded").agg(
        F.max(F.coalesce("finished_at", "started_at")).alias("last_success_at"))


def lower_bound(measurement: DataFrame, runs: DataFrame, now, overlap_hours: int = 12,
                fallback_days: int = 1, initial_days: int = 180, incremental: bool = True) -> DataFrame:
    """Fetch lower bound. Incremental: global max reading time minus the
    overlap; else the last successful run; else now - 1 day. Initial load:
    now - 180 days. One row; both maxima are partial aggregations."""
    if isinstance(now, str):
        now = dt.datetime.fromisoformat(now)
    now_c = F.lit(now).cast("timestamp_ntz")
    if "measured_month" in measurement.columns:
        measurement = edge_months(measurement, F.max)
    # both one-row maxima in one aggregate over a union (no join needed)
    hw = measurement.select(F.col("measured_at").alias("high_water_mark"),
                            F.lit(None).cast("timestamp_ntz").alias("last_success_at"))
    ls = runs.filter(F.col("status") == "succeeded").select(
        F.lit(None).cast("timestamp_ntz").alias("high_water_mark"),
        F.coalesce("finished_at", "started_at").alias("last_success_at"))
    j = hw.unionByName(ls).agg(F.max("high_water_mark").alias("high_water_mark"),
                               F.max("last_success_at").alias("last_success_at"))
    if not incremental:
        bound = F.timestamp_add("DAY", F.lit(-initial_days), now_c)
    else:
        bound = F.coalesce(F.timestamp_add("HOUR", F.lit(-overlap_hours), F.col("high_water_mark")),
                           F.col("last_success_at"), F.timestamp_add("DAY", F.lit(-fallback_days), now_c))
    return j.select("high_water_mark", "last_success_at", bound.alias("lower_bound"))


def lower_bound_per_sensor(measurement: DataFrame, overlap_hours: int = 12) -> DataFrame:
    """Option to T1: one lower bound per sensor (its own newest reading minus
    the overlap), so a sensor far behind the others loses nothing. A partial
    aggregation per sensor."""
    return measurement.groupBy("sensor_id").agg(F.max("measured_at").alias("high_water_mark")).withColumn(
        "lower_bound", F.timestamp_add("HOUR", F.lit(-overlap_hours), F.col("high_water_mark")))
