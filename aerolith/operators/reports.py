"""Dashboard aggregates (A6-A25), latest-per-station (W6), worst station (L7),
gap finder (W8) and gap-bounded sessions (T9).

The reference computes these in pandas over the newest N rows of a limited
read; here they run over the whole tables (contract 15, fixed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.operators.filters import edge_months


def daily_mean(hourly: DataFrame) -> DataFrame:
    """Per (day, parameter) the unweighted mean of hourly means, sum of counts."""
    return hourly.groupBy(F.to_date("measured_hour").alias("day"), "parameter_code").agg(
        F.avg("average_value").cast("double").alias("daily_mean"),
        F.sum("measurement_count").cast("bigint").alias("measurement_count"))


def hourly_mean(hourly: DataFrame) -> DataFrame:
    """Per (hour, city, parameter), collapsing units."""
    return hourly.groupBy("measured_hour", "city", "parameter_code").agg(
        F.avg("average_value").cast("double").alias("average_value"),
        F.sum("measurement_count").cast("bigint").alias("measurement_count"))


def daily_actuals(readings: DataFrame, min_stations: int = 3, view=("parameter_code",)) -> DataFrame:
    """Daily mean of actual values per view (here: one parameter), and
    whether the chart uses it: more than ``min_stations`` distinct stations
    in the whole view. The station count is one small aggregate per view,
    joined back by the view key."""
    view = list(view)
    daily = readings.groupBy(F.to_date("measured_at").alias("day"), *view).agg(
        S.exact_mean("value").alias("daily_actual"))
    stations = readings.groupBy(*view).agg(F.countDistinct("location_name").alias("stations"))
    return daily.join(stations, view).withColumn("use_daily_mean", F.col("stations") > min_stations)


HOURS = list(range(24))


def alert_heatmap(alerts_enriched: DataFrame, ts: str = "generated_at") -> DataFrame:
    """Weekday x hour alert counts, hours pivoted 0..23, zeros filled,
    Monday first (weekday_index 1..7). Pivot values are given, so no extra
    job is needed to discover them."""
    a = alerts_enriched.select(S.iso_weekday(ts).alias("weekday_index"),
                               F.date_format(ts, "EEEE").alias("weekday"), F.hour(ts).alias("hour"))
    p = a.groupBy("weekday_index", "weekday").pivot("hour", HOURS).count().na.fill(0)
    return p.select("weekday_index", "weekday",
                    *[F.col(str(h)).cast("bigint").alias(f"h{h:02d}") for h in HOURS])


def value_counts(df: DataFrame, column: str, name: str = "alerts") -> DataFrame:
    """Counts per value, largest first (ties by value)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def top_stations(alerts_enriched: DataFrame, n: int = 10) -> DataFrame:
    """Stations with most alerts, top n (ties by name)."""
    return alerts_enriched.groupBy("location_name").agg(F.count(F.lit(1)).alias("alerts")) \
        .orderBy(F.desc("alerts"), "location_name").limit(n)


def alert_kpis(alerts_enriched: DataFrame) -> DataFrame:
    """Total, critical, stations, pollutants."""
    return alerts_enriched.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("alert_level") == "critical").alias("critical_alerts"),
        F.countDistinct("location_name").alias("stations"),
        F.countDistinct("parameter_code").alias("pollutants"))


def latest_by_station(readings: DataFrame) -> DataFrame:
    """Latest reading per (city, station, parameter) via max_by over a
    struct (partial aggregation, no window sort of every reading)."""
    latest = F.max_by(F.struct(F.col("measured_at"), F.col("value").cast("double").alias("value"),
                               F.col("measurement_id")),
                      F.struct(F.col("measured_at"), F.col("measurement_id")))
    return readings.groupBy("city", "location_name", "parameter_code").agg(latest.alias("l")).select(
        "city", "location_name", "parameter_code", F.col("l.measured_at").alias("measured_at"),
        F.col("l.value").alias("value"), F.col("l.measurement_id").alias("measurement_id"))


def worst_station(latest: DataFrame) -> DataFrame:
    """Top-1 of the latest-per-station rows by value."""
    return latest.orderBy(F.desc("value"), "city", "location_name", "parameter_code").limit(1)


def overview_kpis(readings: DataFrame, alerts_df: DataFrame, days: int = 7) -> DataFrame:
    """Latest value, mean over the ``days`` days before the newest reading,
    stations, open alerts. The newest time and the open-alert count are scalar
    subqueries (one-row aggregates Catalyst runs first and inlines)."""
    max_at = readings.agg(F.max("measured_at")).scalar()
    open_alerts = alerts_df.agg(F.count_if(F.col("status") == "open")).scalar()
    v = F.col("value").cast("double")
    recent = F.col("measured_at") >= F.timestamp_add("DAY", F.lit(-days), max_at)
    return readings.agg(
        F.max_by(v, F.struct("measured_at", "measurement_id")).alias("latest_value"),
        S.exact_mean(F.when(recent, F.col("value"))).alias("mean_last_days"),
        F.countDistinct("location_name").alias("stations"),
    ).select("latest_value", "mean_last_days", "stations", open_alerts.alias("open_alerts"))


def home_kpis(readings: DataFrame, alerts_df: DataFrame, locations: DataFrame) -> DataFrame:
    """Monitored stations (active locations), readings and open alerts,
    each counted over its whole table."""
    stations = locations.filter(F.col("is_active")).agg(F.count(F.lit(1))).scalar()
    open_alerts = alerts_df.agg(F.count_if(F.col("status") == "open")).scalar()
    return readings.agg(F.count(F.lit(1)).cast("bigint").alias("recent_readings")) \
        .select(stations.alias("stations"), "recent_readings", open_alerts.alias("open_alerts"))


def records_per_day(df: DataFrame, ts: str = "measured_at") -> DataFrame:
    """A15."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("records"))


def date_bounds(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Overall min/max date across several frames (one union, one aggregate);
    of a table in month partitions only the first and the last month are read."""
    parts = [(edge_months(df, F.min, F.max) if "measured_month" in df.columns else df).select(F.to_date(F.col(col)).alias("d"))
             for df, col in frames.values()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct option values, NULLs dropped."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


SERIES = ["city", "location_name", "parameter_code"]


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def gaps(readings: DataFrame, key=SERIES, ts: str = "measured_at", min_hours: float = 6.0) -> DataFrame:
    """Per (city, station, parameter) series, the time since the previous
    reading, strictly above ``min_hours``: gap_start, gap_end, hours rounded
    to 2 places.

    A series can be hot (a third of all rows), so the lag is not one window
    over the whole series: it is taken within row-sized chunks and the first
    row of each chunk looks up the last time of the previous chunk from a
    per-chunk summary (one row per series and chunk).
    """
    key = _keys(key)
    prev = previous_time(readings.select(*key, ts), key, ts)
    h = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("previous_at").cast("timestamp"))) \
        / F.lit(3_600_000_000.0)
    return prev.filter(h > F.lit(min_hours)).select(
        *key, F.col("previous_at").alias("gap_start"), F.col(ts).alias("gap_end"), F.round(h, 2).alias("gap_hours"))


def previous_time(df: DataFrame, key, ts: str, chunk=None) -> DataFrame:
    """Previous ``ts`` of the same series for every row, computed in bounded chunks."""
    from aerolith.operators.windows import with_chunks
    key = _keys(key)
    b = with_chunks(df, key, ts, chunk)
    w_in = Window.partitionBy(*key, "__chunk").orderBy(ts)
    b = b.withColumn("__prev_in", F.lag(ts).over(w_in))
    summ = b.groupBy(*key, "__chunk").agg(F.max(ts).alias("__chunk_max"))
    summ = summ.withColumn("__prev_chunk_max",
                           F.lag("__chunk_max").over(Window.partitionBy(*key).orderBy("__chunk")))
    j = b.join(summ.select(*key, "__chunk", "__prev_chunk_max"), [*key, "__chunk"])
    return j.withColumn("previous_at", F.coalesce("__prev_in", "__prev_chunk_max")) \
        .drop("__prev_in", "__prev_chunk_max")


def gap_sessions(readings: DataFrame, key=SERIES, ts: str = "measured_at",
                 gap_hours: float = 6.0, chunk=None) -> DataFrame:
    """Gap-bounded sessions per series (the dual of W8): a reading more
    than ``gap_hours`` after the previous one starts a new session.

    Skew-safe: each row's session start is the running maximum of start
    times, taken inside bounded chunks and carried across chunks by a prefix
    maximum over the chunk summaries; the final grouping is by session, not
    by series, and aggregates partially before the shuffle."""
    key = _keys(key)
    p = previous_time(readings.select(*key, ts), key, ts, chunk)
    gap = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("previous_at").cast("timestamp"))) \
        / F.lit(3_600_000_000.0)
    start = F.when(F.col("previous_at").isNull() | (gap > F.lit(gap_hours)), F.col(ts))
    b = p.withColumn("__start", start)
    run_in = F.max("__start").over(Window.partitionBy(*key, "__chunk").orderBy(ts)
                                   .rowsBetween(Window.unboundedPreceding, 0))
    b = b.withColumn("__run", run_in)
    summ = b.groupBy(*key, "__chunk").agg(F.max("__start").alias("__last_start"))
    summ = summ.withColumn("__carry", F.max("__last_start").over(
        Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)))
    j = b.join(summ.select(*key, "__chunk", "__carry"), [*key, "__chunk"])
    s = j.withColumn("session_start", F.coalesce("__run", "__carry"))
    return s.groupBy(*key, "session_start").agg(F.count(F.lit(1)).alias("readings"),
                                                F.min(ts).alias("first_at"), F.max(ts).alias("last_at")) \
        .select(*key, "first_at", "last_at", "readings")


def gap_sessions_streaming(events: DataFrame, key, event_time: str, gap: str = "6 hours") -> DataFrame:
    """T9 on a stream: built-in session windows (needs a watermark upstream)."""
    return events.groupBy(*_keys(key), F.session_window(event_time, gap).alias("session")).agg(
        F.count(F.lit(1)).alias("readings"), F.min(event_time).alias("first_at"),
        F.max(event_time).alias("last_at"))
