"""Ingest runs with faults at every level (T7, F19): pages derived from the
readings, the runs over them, and oracles that follow one run after another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import scalars as S
from aerolith.plans.catalog import register
from aerolith.sources import bronze as B
from aerolith.sources import ingest
from aerolith.sources.driver_tables import core

#: parameters in scope; sensors of others are not read
SCOPE = ["click", "purchase", "signup", "view"]
LOCATIONS_A_PAGE = 10
DECOY = "2020-02-02T02:02:02.000000Z"


def faulty_record(e):
    """Readings of which some lack a value or a time, or carry one that the
    table refuses; others carry a second time in a field of lower precedence."""
    n = e["event_id"]
    value = (F.when(n % 50 == 7, F.lit(None)).when(n % 389 == 3, F.lit("n/a")).when(n % 397 == 5, F.lit("100000.0000"))
             .otherwise(F.format_string("%.4f", e["value"])))
    time = F.when(n % 31 == 9, F.lit(None)).when(n % 401 == 11, F.lit("not a time")).otherwise(F.date_format(e["ts"], B.ISO))
    return B.reading_record(e, value, time, F.when((n % 5 == 0) & (n % 31 != 9), F.lit(DECOY)))


def faulty_pages(c) -> DataFrame:
    """The pages of a run a day: locations with readings that day (ten a page,
    those with a key 0 mod 4 without embedded sensors), sensor pages for these,
    reading pages. Unreadable: the first reading page where (sensor + day) mod
    53 is 1, the sensor page where the key mod 28 is 8, and the location page
    of keys 70 to 79 on days 5 mod 7. Locations with a key 4 mod 37 carry a
    latitude that the table refuses."""
    readings = B.measurement_pages(c.raw("events"), c.parameter, record=faulty_record)
    day = F.col("run_id") % 100
    broken = ((F.col("source_id") + day) % 53 == 1) & (F.col("page_no") == 1)
    readings = readings.withColumn("response_body", F.when(broken, F.lit("<html>503</html>")).otherwise(F.col("response_body")))

    p = c.parameter.select(F.col("code").alias("event_type"), "parameter_id", "display_name")
    none = F.lit(None).cast("string")
    sensor_id = F.col("user_id") * 1000 + F.col("parameter_id")
    sensor = F.struct(sensor_id.alias("id"), F.lit(S.DEFAULT_UNIT).alias("unit"),
                      F.struct(F.col("parameter_id").cast("long").alias("id"), F.col("event_type").alias("name"), F.col("event_type").alias("code"),
                               F.col("display_name").alias("displayName"), F.lit(S.DEFAULT_UNIT).alias("units"), none.alias("unit"),
                               none.alias("description")).alias("parameter"))
    # a location has at most one sensor for each parameter
    seen = (c.raw("events").select(S.date_key("ts").alias("run_id"), "user_id", "event_type").distinct().join(p, "event_type")
            .groupBy("run_id", F.col("user_id").alias("location_id"))
            .agg(F.array_sort(F.collect_list(F.struct(sensor_id.alias("__id"), sensor.alias("s")))).alias("__list"))
            .select("run_id", "location_id", F.transform("__list", lambda x: x["s"]).alias("sensors"))
            .join(c.location, "location_id"))
    bare = F.col("location_id") % 4 == 0
    rec = F.struct(
        F.col("location_id").alias("id"), "name", "locality", "city",
        F.struct(none.alias("code"), F.col("country").alias("name")).alias("country"),
        F.struct(F.when(F.col("location_id") % 37 == 4, F.lit(95.0)).otherwise(F.col("latitude").cast("double")).alias("latitude"),
                 F.col("longitude").cast("double").alias("longitude")).alias("coordinates"),
        "timezone", F.when(~bare, F.col("sensors")).alias("sensors"))
    page = (F.floor(F.col("location_id") / LOCATIONS_A_PAGE) + 1).cast("int")
    listed = (seen.groupBy("run_id", page.alias("page_no"))
              .agg(F.array_sort(F.collect_list(F.struct("location_id", F.to_json(rec).alias("r")))).alias("__recs")))
    body = F.concat(F.lit('{"results":['), F.array_join(F.transform("__recs", lambda x: x["r"]), ","), F.lit("]}"))
    ended = (F.col("page_no") == 8) & (day % 7 == 5)
    locations = listed.select(
        "run_id", F.lit(ingest.LOCATIONS).alias("endpoint"), F.concat(F.lit("/v3/locations?page="), F.col("page_no").cast("string")).alias("url"),
        none.alias("params"), F.lit(None).cast("long").alias("source_id"), "page_no",
        F.when(ended, F.lit("upstream timeout")).otherwise(body).alias("response_body"))
    sensors = seen.filter(bare).select(
        "run_id", F.lit(ingest.SENSORS).alias("endpoint"),
        F.concat(F.lit("/v3/locations/"), F.col("location_id").cast("string"), F.lit("/sensors")).alias("url"),
        none.alias("params"), F.col("location_id").cast("long").alias("source_id"), F.lit(1).alias("page_no"),
        F.when(F.col("location_id") % 28 == 8, F.lit("{")).otherwise(F.to_json(F.struct(F.col("sensors").alias("results")))).alias("response_body"))
    return readings.unionByName(locations).unionByName(sensors)


_RUNS: dict[tuple, ingest.Run] = {}
CAPS = {"max_locations": 60, "max_sensors": 80}


def faulty_runs(spark, sf, **caps) -> ingest.Run:
    """The runs over the landed pages, once a session, input and caps."""
    from aerolith.plans.catalog import _landing_name
    from aerolith.session import code_version
    import sys
    c = core(spark, sf)
    key = (id(spark), c.inputs, spark.conf.get("spark.checkpoint.dir", ""), *caps)
    run = _RUNS.get(key)
    if run is None or run.log.sparkSession is not spark:
        name = f"{_landing_name(c, 'faulty')}-{code_version(sys.modules[__name__])}"
        pages = B.land_once(spark, faulty_pages(c), name)
        run = _RUNS[key] = ingest.ingest(pages, parameters=SCOPE, **caps)
    return run


# The oracle walks the same hierarchy from the events: what each reading, batch,
# location and run does, and what that leaves of the others.
def walk(max_locations: int = 1 << 30, max_sensors: int = 1 << 30) -> str:
    return """
, p AS (SELECT code, parameter_id, display_name FROM parameter)
, ev AS (
  SELECT e.event_id AS n, e.ts, e.value AS raw, e.user_id AS loc, p.parameter_id AS pid, p.code, p.display_name AS disp,
         e.user_id * 1000 + p.parameter_id AS sen, CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) AS run,
         CAST(e.user_id // 10 + 1 AS INTEGER) AS lpage
  FROM events e JOIN p ON p.code = e.event_type)
, rd AS (
  SELECT *, (row_number() OVER (PARTITION BY sen, run ORDER BY ts, n) - 1) // 250 + 1 AS page,
         CASE WHEN n % 50 = 7 THEN NULL WHEN n % 389 = 3 THEN 'n/a' WHEN n % 397 = 5 THEN '100000.0000'
              ELSE CAST(CAST(raw AS DECIMAL(12,4)) AS VARCHAR) END AS v,
         CASE WHEN n % 31 = 9 THEN NULL WHEN n % 401 = 11 THEN 'not a time'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS t,
         CASE WHEN n % 5 = 0 AND n % 31 <> 9 THEN '2020-02-02T02:02:02.000000Z' END AS decoy
  FROM ev)
, broken AS (SELECT DISTINCT run FROM ev WHERE lpage = 8 AND run % 100 % 7 = 5)
, readable AS (
  SELECT rd.*, dense_rank() OVER (PARTITION BY rd.run ORDER BY lpage, loc) AS nth
  FROM rd LEFT JOIN broken ON broken.run = rd.run WHERE broken.run IS NULL OR lpage < 8)
, sensors AS (  -- of good locations, in the order of arrival
  SELECT run, lpage, loc, sen, row_number() OVER (PARTITION BY run ORDER BY lpage, loc, sen) AS k
  FROM (SELECT DISTINCT run, lpage, loc, sen FROM readable
        WHERE nth <= {max_locations} AND code <> 'error' AND loc % 37 <> 4 AND loc % 28 <> 8))
, cut AS (SELECT run, lpage, loc FROM sensors WHERE k = {max_sensors})
, ended AS (
  SELECT run FROM broken WHERE run NOT IN (SELECT run FROM cut) AND run NOT IN (SELECT run FROM readable WHERE nth = {max_locations}))
, visited AS (  -- readings of locations the run came to
  SELECT r.* FROM readable r LEFT JOIN cut ON cut.run = r.run
  WHERE nth <= {max_locations} AND (cut.run IS NULL OR (r.lpage, r.loc) <= (cut.lpage, cut.loc)))
, badloc AS (
  SELECT DISTINCT run, loc, lpage,
         CASE WHEN loc % 37 = 4 THEN 'latitude out of range 95.0'
              ELSE 'unreadable response from /v3/locations/' || loc || '/sensors' END AS cause
  FROM visited WHERE loc % 37 = 4 OR loc % 28 = 8)
, fetched AS (  -- readings of sensors in scope at locations that stay
  SELECT v.*, (sen + run % 100) % 53 = 1 AS lost,
         v IS NULL OR t IS NULL AS skipped,
         CASE WHEN v IS NULL OR t IS NULL THEN NULL WHEN t = 'not a time' THEN 'unparsable time not a time'
              WHEN v = 'n/a' THEN 'unparsable value n/a' WHEN v = '100000.0000' THEN 'value out of range 100000.0000' END AS cause
  FROM visited v WHERE code <> 'error' AND NOT EXISTS (SELECT 1 FROM badloc b WHERE b.run = v.run AND b.loc = v.loc)
    AND EXISTS (SELECT 1 FROM sensors s WHERE s.run = v.run AND s.sen = v.sen AND s.k <= {max_sensors}))
, badbatch AS (  -- the first fault in page order: page 1 itself, or a reading
  SELECT run, loc, lpage, sen,
         CASE WHEN bool_or(lost) THEN 'unreadable response from /v3/sensors/' || sen || '/measurements'
              ELSE arg_min(cause, (ts, n)) FILTER (cause IS NOT NULL) END AS cause,
         CASE WHEN NOT bool_or(lost) THEN min((ts, n)) FILTER (cause IS NOT NULL) END AS first_fault
  FROM fetched GROUP BY run, loc, lpage, sen HAVING bool_or(lost) OR count(cause) > 0)
, kept AS (
  SELECT * FROM fetched f WHERE NOT skipped AND NOT EXISTS (SELECT 1 FROM badbatch b WHERE b.run = f.run AND b.sen = f.sen))
, ins AS (  -- the first writer of a sensor's time
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY sen, ts ORDER BY run, lpage, loc, page, n) = 1)
, skips AS (
  SELECT f.*, '{' || CASE WHEN v IS NOT NULL THEN '"value":"' || v || '",' ELSE '' END
         || CASE WHEN n % 3 <> 2 THEN '"unit":"ug/m3",' ELSE '' END
         || '"parameter":{"id":' || pid || ',"name":"' || code || '","code":"' || code || '","displayName":"' || disp || '","units":"'
         || CASE WHEN n % 3 = 0 THEN 'µg/m³' ELSE 'ug/m3' END || '"},"datetime":{'
         || CASE WHEN n % 4 = 0 AND t IS NOT NULL THEN '"utc":"' || t || '"' ELSE '' END || '},"period":{"datetimeFrom":{'
         || CASE WHEN n % 4 = 1 AND t IS NOT NULL THEN '"utc":"' || t || '"' WHEN n % 4 < 1 AND decoy IS NOT NULL THEN '"utc":"' || decoy || '"' ELSE '' END || '}}'
         || CASE WHEN n % 4 = 2 AND t IS NOT NULL THEN ',"date":"' || t || '"' WHEN n % 4 < 2 AND decoy IS NOT NULL THEN ',"date":"' || decoy || '"' ELSE '' END
         || CASE WHEN n % 4 = 3 AND t IS NOT NULL THEN ',"datetimeUtc":"' || t || '"' WHEN n % 4 < 3 AND decoy IS NOT NULL THEN ',"datetimeUtc":"' || decoy || '"' ELSE '' END
         || '}' AS payload
  FROM fetched f LEFT JOIN badbatch b ON b.run = f.run AND b.sen = f.sen
  WHERE skipped AND (b.sen IS NULL OR (f.ts, f.n) < b.first_fault))
, err AS (
  SELECT run, 'reading' AS kind, lpage AS a, loc AS b, sen AS c, ts AS d, n AS e,
         'sensor ' || sen || ' measurement skipped at ' || coalesce(t, 'unknown') || ' for parameter ' || code
         || ' with value ' || coalesce(v, 'None') || ': Measurement payload missing datetime/value: ' || payload AS message
  FROM skips
  UNION ALL
  SELECT run, 'batch', lpage, loc, sen, coalesce(first_fault[1], TIMESTAMP '1900-01-01'), first_fault[2],
         'sensor ' || sen || ' at location ' || loc || ' rolled back: ' || cause FROM badbatch
  UNION ALL
  SELECT run, 'location', lpage, loc, -1, NULL, NULL, 'location ' || loc || ' rolled back: ' || cause FROM badloc
  UNION ALL
  SELECT run, 'run', 8, -1, -1, NULL, NULL, 'run failed: unreadable response from /v3/locations?page=8' FROM ended)
""".replace("{max_locations}", str(max_locations)).replace("{max_sensors}", str(max_sensors))


LOG_SQL = """
, txt AS (SELECT run, string_agg(message, ' | ' ORDER BY a, b, c, d, e) AS s FROM err GROUP BY run)
, k AS (SELECT run, count(*) AS n_failed, count(*) FILTER (kind = 'reading') AS n_reading, count(*) FILTER (kind = 'batch') AS n_batch,
               count(*) FILTER (kind = 'location') AS n_loc, bool_or(kind = 'run') AS broke FROM err GROUP BY run)
, i AS (SELECT run, count(*) AS n_in FROM ins GROUP BY run)
SELECT r.run AS run_id, CASE WHEN broke THEN 'failed' WHEN n_failed > 0 THEN 'partial' ELSE 'succeeded' END AS status,
       coalesce(n_in, 0) AS records_inserted, coalesce(n_failed, 0) AS records_failed, coalesce(n_reading, 0) AS readings_skipped,
       coalesce(n_batch, 0) AS batches_undone, coalesce(n_loc, 0) AS locations_undone,
       CASE WHEN length(s) > 4000 THEN substr(s, 1, 3997) || '...' ELSE s END AS error_message
FROM (SELECT DISTINCT run FROM ev) r LEFT JOIN k ON k.run = r.run LEFT JOIN i ON i.run = r.run LEFT JOIN txt ON txt.run = r.run
"""


@register("ingest_run_log", walk() + LOG_SQL)
def _ingest_run_log(spark, sf):
    """T7 + F19 + S18: runs with bad batches, bad locations and an early end."""
    return faulty_runs(spark, sf).log


@register("ingest_run_readings", walk() + """
SELECT sen AS sensor_id, ts AS measured_at, CAST(CAST(v AS DECIMAL(12,4)) AS DOUBLE) AS value, 'ug/m3' AS unit, run AS run_id FROM ins
""")
def _ingest_run_readings(spark, sf):
    """T7 + S6 + F4 + S9: the readings that the runs insert."""
    return faulty_runs(spark, sf).readings.select("sensor_id", "measured_at", F.col("value").cast("double").alias("value"), "unit", "run_id")


@register("ingest_run_errors", walk() + "SELECT run AS run_id, kind, message FROM err")
def _ingest_run_errors(spark, sf):
    """T7 + F19: every error of the runs, whole."""
    return faulty_runs(spark, sf).errors.select("run_id", "kind", "message")


@register("ingest_run_capped", walk(**CAPS) + LOG_SQL)
def _ingest_run_capped(spark, sf):
    """S8 + T7: the same runs with caps on locations and sensors, in the order of arrival."""
    return faulty_runs(spark, sf, **CAPS).log
