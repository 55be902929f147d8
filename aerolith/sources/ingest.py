"""An ingest run over landed pages, with isolated units of work.

A run reads location pages in order; every location in scope is a unit of work,
and within it every sensor in scope is one, a *batch* of the sensor's reading
pages. What goes wrong stays within the smallest unit that it concerns:

* a reading without time or value is skipped, its batch goes on;
* any other fault of a batch (an unreadable page, a sensor without a parameter,
  a time or number that the table refuses) undoes the whole batch; its readings
  after the fault are never seen, its skipped readings before it stay counted;
* a fault of a location (values that the table refuses, an unreadable page of
  its sensors) undoes the location with all its batches;
* an unreadable location page ends the run: it has failed, and what earlier
  pages brought stays.

Each level is a table of faults, at most one row a unit (the first fault, a
partial aggregation), and units with a fault leave by an anti join on their
key. The order of arrival is a column, ``at``: location page and position,
sensor page and position, reading page and position; so faults before and
after another are told by comparison and no unit is read by one task.

A run can be capped: it visits the first ``max_locations`` locations in scope,
and none after the location at which it has read ``max_sensors`` sensors.

Raw pages are landed first and kept, also those of a batch that is undone, and
a run's inserted rows are the rows kept, not those an undone batch had written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.operators.runs import error_texts, run_status
from aerolith.session import staged
from aerolith.sources import bronze as B

LOCATIONS, SENSORS, READINGS = "/v3/locations", "/v3/locations/{id}/sensors", "/v3/sensors/{id}/measurements"
LEVELS = ("loc_page", "loc_pos", "sensor_page", "sensor_pos", "page_no", "position")
UNIT = ["run_id", "loc_page", "loc_pos"]
BATCH = [*UNIT, "sensor_page", "sensor_pos"]


def at(**levels: Column) -> Column:
    """The order of arrival; levels that are not given come before all others."""
    return F.struct(*[levels.get(n, F.lit(-1)).cast("int").alias(n) for n in LEVELS])


def unreadable(pages: DataFrame) -> Column:
    return F.json_object_keys("response_body").isNull()


def _cause(pages: DataFrame) -> Column:
    return F.concat(F.lit("unreadable response from "), F.col("url"))


@dataclass
class Run:
    """What the runs of some landed pages bring: ``locations`` (in-scope, not
    undone), ``batches`` (not undone), ``readings`` (inserted rows), ``errors``
    (run_id, at, kind, message) and ``log`` (a row per run)."""
    locations: DataFrame
    batches: DataFrame
    readings: DataFrame
    errors: DataFrame
    log: DataFrame


def stops(pages: DataFrame) -> DataFrame:
    """run_id, stop_page, cause of the runs that an unreadable location page ends."""
    bad = pages.filter((F.col("endpoint") == LOCATIONS) & unreadable(pages))
    return bad.groupBy("run_id").agg(F.min("page_no").alias("stop_page"), F.min_by(_cause(bad), "page_no").alias("cause"))


def location_units(pages: DataFrame, stopped: DataFrame, cities: list[str] | None) -> DataFrame:
    """Locations in scope with their place of arrival; ``cause`` where the table refuses them."""
    seen = pages.filter((F.col("endpoint") == LOCATIONS) & ~unreadable(pages)).join(stopped.drop("cause"), "run_id", "left") \
        .filter(F.coalesce(F.col("page_no") < F.col("stop_page"), F.lit(True)))
    records = B.unnest(seen, B.LOCATION_JSON)
    rows = records.select("run_id", F.col("page_no").alias("loc_page"), F.col("position").alias("loc_pos"), "rec")
    parsed = B.parse_locations(rows.withColumnsRenamed({"loc_page": "page_no", "loc_pos": "position"}), also=["run_id"]) \
        .withColumnsRenamed({"page_no": "loc_page", "position": "loc_pos"})
    latitude, longitude = F.col("latitude"), F.col("longitude")
    blank = [F.when(F.btrim(F.col(c)) == "", F.lit(f"{c} is blank")) for c in ("name", "city", "country")]
    outside = [F.when(~c.between(-m, m), F.concat(F.lit(f"{n} out of range "), c.cast("double").cast("string")))
               for n, c, m in (("latitude", latitude, 90), ("longitude", longitude, 180))]
    return B.in_scope(parsed, cities=cities).withColumn("cause", F.coalesce(*blank, *outside))


def sensor_batches(units: DataFrame, pages: DataFrame, parameters: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """The batches of the given units (no fault so far) with ``cause`` where the
    sensor cannot be stored, and the faults of units whose sensors cannot be read.

    Embedded sensors in scope win; a unit without any reads the location's sensor pages."""
    name = F.lower(F.coalesce(F.col("s")["parameter"]["name"], F.lit("")))
    keys = [*UNIT, "location_id"]
    cols = [*keys, "sensor_page", "sensor_pos", F.col("s")["id"].alias("sensor_id"),
            F.when(S.blank_to_null(F.col("s")["parameter"]["name"]).isNull() & S.blank_to_null(F.col("s")["parameter"]["code"]).isNull(),
                   F.lit("Parameter payload has no name/code")).alias("cause")]
    wanted = lambda df: B.in_scope(df.withColumn("scope_parameter", name), parameters=parameters)
    embedded = wanted(units.select(*keys, F.lit(0).alias("sensor_page"), F.posexplode("sensors").alias("sensor_pos", "s"))).select(*cols)
    bare = units.join(embedded.select(*UNIT).distinct(), UNIT, "left_anti").select(*keys)
    own = pages.filter(F.col("endpoint") == SENSORS)
    bad = own.filter(unreadable(own)).select("run_id", F.col("source_id").alias("location_id"), "page_no", _cause(own).alias("cause"))
    faults = bare.join(bad, ["run_id", "location_id"]).groupBy(*keys).agg(F.min_by("cause", "page_no").alias("cause"))
    fetched = B.unnest(own.filter(~unreadable(own)), B.SENSOR_JSON).select(
        "run_id", F.col("source_id").alias("location_id"), F.col("page_no").alias("sensor_page"),
        F.col("position").alias("sensor_pos"), F.col("rec").alias("s"))
    fallback = bare.join(faults.select(*UNIT), UNIT, "left_anti").join(fetched, ["run_id", "location_id"])
    return embedded.unionByName(wanted(fallback).select(*cols)), faults


def tagged_readings(batches: DataFrame, pages: DataFrame) -> DataFrame:
    """The readings of the given batches, parsed, and a row for each unreadable
    page (position -1); ``fault`` marks what undoes the batch."""
    own = pages.filter(F.col("endpoint") == READINGS)
    bad = own.filter(unreadable(own)).select("run_id", F.col("source_id").alias("sensor_id"), "page_no", F.lit(-1).alias("position"),
                                             _cause(own).alias("message"), F.lit(True).alias("fault"))
    parsed = B.parse_measurements(B.unnest(own.filter(~unreadable(own)), B.MEASUREMENT_JSON))
    rows = parsed.select("run_id", "sensor_id", "page_no", "position", "message", F.col("error").startswith("rejected").alias("fault"),
                         "error", "measured_at", "value", "unit", "raw_payload")
    rows = rows.unionByName(bad, allowMissingColumns=True)
    return batches.select(*BATCH, "location_id", "sensor_id").join(rows, ["run_id", "sensor_id"])


def _first(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first ``n`` rows of each run in the order of arrival."""
    if n is None:
        return df
    w = Window.partitionBy("run_id").orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def _until_full(df: DataFrame, batches: DataFrame, n: int | None) -> DataFrame:
    """Rows of units that their run comes to before it has read ``n`` sensors."""
    if n is None:
        return df
    last = batches.groupBy("run_id").agg(F.count(F.lit(1)).alias("__n"), F.max(F.struct("loc_page", "loc_pos")).alias("__last"))
    full = last.filter(F.col("__n") >= n).select("run_id", "__last")
    return df.join(full, "run_id", "left").filter(F.col("__last").isNull() | (F.struct("loc_page", "loc_pos") <= F.col("__last"))).drop("__last")


def _reached(stopped: DataFrame, units: DataFrame, batches: DataFrame, max_locations: int | None, max_sensors: int | None) -> DataFrame:
    """The stops of runs that no cap ends before."""
    def full(df, n):
        return df.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= n).select("run_id")
    for df, n in ((units, max_locations), (batches, max_sensors)):
        if n is not None:
            stopped = stopped.join(full(df, n), "run_id", "left_anti")
    return stopped


def _first_faults(rows: DataFrame) -> DataFrame:
    """Per batch its first fault: page, position, cause."""
    first = F.min(F.struct("page_no", "position", "message"))
    return rows.filter("fault").groupBy(*BATCH, "location_id", "sensor_id").agg(first.alias("f")).select(
        *BATCH, "location_id", "sensor_id", F.col("f.page_no").alias("fault_page"), F.col("f.position").alias("fault_pos"),
        F.col("f.message").alias("cause"))


def ingest(pages: DataFrame, stored: DataFrame | None = None, cities: list[str] | None = None,
           parameters: list[str] | None = None, max_locations: int | None = None, max_sensors: int | None = None) -> Run:
    """Run the landed ``pages`` (any number of runs) against the ``stored``
    readings (sensor_id, measured_at): the first writer of a reading wins."""
    stopped = staged(stops(pages), "stops")
    units = staged(_first(location_units(pages, stopped, cities), UNIT[1:], max_locations), "units")
    batches, unread = sensor_batches(units.filter("cause is null"), pages, parameters)
    batches = staged(_first(batches, BATCH[1:], max_sensors), "batches")
    units, unread = (_until_full(df, batches, max_sensors) for df in (units, unread))
    refused = units.filter("cause is not null")
    if max_locations is not None or max_sensors is not None:  # a capped run may end before the page that would fail it
        stopped = staged(_reached(stopped, units, batches, max_locations, max_sensors), "stops")
    location_faults = staged(refused.select(*UNIT, "location_id", "cause").unionByName(unread), "location-faults")
    rows = staged(tagged_readings(batches.filter("cause is null"), pages), "readings")
    found = _first_faults(rows)
    refused_batches = batches.filter("cause is not null").select(
        *BATCH, "location_id", "sensor_id", F.lit(0).alias("fault_page"), F.lit(-1).alias("fault_pos"), "cause")
    batch_faults = staged(found.unionByName(refused_batches), "batch-faults")

    # inserted: readings of batches without a fault, the first writer of each
    good = rows.filter("message is null").join(batch_faults.select(*BATCH), BATCH, "left_anti")
    order = F.struct("run_id", at(**{n: F.col(n) for n in LEVELS}).alias("at"))
    readings = B.insert_if_absent(
        good.select("sensor_id", "measured_at", "value", "unit", "raw_payload", "run_id", order.alias("__at")),
        stored, order=("__at",)).drop("__at")

    # errors: skipped readings (before the fault of their batch), batches, locations, runs
    skipped = rows.filter("message is not null and not fault").join(
        batch_faults.select(*BATCH, "fault_page", "fault_pos"), BATCH, "left").filter(
        F.col("fault_page").isNull()
        | (F.struct("page_no", "position") < F.struct(F.col("fault_page").alias("page_no"), F.col("fault_pos").alias("position"))))
    text = lambda *parts: F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    col, place = F.col, lambda *names: {n: F.col(n) for n in names}
    errors = staged(
        skipped.select("run_id", at(**place(*LEVELS)).alias("at"), F.lit("reading").alias("kind"), "message")
        .unionByName(batch_faults.select(
            "run_id", at(**place(*BATCH[1:]), page_no=col("fault_page"), position=col("fault_pos")).alias("at"), F.lit("batch").alias("kind"),
            text("sensor ", col("sensor_id"), " at location ", col("location_id"), " rolled back: ", col("cause")).alias("message")))
        .unionByName(location_faults.select(
            "run_id", at(**place(*UNIT[1:])).alias("at"), F.lit("location").alias("kind"),
            text("location ", col("location_id"), " rolled back: ", col("cause")).alias("message")))
        .unionByName(stopped.select(
            "run_id", at(loc_page=col("stop_page")).alias("at"), F.lit("run").alias("kind"),
            text("run failed: ", col("cause")).alias("message"))), "errors")

    # who was first needs no payload: the counts leave it out
    firsts = good.select("sensor_id", "measured_at", "run_id", order.alias("__at"))
    inserted = B.insert_if_absent(firsts, stored, order=("__at",)).groupBy("run_id").agg(F.count(F.lit(1)).alias("records_inserted"))
    failed = errors.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("records_failed"),
        *[F.count_if(F.col("kind") == k).alias(n) for k, n in (("reading", "readings_skipped"), ("batch", "batches_undone"),
                                                               ("location", "locations_undone"), ("run", "run_errors"))])
    counts = ["records_inserted", "records_failed", "readings_skipped", "batches_undone", "locations_undone"]
    log = (pages.select("run_id").distinct().join(inserted, "run_id", "left").join(failed, "run_id", "left")
           .join(error_texts(errors, ["run_id"], "at", "message"), "run_id", "left").na.fill(0, [*counts, "run_errors"])
           .select("run_id", run_status(F.col("records_failed"), F.col("run_errors") > 0).alias("status"),
                   *[F.col(c).cast("bigint").alias(c) for c in counts], "error_message"))
    kept = units.filter("cause is null").join(location_faults.select(*UNIT), UNIT, "left_anti")
    return Run(kept, batches.join(batch_faults.select(*BATCH), BATCH, "left_anti"), readings, errors, log)
