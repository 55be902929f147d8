"""Bronze layer: raw API pages (S1), unnesting (S2), record parsing (S3-S6),
scope and caps (S7, S8), first-writer insert (S9) and run counts (T7).

The reference fetches JSON pages over HTTP; here pages are files (or a
stream) of JSON lines with the same envelope ``{"results": [...]}``.
``landing_pages`` derives such pages from the input tables so the whole
path runs at the size of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from aerolith.functions import scalars as S

PAGE_SIZE = 250  # records per page, as the source API pages

# --- JSON shapes (S1.3) -----------------------------------------------------
UTC = T.StructType([T.StructField("utc", T.StringType())])
PARAMETER_JSON = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("code", T.StringType()), T.StructField("displayName", T.StringType()),
    T.StructField("units", T.StringType()), T.StructField("unit", T.StringType()),
    T.StructField("description", T.StringType())])
MEASUREMENT_JSON = T.StructType([
    T.StructField("value", T.StringType()),  # text: a bad number must not fail the page
    T.StructField("unit", T.StringType()),
    T.StructField("parameter", PARAMETER_JSON),
    T.StructField("datetime", UTC),
    T.StructField("period", T.StructType([T.StructField("datetimeFrom", UTC)])),
    T.StructField("date", T.StringType()),
    T.StructField("datetimeUtc", T.StringType())])
SENSOR_JSON = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("unit", T.StringType()),
    T.StructField("parameter", PARAMETER_JSON)])
LOCATION_JSON = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("locality", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("country", T.StructType([T.StructField("code", T.StringType()),
                                           T.StructField("name", T.StringType())])),
    T.StructField("coordinates", T.StructType([T.StructField("latitude", T.DoubleType()),
                                               T.StructField("longitude", T.DoubleType())])),
    T.StructField("timezone", T.StringType()),
    T.StructField("sensors", T.ArrayType(SENSOR_JSON))])


def envelope(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("results", T.ArrayType(record))])


PAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.IntegerType()), T.StructField("endpoint", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("params", T.StringType()),
    T.StructField("source_id", T.LongType()), T.StructField("page_no", T.IntegerType()),
    T.StructField("response_body", T.StringType())])


# --- landing (S1) -------------------------------------------------------------

def reading_record(e, value, time, decoy=None):
    """A reading ``e`` (a struct of ``READING_FIELDS``) as the source sends it.
    The time stands in one of four fields (by event id mod 4), every third
    parameter unit uses the micro sign, every third reading has no unit of its
    own. ``decoy``: a time that the fields of lower precedence carry instead of
    nothing."""
    none = F.lit(None).cast("string")
    decoy = none if decoy is None else decoy
    k = e["event_id"] % 4
    at = lambda i: F.when(k == i, time).when(k < i, decoy)
    return F.struct(
        value.alias("value"),
        F.when(e["event_id"] % 3 != 2, F.lit(S.DEFAULT_UNIT)).alias("unit"),
        F.struct(e["parameter_id"].cast("long").alias("id"), e["event_type"].alias("name"),
                 e["event_type"].alias("code"), e["display_name"].alias("displayName"),
                 F.when(e["event_id"] % 3 == 0, F.lit("µg/m³")).otherwise(F.lit(S.DEFAULT_UNIT))
                 .alias("units"), none.alias("unit"), none.alias("description")).alias("parameter"),
        F.struct(at(0).alias("utc")).alias("datetime"),
        F.struct(F.struct(at(1).alias("utc")).alias("datetimeFrom")).alias("period"),
        at(2).alias("date"),
        at(3).alias("datetimeUtc"))


def valid_record(e):
    """A reading that lacks its value where the event id mod 50 is 7."""
    return reading_record(e, F.when(e["event_id"] % 50 != 7, F.format_string("%.4f", e["value"])), F.date_format(e["ts"], ISO))


READING_FIELDS = ("event_id", "ts", "value", "parameter_id", "event_type", "display_name")
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def measurement_pages(events: DataFrame, parameter: DataFrame, sensor_factor: int = 1000, record=valid_record) -> DataFrame:
    """Readings as API pages: one page per (sensor, day, block of 250).

    Record variants exercise the parser: see ``reading_record``; every 50th
    record (id mod 50 = 7) lacks its value (an invalid reading). ``record``
    replaces that form of a reading. Pages are gathered from the readings' own
    columns, a fifth of their text, and become text where they are whole.
    """
    p = parameter.select(F.col("code").alias("event_type"), "parameter_id", "display_name")
    e = events.join(p, "event_type").withColumn("sensor_id", F.col("user_id") * sensor_factor + F.col("parameter_id"))
    # A record's position within its (sensor, day) is the number of records in
    # earlier hours plus its rank within the hour, so a hot sensor-day is spread
    # over several tasks and pages are full and numbered 1, 2, 3 in time order.
    from aerolith.operators.windows import with_rows_before
    e = with_rows_before(e.withColumn("__day", F.to_date("ts")), ["sensor_id", "__day"], "ts")
    w = Window.partitionBy("sensor_id", "__day", "__hour").orderBy("ts", "event_id")
    e = e.withColumn("__pos", F.col("__before") + F.row_number().over(w) - 1)
    e = e.withColumn("__page", F.floor(F.col("__pos") / PAGE_SIZE).cast("int"))
    pages = e.groupBy("sensor_id", "__day", "__page").agg(
        F.sort_array(F.collect_list(F.struct("__pos", *READING_FIELDS))).alias("__recs"))
    body = F.to_json(F.struct(F.transform("__recs", record).alias("results")))
    return pages.select(
        F.date_format("__day", "yyyyMMdd").cast("int").alias("run_id"),
        F.lit("/v3/sensors/{id}/measurements").alias("endpoint"),
        F.concat(F.lit("/v3/sensors/"), F.col("sensor_id").cast("string"), F.lit("/measurements")).alias("url"),
        F.to_json(F.struct(F.col("__day").cast("string").alias("date_from"),
                           (F.col("__page") + 1).alias("page"), F.lit(PAGE_SIZE).alias("limit"))).alias("params"),
        F.col("sensor_id").alias("source_id"),
        (F.col("__page") + 1).alias("page_no"),
        body.alias("response_body"))


def location_pages(location: DataFrame, sensor: DataFrame, parameter: DataFrame) -> DataFrame:
    """Locations as API pages with embedded sensors (a location with many
    sensors spans several pages, each repeating the location); locations
    whose key is 0 mod 4 carry no embedded sensors, so their sensors come
    from separate sensor pages (S4 fallback)."""
    p = parameter.select("parameter_id", "code", "display_name")
    s = sensor.join(p, "parameter_id").select(
        "location_id", "sensor_id",
        F.struct(F.col("sensor_id").alias("id"), F.col("unit"),
                 F.struct(F.col("parameter_id").cast("long").alias("id"), F.col("code").alias("name"),
                          F.col("code"), F.col("display_name").alias("displayName"),
                          F.col("unit").alias("units"), F.lit(None).cast("string").alias("unit"),
                          F.lit(None).cast("string").alias("description")).alias("parameter")).alias("s"))
    # A location's sensors are paged like readings: blocks of about PAGE_SIZE
    # (by a hash of the sensor id, block count from the location's sensor
    # count), so no collected list grows with a hot location.
    cnt = s.groupBy("location_id").agg(F.count(F.lit(1)).alias("__n"))
    s = s.join(cnt, "location_id").withColumn(
        "__block", F.pmod(F.xxhash64("sensor_id"), F.ceil(F.col("__n") / PAGE_SIZE)).cast("int"))
    per_loc = s.groupBy("location_id", "__block").agg(
        F.sort_array(F.collect_list(F.struct("sensor_id", "s"))).alias("ss"))
    loc = location.join(per_loc, "location_id", "left").withColumn("__page", F.coalesce("__block", F.lit(0)) + 1)
    embedded = F.when(F.col("location_id") % 4 != 0, F.transform("ss", lambda x: x["s"]))
    rec = F.struct(
        F.col("location_id").alias("id"),
        F.when(F.col("location_id") % 11 == 5, F.lit("")).otherwise(F.col("name")).alias("name"),
        F.col("locality"),
        F.col("city"),
        F.struct(F.lit(None).cast("string").alias("code"), F.col("country").alias("name")).alias("country"),
        F.struct(F.col("latitude").cast("double").alias("latitude"),
                 F.col("longitude").cast("double").alias("longitude")).alias("coordinates"),
        F.col("timezone"),
        embedded.alias("sensors"))
    loc_pages = loc.select(
        F.lit(1).alias("run_id"), F.lit("/v3/locations").alias("endpoint"),
        F.concat(F.lit("/v3/locations/"), F.col("location_id").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("params"), F.col("location_id").alias("source_id"),
        F.col("__page").alias("page_no"), F.to_json(F.struct(F.array(rec).alias("results"))).alias("response_body"))
    fallback = loc.filter(F.col("location_id") % 4 == 0).filter(F.col("ss").isNotNull()).select(
        F.lit(1).alias("run_id"), F.lit("/v3/locations/{id}/sensors").alias("endpoint"),
        F.concat(F.lit("/v3/locations/"), F.col("location_id").cast("string"), F.lit("/sensors")).alias("url"),
        F.lit(None).cast("string").alias("params"), F.col("location_id").alias("source_id"),
        F.col("__page").alias("page_no"),
        F.to_json(F.struct(F.transform("ss", lambda x: x["s"]).alias("results"))).alias("response_body"))
    return loc_pages.unionByName(fallback)


def land(pages: DataFrame, path: str, mode: str = "append") -> str:
    """Append raw pages as JSON lines (partitioned by run, compressed)."""
    pages.write.mode(mode).partitionBy("run_id").json(path, compression="gzip")
    return path


def read_landed(spark, path: str) -> DataFrame:
    """Read landed pages with a declared schema (no inference)."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


# --- parsing (S2-S6) ----------------------------------------------------------

def unnest(pages: DataFrame, record: T.StructType) -> DataFrame:
    """One row per record with its page order; a null or missing
    ``results`` is an empty page (explode drops it)."""
    parsed = pages.withColumn("__env", F.from_json("response_body", envelope(record)))
    return parsed.select("run_id", "endpoint", "source_id", "page_no",
                         F.posexplode("__env.results").alias("position", "rec"))


def parse_measurements(records: DataFrame) -> DataFrame:
    """S6 + F1 + F4: time precedence, unit precedence, number parse.

    Adds ``error`` (NULL for a good row): 'measurement skipped: missing time
    or value'. A present but unparsable time or number, or a value outside
    (-1000, 100000), is a database error in the reference (it undoes the
    sensor batch): 'rejected: ...'. ``message`` is the reading's error text:
    the whole text of a skipped reading (F19), the cause of a rejected one.
    """
    r = F.col("rec")
    t_text = S.reading_time_text(r["datetime"]["utc"], r["period"]["datetimeFrom"]["utc"], r["date"], r["datetimeUtc"])
    ts = S.lenient_timestamp(t_text).cast("timestamp_ntz")
    v_text = S.blank_to_null(r["value"])
    value = F.expr("try_cast(rec.value AS DECIMAL(12,4))")
    unit = S.normalize_unit(F.coalesce(S.blank_to_null(r["parameter"]["units"]), S.blank_to_null(r["unit"]),
                                       F.lit(S.UNKNOWN_UNIT)))
    missing = t_text.isNull() | v_text.isNull()
    out_of_range = (value <= S.VALUE_OPEN_MIN) | (value >= S.VALUE_OPEN_MAX)
    err = (F.when(missing, F.lit("measurement skipped: missing time or value"))
           .when(ts.isNull(), F.lit("rejected: unparsable time"))
           .when(value.isNull(), F.lit("rejected: unparsable value"))
           .when(out_of_range, F.lit("rejected: value out of range")))
    skipped = F.concat(
        F.lit("sensor "), F.col("source_id").cast("string"), F.lit(" measurement skipped at "),
        F.coalesce(t_text, F.lit("unknown")), F.lit(" for parameter "),
        F.coalesce(S.blank_to_null(r["parameter"]["name"]), F.lit("unknown")), F.lit(" with value "),
        F.coalesce(r["value"], F.lit("None")), F.lit(": Measurement payload missing datetime/value: "), F.to_json(r))
    message = (F.when(missing, skipped)
               .when(ts.isNull(), F.concat(F.lit("unparsable time "), t_text))
               .when(value.isNull(), F.concat(F.lit("unparsable value "), v_text))
               .when(out_of_range, F.concat(F.lit("value out of range "), v_text)))
    return records.select("run_id", "source_id", "page_no", "position",
                          F.col("source_id").alias("sensor_id"), ts.alias("measured_at"),
                          value.alias("value"), unit.alias("unit"),
                          F.to_json(r).alias("raw_payload"), err.alias("error"), message.alias("message"))


def parse_parameter(p) -> dict:
    """code = lower(name or code), blank -> error; display defaults to upper(code)."""
    code = F.lower(F.coalesce(S.blank_to_null(p["name"]), S.blank_to_null(p["code"])))
    return dict(code=code,
                display_name=F.coalesce(S.blank_to_null(p["displayName"]), F.upper(code)),
                preferred_unit=S.normalize_unit(F.coalesce(S.blank_to_null(p["units"]),
                                                           S.blank_to_null(p["unit"]), F.lit(S.UNKNOWN_UNIT))),
                source_parameter_id=p["id"])


def parameters_of(sensors_json: DataFrame, sensor_col: str = "s", order: list[str] = ()) -> DataFrame:
    """Parameter rows from sensor records (one per code; records with no
    name or code are errors and are dropped here, counted by the caller).
    Records of one code are folded as if upserted one after another in
    ``order`` (then sensor id): the last one's values, the first one's
    description."""
    p = parse_parameter(F.col(sensor_col)["parameter"])
    rows = sensors_json.select(p["code"].alias("code"), p["display_name"].alias("display_name"),
                               p["preferred_unit"].alias("preferred_unit"),
                               p["source_parameter_id"].cast("int").alias("openaq_parameter_id"),
                               F.col(sensor_col)["parameter"]["description"].alias("description"),
                               F.struct(*order, F.col(sensor_col)["id"].alias("__sensor")).alias("__at"))
    values = ["display_name", "preferred_unit", "openaq_parameter_id"]
    at = F.struct("__at", *values, "description")
    return rows.filter(F.col("code").isNotNull()).groupBy("code").agg(
        F.max_by(F.struct(*values), at).alias("__last"), F.min_by(F.struct("description"), at).alias("__first")) \
        .select("code", "__last.*", "__first.description")


def upsert_parameters(new: DataFrame, current: DataFrame) -> DataFrame:
    """S10 for parameters: by code, source id / display name / unit updated,
    description set on insert only; new codes get the next ids after the
    current maximum, in code order (the ranking runs over new codes only)."""
    from pyspark.sql.window import Window as W

    from aerolith.operators.dims import upsert_by_key
    fresh = new.join(current.select("code"), "code", "left_anti")
    top = current.agg(F.coalesce(F.max("parameter_id"), F.lit(0))).scalar()
    ids = fresh.select("code", (top + F.row_number().over(W.orderBy("code"))).cast("int").alias("parameter_id"))
    new = new.join(ids, "code", "left")
    cols = ["parameter_id", "openaq_parameter_id", "code", "display_name", "preferred_unit", "description"]
    return upsert_by_key(new.select(*cols), current.select(*cols), ["code"],
                         update=["openaq_parameter_id", "display_name", "preferred_unit"])


def upsert_sensors(new: DataFrame, current: DataFrame, now) -> DataFrame:
    """S10 for sensors: by sensor id, location, parameter and unit updated,
    first_seen_at kept, last_seen_at = ``now``, is_active = true. ``new`` has
    one row per sensor."""
    from aerolith.operators.dims import upsert_by_key
    new = new.withColumns({"first_seen_at": now, "last_seen_at": now, "is_active": F.lit(True)})
    return upsert_by_key(new, current.select(new.columns), ["sensor_id"],
                         update=["location_id", "parameter_id", "unit", "last_seen_at", "is_active"])


def sensor_records(locations: DataFrame, sensor_pages: DataFrame) -> DataFrame:
    """Every sensor record (``s``) of the location pages and of the sensor pages."""
    return locations.select(F.explode("sensors").alias("s")).unionAll(
        unnest(sensor_pages, SENSOR_JSON).select(F.col("rec").alias("s")))


def parse_locations(records: DataFrame, also: list[str] = ()) -> DataFrame:
    """S3 + F2/F3: location rows with defaults (and the columns ``also``)."""
    r = F.col("rec")
    return records.select(
        *also,
        r["id"].alias("location_id"),
        S.default_name(r["name"], S.LOCATION_NAME_PREFIX, r["id"]).alias("name"),
        S.city_name(r["locality"], r["city"], r["name"]).alias("city"),
        S.country_name(r["country"]["code"], r["country"]["name"]).alias("country"),
        r["coordinates"]["latitude"].cast("decimal(9,6)").alias("latitude"),
        r["coordinates"]["longitude"].cast("decimal(9,6)").alias("longitude"),
        r["timezone"].alias("timezone"),
        # raw place text, for the city scope (matched before any defaulting)
        r["locality"].alias("locality"), r["city"].alias("raw_city"), r["name"].alias("raw_name"),
        r["sensors"].alias("sensors"), "page_no", "position")


def distinct_locations(locations: DataFrame) -> DataFrame:
    """One row per location from parsed location records (a location whose
    sensors span several pages appears once per page): the last one in page
    order, as if upserted one after another."""
    from aerolith.operators.dims import last_per_key
    return last_per_key(locations.drop("sensors"), ["location_id"], ["page_no", "position"]) \
        .drop("page_no", "position")


LOCATION_COLS = ["location_id", "name", "city", "country", "latitude", "longitude", "timezone"]


def sensors_of(locations: DataFrame, sensor_pages: DataFrame | None = None,
               parameters: list[str] | None = None) -> DataFrame:
    """Embedded sensors win; sensor pages are used only for locations
    with no embedded sensors in scope (left anti on the location).
    ``parameters``: the wanted raw parameter names (S7); None wants all."""
    # the sensor scope compares the raw parameter name only
    name = F.lower(F.coalesce(F.col("s")["parameter"]["name"], F.lit("")))
    emb = locations.select("location_id", F.explode("sensors").alias("s"))
    emb = emb.select("location_id", F.col("s")["id"].alias("sensor_id"), F.col("s").alias("s"),
                     name.alias("scope_parameter"))
    emb = in_scope(emb, parameters=parameters)
    if sensor_pages is not None:
        fb = unnest(sensor_pages, SENSOR_JSON).select(F.col("source_id").alias("location_id"),
                                                      F.col("rec")["id"].alias("sensor_id"), F.col("rec").alias("s"))
        fb = in_scope(fb.withColumn("scope_parameter", name), parameters=parameters)
        fb = fb.join(emb.select("location_id").distinct(), "location_id", "left_anti")
        emb = emb.unionByName(fb)
    p = parse_parameter(F.col("s")["parameter"])
    return emb.select("sensor_id", "location_id", p["code"].alias("parameter_code"),
                      p["display_name"].alias("parameter_name"),
                      S.normalize_unit(F.coalesce(S.blank_to_null(F.col("s")["parameter"]["units"]),
                                                  S.blank_to_null(F.col("s")["unit"]),
                                                  F.lit(S.UNKNOWN_UNIT))).alias("unit"), "scope_parameter")


def in_scope(df: DataFrame, cities: list[str] | None = None, parameters: list[str] | None = None,
             text_cols=("locality", "raw_city", "raw_name"), parameter_col: str = "scope_parameter") -> DataFrame:
    """A row is in scope when any wanted city occurs (case-insensitive
    substring) in its joined place text, and its parameter is wanted."""
    out = df
    if cities:
        hay = F.lower(F.concat_ws(" ", *[S.blank_to_null(F.col(c)) for c in text_cols if c in df.columns]))
        cond = None
        for c in cities:
            e = hay.contains(c.lower())
            cond = e if cond is None else cond | e
        out = out.filter(cond)
    if parameters:
        out = out.filter(F.lower(F.col(parameter_col)).isin([p.lower() for p in parameters]))
    return out


def first_n(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """Cap to the first n in page order (a limit is the feature here)."""
    return df if n is None else df.orderBy(*order).limit(n)


# --- first-writer insert (S9 / T3) ------------------------------------------

def insert_if_absent(new: DataFrame, table: DataFrame | None, key=("sensor_id", "measured_at"),
                     order=("run_id", "page_no", "position")) -> DataFrame:
    """Rows to append. Inside the batch the first row per key in page order
    wins (min_by over the order, a partial aggregation); rows whose key is
    already stored are dropped (left anti), so a re-sent corrected value is
    ignored (first writer wins)."""
    key, order = list(key), list(order)
    others = [c for c in new.columns if c not in key]
    firsts = new.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__r")) \
        .select(*key, "__r.*")
    if table is not None:
        firsts = firsts.join(table.select(*key), key, "left_anti")
    return firsts


def run_counts(parsed: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per run, rows inserted (rows actually kept: the reference's overcount
    is fixed) and failed, error text (F19) and status of readings without
    their locations (a whole run with its units of work: ``sources.ingest``)."""
    bad = parsed.filter(F.col("error").isNotNull()).withColumn("__at", F.struct("source_id", "page_no", "position"))
    failed = bad.groupBy("run_id").agg(F.count(F.lit(1)).alias("records_failed"))
    ins = inserted.groupBy("run_id").agg(F.count(F.lit(1)).alias("records_inserted"))
    runs = parsed.select("run_id").distinct()
    from aerolith.operators.runs import error_texts, run_status
    j = (runs.join(ins, "run_id", "left").join(failed, "run_id", "left")
         .join(error_texts(bad, ["run_id"], "__at", "message"), "run_id", "left")
         .na.fill(0, ["records_inserted", "records_failed"]))
    return j.select("run_id", F.col("records_inserted").cast("bigint").alias("records_inserted"),
                    F.col("records_failed").cast("bigint").alias("records_failed"),
                    run_status(F.col("records_failed"), F.lit(False)).alias("status"), "error_message")


def landing_dir(spark, name: str) -> str:
    from aerolith.session import scratch_path
    return scratch_path(spark, "landing", name)


def land_once(spark, pages: DataFrame, name: str) -> DataFrame:
    """Land derived pages once per session folder, then read them back from files."""
    from aerolith.sources import store
    path = landing_dir(spark, name)
    marker = path + "._landed"
    with store.PUBLISH_LOCK:
        if store.read_marker(spark, marker) is None:
            land(pages, path, "overwrite")
            store.write_marker(spark, marker, path)
    return read_landed(spark, path)
