"""Operational (core) tables derived from the driver's test tables.

Mapping (one place, mirrored by ``aerolith.plans.oracle.CORE_CTES``):

* parameter   - distinct ``events.event_type`` in alphabetical order, id 1..n
* location    - every ``customer``; city = nation name, country = region name,
                latitude/longitude from a fixed formula of the key
* sensor      - distinct (user_id, event_type) of ``events``; located at customer
                ``user_id``; id = user_id * 1000 + parameter_id
* measurement - one reading per event; value as decimal(12,4), month partitioned
* threshold_rule - for every (city, parameter) that has a sensor, the four
                warning levels with nation-dependent minimums

The core layer is written once per session into the shared checkpoint folder
(the "ingest" step) so later jobs scan Parquet with real file statistics:
small dimensions then broadcast by measured size, readings prune by month.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S
from aerolith.session import scratch_path

# Fixed values of the mapping.
# Threshold minimums per warning level (low, moderate, high, critical); the
# non-low levels are raised by (nation key mod 3).
LEVEL_BASE_MIN = [("low", 0, 0), ("moderate", 1, 10), ("high", 2, 25), ("critical", 3, 50)]
SENSOR_ID_FACTOR = 1000
RULE_NATION_FACTOR = 1000
LOCATION_FIRST_SEEN_BASE = "2023-12-01 00:00:00"

from aerolith.sources.store import PUBLISH_LOCK as _LOCK  # noqa: E402


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def build_parameter(events: DataFrame) -> DataFrame:
    codes = events.select(F.col("event_type").alias("code")).where(F.col("code").isNotNull()).distinct()
    # The window runs over the parameter vocabulary (a handful of codes), not readings.
    w = Window.orderBy("code")
    return codes.select(
        F.row_number().over(w).cast("int").alias("parameter_id"),
        F.row_number().over(w).cast("int").alias("openaq_parameter_id"),
        "code",
        F.upper("code").alias("display_name"),
        F.lit(S.DEFAULT_UNIT).alias("preferred_unit"),
        F.lit(None).cast("string").alias("description"),
    )


def build_location(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "n_name", "r_name")
    c = customer.select("c_custkey", "c_name", "c_nationkey")
    first_seen = F.timestamp_add("HOUR", (F.col("c_custkey") % 720).cast("int"),
                                 F.lit(LOCATION_FIRST_SEEN_BASE).cast("timestamp_ntz"))
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_custkey").alias("openaq_location_id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("locality"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        ((((F.col("c_custkey") * 7) % 1801) - 900).cast("double") / 10).cast("decimal(9,6)").alias("latitude"),
        ((((F.col("c_custkey") * 13) % 3601) - 1800).cast("double") / 10).cast("decimal(9,6)").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        ((F.col("c_custkey") % 10) != 9).alias("is_active"),
        first_seen.alias("first_seen_at"),
        F.timestamp_add("DAY", (F.col("c_custkey") % 7).cast("int"), first_seen).alias("last_seen_at"),
        F.col("c_nationkey").cast("int").alias("nation_key"),
    )


def build_sensor(events: DataFrame, parameter: DataFrame) -> DataFrame:
    spans = events.groupBy("user_id", "event_type").agg(
        F.min("ts").alias("first_seen_at"), F.max("ts").alias("last_seen_at"))
    p = parameter.select(F.col("code").alias("event_type"), "parameter_id")
    sid = F.col("user_id") * SENSOR_ID_FACTOR + F.col("parameter_id")
    return spans.join(p, "event_type").select(
        sid.alias("sensor_id"),
        sid.alias("openaq_sensor_id"),
        F.col("user_id").alias("location_id"),
        "parameter_id",
        F.lit(S.DEFAULT_UNIT).alias("unit"),
        ((sid % 13) != 0).alias("is_active"),
        "first_seen_at",
        "last_seen_at",
    )


def build_measurement(events: DataFrame, parameter: DataFrame) -> DataFrame:
    p = parameter.select(F.col("code").alias("event_type"), "parameter_id")
    return events.join(p, "event_type").select(
        F.col("event_id").alias("measurement_id"),
        (F.col("user_id") * SENSOR_ID_FACTOR + F.col("parameter_id")).alias("sensor_id"),
        F.col("ts").alias("measured_at"),
        F.col("value").cast("decimal(12,4)").alias("value"),
        F.lit(S.DEFAULT_UNIT).alias("unit"),
        F.col("props").alias("raw_payload"),
        S.date_key("ts").alias("ingestion_run_id"),
        F.trunc(F.col("ts").cast("date"), "MM").alias("measured_month"),
    )


def build_threshold_rule(sensor: DataFrame, location: DataFrame) -> DataFrame:
    """S11 default rules: the four levels for every (city, parameter) in scope.

    Levels are an ``explode`` of a literal array, not a cross join.
    """
    scope = sensor.select("location_id", "parameter_id").distinct() \
        .join(location.select("location_id", "city", "nation_key"), "location_id") \
        .select("nation_key", "city", "parameter_id").distinct()
    levels = F.array(*[F.struct(F.lit(code).alias("warning_level"), F.lit(i).alias("level_idx"),
                                F.lit(base).alias("base")) for code, i, base in LEVEL_BASE_MIN])
    r = scope.select("nation_key", "city", "parameter_id", F.explode(levels).alias("lv"))
    rule_id = (F.col("nation_key").cast("bigint") * RULE_NATION_FACTOR + F.col("parameter_id")) * 4 \
        + F.col("lv.level_idx")
    offset = F.when(F.col("lv.level_idx") > 0, F.col("nation_key") % 3).otherwise(0)
    return r.select(
        rule_id.alias("threshold_rule_id"),
        "parameter_id",
        "city",
        F.col("lv.warning_level").alias("warning_level"),
        (F.col("lv.base") + offset).cast("decimal(12,4)").alias("min_value"),
        ((rule_id % 7) != 0).alias("is_active"),
        F.lit(LOCATION_FIRST_SEEN_BASE).cast("timestamp_ntz").alias("updated_at"),
    )


class Core:
    """Lazily built, once-materialised core tables for one input folder."""

    TABLES = ("parameter", "location", "sensor", "measurement", "threshold_rule")

    INPUTS = ("events", "customer", "nation", "region")

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs = input_key(spark, sf_dir)
        self._frames: dict[str, DataFrame] = {}
        if materialize:
            self._materialize()

    # raw driver tables -------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    def _store_dir(self) -> str:
        # keyed by the input files and the code that builds the store
        import sys

        from aerolith.session import code_version
        return scratch_path(self.spark, "core", f"{self.inputs}-{code_version(sys.modules[__name__])}")

    def _lazy(self) -> dict[str, DataFrame]:
        ev = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
        parameter = build_parameter(ev)
        location = build_location(self.raw("customer"), self.raw("nation"), self.raw("region"))
        sensor = build_sensor(ev, parameter)
        measurement = build_measurement(ev, parameter)
        rule = build_threshold_rule(sensor, location)
        return dict(parameter=parameter, location=location, sensor=sensor,
                    measurement=measurement, threshold_rule=rule)

    def _materialize(self) -> None:
        from aerolith.sources import store
        root = self._store_dir()
        done = os.path.join(root, "_published")
        with _LOCK:
            run = store.read_marker(self.spark, done)
            if run is None:
                run = os.path.join(root, f"run-{uuid.uuid4().hex[:12]}")
                self._build(run)
                # publish last: the marker names the finished run folder
                store.write_marker(self.spark, done, run)
        for t in self.TABLES:
            self._frames[t] = self.spark.read.parquet(os.path.join(run, t))

    def _build(self, run: str) -> None:
        """Write the core tables. Independent writes are submitted from a
        small thread pool so Spark runs them as concurrent jobs: the parameter
        vocabulary first, then locations, sensors and readings together, then
        the rules (which need sensors and locations)."""
        from concurrent.futures import ThreadPoolExecutor

        path = lambda t: os.path.join(run, t)
        ev = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
        build_parameter(ev).coalesce(1).write.mode("overwrite").parquet(path("parameter"))
        parameter = self.spark.read.parquet(path("parameter"))

        def location():
            build_location(self.raw("customer"), self.raw("nation"), self.raw("region")) \
                .write.mode("overwrite").parquet(path("location"))

        def sensor():
            build_sensor(ev, parameter).write.mode("overwrite").parquet(path("sensor"))

        def measurement():
            # Month partitions; rows sorted by (sensor, time) inside each
            # file so min/max statistics skip row groups for sensor/time filters.
            # Rebalanced by month: few files a month, and AQE splits a large
            # month over several tasks.
            (build_measurement(ev, parameter).hint("rebalance", F.col("measured_month"))
             .sortWithinPartitions("measured_month", "sensor_id", "measured_at")
             .write.mode("overwrite").partitionBy("measured_month").parquet(path("measurement")))

        with ThreadPoolExecutor(max_workers=3) as pool:
            jobs = {name: pool.submit(fn) for name, fn in
                    (("location", location), ("sensor", sensor), ("measurement", measurement))}
            jobs["location"].result()
            jobs["sensor"].result()
            rules = pool.submit(lambda: build_threshold_rule(
                self.spark.read.parquet(path("sensor")), self.spark.read.parquet(path("location")))
                .write.mode("overwrite").parquet(path("threshold_rule")))
            jobs["measurement"].result()
            rules.result()

    def __getattr__(self, name: str) -> DataFrame:
        if name in Core.TABLES:
            if name not in self._frames:
                self._frames.update(self._lazy())
            return self._frames[name]
        raise AttributeError(name)

    @property
    def events(self) -> DataFrame:
        return self.raw("events")


def input_key(spark: SparkSession, sf_dir: str) -> str:
    """Names a folder and the files its core inputs consist of now."""
    from aerolith.sources import store
    files = store.input_version(spark, [os.path.join(sf_dir, f"{t}.parquet") for t in Core.INPUTS])
    return hashlib.sha1(f"{os.path.abspath(sf_dir)} {files}".encode()).hexdigest()[:16]


_CORES: dict[tuple, Core] = {}


def core(spark: SparkSession, sf_dir: str) -> Core:
    """One Core per session and state of the input files."""
    key = (id(spark), input_key(spark, sf_dir), spark.conf.get("spark.checkpoint.dir", ""))
    c = _CORES.get(key)
    if c is None or c.spark is not spark:  # ids can be reused by a later session
        c = Core(spark, sf_dir)
        _CORES[key] = c
    return c
