"""Structured Streaming versions of the ingest path.

Source: landed JSON pages (file source, declared schema). Each job runs with
``trigger(availableNow=True)`` for batch-like catch-up, or with a processing
time trigger in production; state and progress live in a checkpoint folder
under ``spark.checkpoint.dir`` so a restarted job (or a lost executor)
resumes without loss or duplication.

* T8 hourly series: 12 h watermark (T2: later data is dropped), tumbling 1 h
  windows, append mode: a window is emitted once the watermark passes its end.
* T4 alerts: stream-static join of readings with the rule bands.
* T8 and T4 read the readings that T3 inserted, not the pages, so a page sent
  again neither counts a reading twice nor raises a second alert.
* T8 with updates: the same windows in update mode, for readers that want open
  windows too; every micro-batch writes its changed windows as a version of its
  own (a retried batch overwrites itself), and reading merges them by key.
* T9 sessions: ``session_window`` state, which a late reading between two open
  sessions merges into one; a session is emitted once it is closed.
* T3 first-writer insert: ``foreachBatch`` keeps the first row per
  (sensor, time) in page order and anti-joins the stored table, so replays
  and retried batches change nothing (exactly-once effect on a file sink).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions import scalars as S
from aerolith.operators import alerts as A
from aerolith.session import scratch_path, staged
from aerolith.sources import bronze as B
from aerolith.sources import store

WATERMARK = "12 hours"

#: most files a micro-batch takes, so that a catch-up is a series of bounded batches
MAX_FILES = 10_000


def page_stream(spark: SparkSession, landing: str) -> DataFrame:
    """Landed pages as a stream (new files are new pages)."""
    return spark.readStream.schema(B.PAGE_SCHEMA).option("maxFilesPerTrigger", MAX_FILES).json(landing)


class Feed:
    """One insert stream (T3) over a landing folder, and the consumers of the
    readings it inserts. ``land`` appends pages and runs the insert; consumers
    read the table as a stream with a checkpoint of their own, so each picks up
    where its last run ended."""

    def __init__(self, spark: SparkSession, name: str, landing: str | None = None):
        self.spark = spark
        dirs = new_stream_dirs(spark, name)
        self.landing, self.table, self._checkpoint = landing or dirs["landing"], dirs["table"], dirs["checkpoint"]

    def land(self, pages: DataFrame | None = None) -> Feed:
        if pages is not None:
            B.land(pages, self.landing)
        self.stored = first_writer_stream(self.spark, self.landing, self.table, self._checkpoint)
        return self

    def inserted(self) -> DataFrame:
        """Readings as T3 inserts them, each (sensor, time) once."""
        return self.spark.readStream.schema(self.stored.schema).option("maxFilesPerTrigger", MAX_FILES).parquet(self.table)

    def dirs(self, consumer: str, once: bool = False) -> tuple[str, str]:
        """A consumer's output and checkpoint folder: the same at every run, or
        new ones for a consumer that runs ``once`` over all that was inserted."""
        base = self.table.rsplit("/", 1)[0]
        consumer += f"-{uuid.uuid4().hex[:12]}" if once else ""
        return f"{base}/{consumer}/out", f"{base}/{consumer}/checkpoint"


def parsed_stream(spark: SparkSession, landing: str) -> DataFrame:
    return B.parse_measurements(B.unnest(page_stream(spark, landing), B.MEASUREMENT_JSON))


def enrich(readings: DataFrame, core) -> DataFrame:
    """Stream-static join: sensor -> location -> parameter (static sides)."""
    s = core.sensor.select("sensor_id", "location_id", "parameter_id")
    loc = core.location.select("location_id", "city")
    p = core.parameter.select("parameter_id", F.col("code").alias("parameter_code"))
    return readings.join(s, "sensor_id").join(loc, "location_id").join(p, "parameter_id")


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _hourly_windows(feed: Feed, core) -> DataFrame:
    """T8 (+T2): tumbling hours per (city, parameter, unit) behind the watermark."""
    r = enrich(feed.inserted(), core).withColumn("event_time", F.col("measured_at").cast("timestamp"))
    agg = (r.withWatermark("event_time", WATERMARK)
           .groupBy(F.window("event_time", "1 hour").alias("w"), "city", "parameter_code", "unit")
           .agg(S.exact_mean("value").alias("average_value"),
                F.count(F.lit(1)).alias("measurement_count")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("measured_hour"), "city", "parameter_code", "unit",
                      "average_value", "measurement_count")


def hourly_stream(feed: Feed, core) -> DataFrame:
    """Closed hourly windows, each once."""
    out, ckpt = feed.dirs("hourly", once=True)
    q = (_hourly_windows(feed, core).writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _run(q)
    return feed.spark.read.parquet(out)


HOUR_KEY = ["measured_hour", "city", "parameter_code", "unit"]


def hourly_updates(feed: Feed, core) -> DataFrame:
    """T8 in update mode: every window with its latest values, open ones too,
    and the number of ``updates`` it took. Rows behind the watermark are lost."""
    out, ckpt = feed.dirs("hourly-updates")

    def version(batch: DataFrame, batch_id: int) -> None:
        # one job a batch: asking for its rows first would run its whole state twice
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    q = (_hourly_windows(feed, core).writeStream.outputMode("update").foreachBatch(version)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _run(q)
    return merged_versions(feed.spark.read.parquet(out), HOUR_KEY)


def merged_versions(versions: DataFrame, key: list[str], version: str = "batch_id") -> DataFrame:
    """The latest version of each key (a partial aggregation), and how many there are."""
    values = [c for c in versions.columns if c not in (*key, version)]
    return versions.groupBy(*key).agg(F.max_by(F.struct(*values), version).alias("__last"),
                                      F.count(F.lit(1)).alias("updates")).select(*key, "__last.*", "updates")


def session_stream(feed: Feed, core, key: list[str], gap: str = "6 hours") -> DataFrame:
    """Closed gap-bounded sessions of the inserted readings per ``key``."""
    from aerolith.operators.reports import gap_sessions_streaming
    out, ckpt = feed.dirs("sessions")
    r = enrich(feed.inserted(), core).withColumn("event_time", F.col("measured_at").cast("timestamp")).withWatermark("event_time", WATERMARK)
    res = gap_sessions_streaming(r, key, "event_time", gap).select(
        *key, *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_at", "last_at")], "readings")
    q = (res.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _run(q)
    return feed.spark.read.parquet(out)


def alert_stream(feed: Feed, core) -> DataFrame:
    """T4: alerts for inserted readings (stream-static join with the rule bands)."""
    out, ckpt = feed.dirs("alerts", once=True)
    r = enrich(feed.inserted(), core).select(F.col("sensor_id"), "measured_at", "value", "parameter_id", "city")
    # the reading id is not in the page; the stream's alert is keyed by (sensor, time)
    a = _alerts_by_key(r, core)
    q = (a.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _run(q)
    return feed.spark.read.parquet(out)


def _alerts_by_key(r: DataFrame, core) -> DataFrame:
    b = A.rule_bands(core.threshold_rule)
    cond = (r["parameter_id"] == b["parameter_id"]) & (r["city"] == b["city"]) & \
        (r["value"] >= b["band_lo"]) & (b["band_hi"].isNull() | (r["value"] < b["band_hi"]))
    return r.join(b, cond, "inner").select(
        r["sensor_id"], r["measured_at"].alias("measurement_measured_at"), b["threshold_rule_id"],
        b["warning_level"].alias("alert_level"), F.lit("open").alias("status"))


def first_writer_stream(spark: SparkSession, landing: str, table: str, checkpoint: str) -> DataFrame:
    """One availableNow run of the insert stream over ``landing``.

    Call again after new pages arrive: the checkpoint makes the run pick up
    only new files; the anti join against ``table`` makes replays and retried
    batches no-ops. Returns the stored table."""
    cols = ["sensor_id", "measured_at", "value", "unit", "run_id", "page_no", "position"]

    def upsert(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(F.col("error").isNull()).select(*cols) \
            .withColumn("measured_month", F.trunc(F.col("measured_at").cast("date"), "MM"))
        good = staged(good, "readings")  # read for its time range and for its rows; parsed once
        stored = None
        if store.exists(spark, table):
            # only the stored rows inside the batch's time range can clash:
            # month partitions are pruned and the time filter is pushed down
            lo, hi = good.agg(F.min("measured_at"), F.max("measured_at")).first()
            if lo is None:
                return
            stored = spark.read.parquet(table).filter(
                (F.col("measured_month") >= F.trunc(F.lit(lo).cast("date"), "MM"))
                & (F.col("measured_month") <= F.trunc(F.lit(hi).cast("date"), "MM"))
                & F.col("measured_at").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
        B.insert_if_absent(good, stored).hint("rebalance", F.col("measured_month")).write.mode("append").partitionBy("measured_month").parquet(table)

    q = (parsed_stream(spark, landing).writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(table)


def new_stream_dirs(spark: SparkSession, name: str) -> dict[str, str]:
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    return {k: scratch_path(spark, "streams", run, k) for k in ("landing", "table", "checkpoint")}
