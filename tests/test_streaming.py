"""Streaming T9 (session windows with a watermark) against the batch sessions."""

import os
import tempfile

from pyspark.sql import functions as F

from aerolith.operators import reports as R
from aerolith.sources.driver_tables import core
from tests.conftest import SF_SMALL


def test_stream_sessions_match_batch_sessions_once_closed(spark):
    c = core(spark, SF_SMALL)
    m = c.measurement.select("sensor_id", "measured_at")
    src = tempfile.mkdtemp(prefix="sess-src-")
    m.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(m.schema).parquet(src) \
        .withColumn("event_time", F.col("measured_at").cast("timestamp")) \
        .withWatermark("event_time", "12 hours")
    sess = R.gap_sessions_streaming(stream, "sensor_id", "event_time", "6 hours")
    out, ckpt = tempfile.mkdtemp(prefix="sess-out-"), tempfile.mkdtemp(prefix="sess-ckpt-")
    q = (sess.select("sensor_id", F.col("first_at").cast("timestamp_ntz").alias("first_at"),
                     F.col("last_at").cast("timestamp_ntz").alias("last_at"), "readings")
         .writeStream.format("parquet").outputMode("append").option("path", os.path.join(out, "t"))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(os.path.join(out, "t")).collect()}
    wm = m.agg(F.max("measured_at")).first()[0]
    import datetime as dt
    batch = R.gap_sessions(m, key="sensor_id").filter(
        F.col("last_at") + F.expr("INTERVAL 6 HOURS") <= F.lit(wm - dt.timedelta(hours=12)))
    want = {tuple(r) for r in batch.select("sensor_id", "first_at", "last_at", "readings").collect()}
    assert want and want <= got  # every session closed by the watermark is emitted, identically
