"""One hot series holding a third of all rows: chunked operators keep every
group bounded and still give the plain-window answer."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.operators import reports as R
from aerolith.operators import windows as W
from aerolith.sources.driver_tables import core
from tests.conftest import SF_MID

HOT = 999_999


@pytest.fixture()
def skewed(spark, monkeypatch):
    monkeypatch.setattr(W, "TARGET_ROWS", 100)
    m = core(spark, SF_MID).measurement
    hot = F.when(F.col("measurement_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("sensor_id"))
    # the hot sensor takes every third reading; keep (sensor, time) unique
    return m.select(hot.alias("sensor_id"), "measured_at", F.col("value").cast("double").alias("v")) \
        .dropDuplicates(["sensor_id", "measured_at"])


def test_hot_series_is_a_third_and_chunks_stay_bounded(skewed):
    total = skewed.count()
    hot_rows = skewed.filter(F.col("sensor_id") == HOT).count()
    assert hot_rows > total / 4
    sizes = W.with_chunks(skewed, ["sensor_id"], "measured_at").groupBy("sensor_id", "__chunk").count()
    biggest = sizes.agg(F.max("count")).first()[0]
    assert biggest <= 3 * W.TARGET_ROWS  # vs hot_rows in one group for a plain window
    assert sizes.filter(F.col("sensor_id") == HOT).count() >= hot_rows // W.TARGET_ROWS


def test_features_on_hot_series_equal_plain_windows(skewed):
    def compute(ctx, w):
        return ctx.select("*", F.lag("v", 1).over(w).alias("p1"),
                          F.avg("v").over(w.rowsBetween(-5, 0)).alias("r6"), F.lead("v", 1).over(w).alias("n1"))
    got = W.sequence_window(skewed, ["sensor_id"], ["measured_at"], 5, 1, compute)
    want = compute(skewed, Window.partitionBy("sensor_id").orderBy("measured_at"))
    cols = ["sensor_id", "measured_at", "p1", "r6", "n1"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[4] == y[4] and (x[3] is None) == (y[3] is None)
        assert x[3] is None or abs(x[3] - y[3]) < 1e-9


def test_sessions_and_top_k_on_hot_series(skewed):
    s = R.gap_sessions(skewed, key="sensor_id")
    w = Window.partitionBy("sensor_id").orderBy("measured_at")
    gap = (F.unix_micros(F.col("measured_at").cast("timestamp"))
           - F.unix_micros(F.lag("measured_at").over(w).cast("timestamp"))) / 3.6e9
    starts = skewed.withColumn("__new", F.when(gap.isNull() | (gap > 6), 1).otherwise(0))
    plain = starts.withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("sensor_id", "__sid").agg(F.count(F.lit(1)).alias("readings"),
                                           F.min("measured_at").alias("first_at"))
    assert sorted((r.sensor_id, r.first_at, r.readings) for r in s.collect()) == \
        sorted((r.sensor_id, r.first_at, r.readings) for r in plain.collect())
    top = W.top_k_per_key(skewed, ["sensor_id"], ["measured_at"], 6).filter(F.col("sensor_id") == HOT)
    want = skewed.filter(F.col("sensor_id") == HOT).orderBy(F.desc("measured_at")).limit(6)
    assert [r.measured_at for r in top.orderBy("rank_desc").collect()] == [r.measured_at for r in want.collect()]


def test_bursty_series_is_chunked_by_rows_and_spread_over_tasks(spark, monkeypatch):
    """One reading years early, the rest in a few weeks; broadcasts off, so the
    plan is the one large inputs get."""
    monkeypatch.setattr(W, "TARGET_ROWS", 500)
    t0 = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    df = spark.range(20_000).select(
        F.lit(1).alias("sensor_id"),
        F.when(F.col("id") == 0, F.timestamp_add("YEAR", F.lit(-4), t0))
        .otherwise(F.timestamp_add("SECOND", F.col("id") * 97, t0)).alias("measured_at"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = W.with_chunks(df, ["sensor_id"], "measured_at").groupBy("__chunk").count()
        assert sizes.agg(F.max("count")).first()[0] <= 500 + 38
        prev = R.previous_time(df, "sensor_id", "measured_at")
        tasks = prev.groupBy(F.spark_partition_id()).count()
        assert prev.count() == 20_000 and tasks.agg(F.max("count")).first()[0] < 20_000 * 0.6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
