"""Chunked (hot-key safe) windows give the same answer as one plain window."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.operators import reports as R
from aerolith.operators.windows import sequence_window, top_k_per_key
from aerolith.sources.driver_tables import core
from tests.conftest import SF_MID


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_sequence_window_equals_plain_window(spark):
    m = core(spark, SF_MID).measurement.select("sensor_id", "measured_at",
                                               F.col("value").cast("double").alias("v"))

    def compute(ctx, w):
        return ctx.select("*", F.lag("v", 1).over(w).alias("p1"), F.lag("v", 5).over(w).alias("p5"),
                          F.avg("v").over(w.rowsBetween(-5, 0)).alias("r6"), F.lead("v", 1).over(w).alias("n1"))
    # hour chunks: many chunk boundaries, many empty chunks
    got = sequence_window(m, ["sensor_id"], ["measured_at"], 5, 1, compute,
                          chunk=F.date_trunc("hour", "measured_at"))
    w = Window.partitionBy("sensor_id").orderBy("measured_at")
    want = compute(m, w)
    cols = ["sensor_id", "measured_at", "p1", "p5", "r6", "n1"]
    assert _rows(got, cols) == _rows(want, cols)


def test_top_k_per_key_equals_row_number(spark):
    m = core(spark, SF_MID).measurement.select("sensor_id", "measured_at")
    got = top_k_per_key(m, ["sensor_id"], ["measured_at"], 6)
    w = Window.partitionBy("sensor_id").orderBy(F.desc("measured_at"))
    want = m.withColumn("rank_desc", F.row_number().over(w)).filter("rank_desc <= 6")
    assert _rows(got, ["sensor_id", "measured_at", "rank_desc"]) == _rows(want, ["sensor_id", "measured_at",
                                                                                 "rank_desc"])


def test_chunked_previous_time_equals_lag(spark):
    m = core(spark, SF_MID).measurement.select("sensor_id", "measured_at")
    got = R.previous_time(m, "sensor_id", "measured_at", chunk=F.date_trunc("hour", "measured_at"))
    want = m.withColumn("previous_at", F.lag("measured_at").over(
        Window.partitionBy("sensor_id").orderBy("measured_at")))
    cols = ["sensor_id", "measured_at", "previous_at"]
    assert _rows(got, cols) == _rows(want, cols)


def test_row_sized_chunks_match_plain_windows(spark, monkeypatch):
    from aerolith.operators import windows as W
    monkeypatch.setattr(W, "TARGET_ROWS", 4)  # ~4 rows per chunk: boundaries everywhere
    m = core(spark, SF_MID).measurement.select("sensor_id", "measured_at",
                                               F.col("value").cast("double").alias("v"))

    def compute(ctx, w):
        return ctx.select("*", F.lag("v", 5).over(w).alias("p5"), F.lead("v", 1).over(w).alias("n1"))
    got = sequence_window(m, ["sensor_id"], ["measured_at"], 5, 1, compute)
    want = compute(m, Window.partitionBy("sensor_id").orderBy("measured_at"))
    cols = ["sensor_id", "measured_at", "p5", "n1"]
    assert _rows(got, cols) == _rows(want, cols)
    sess = R.gap_sessions(m, key="sensor_id")
    assert sess.agg(F.sum("readings")).first()[0] == m.count()
