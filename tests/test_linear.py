"""Least squares over many one-hot keys: the same model as Spark ML's steps over
the rows, from sums by key."""

import numpy as np
from pyspark.sql import functions as F

from aerolith.operators import linear as LI
from aerolith.operators import ml as ML


def _frame(spark, n, sensors):
    f = spark.range(n).select(
        (F.col("id") * 7 % sensors).alias("source_sensor_id"), (F.col("id") * 7 % sensors % 300).alias("source_location_id"),
        *[(F.xxhash64("id", F.lit(c)) % 97 + 97).cast("double").alias(c) for c in ML.NUMERIC])
    return f.withColumn(ML.LABEL, F.col("current_value") + (F.col("source_sensor_id") % 5) * 20 + F.xxhash64(*ML.NUMERIC) % 50)


def _odd(spark):
    """A null key, a constant column, a key that is always met with two others."""
    return _frame(spark, 9000, 4500).withColumn("month", F.lit(1.0)) \
        .withColumn("source_location_id", F.when(F.col("source_sensor_id") % 9 == 0, F.lit(None)).otherwise(F.col("source_location_id") + F.col("hour") % 2))


def test_wide_model_equals_spark_mls(spark, tmp_path):
    train = _odd(spark).repartition(2).cache()
    made, whole = ML.fit_model("linear-regression", train), ML.pipeline("linear-regression").fit(train)
    a, b = made.stages[-1], whole.stages[-1]
    assert a.numFeatures == b.numFeatures > LI.NORMAL_MAX
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-6, atol=1e-6)
    assert abs(a.intercept - b.intercept) < 1e-6
    made.write().overwrite().save(str(tmp_path / "m"))
    test = train.limit(20).withColumn("source_sensor_id", F.col("source_sensor_id") + F.when(F.col("minute") > 150, 10 ** 9).otherwise(0))
    got = [sorted(r.prediction for r in m.transform(test).collect()) for m in (made, whole, ML.PipelineModel.load(str(tmp_path / "m")))]
    assert got[0] == got[2] and np.allclose(got[0], got[1], atol=1e-6)


def test_wide_fit_reads_the_rows_a_few_times(spark, monkeypatch):
    """Spark ML made two to three passes over all rows for each of some twenty steps."""
    train = _frame(spark, 9000, 4500)
    fitted = []
    monkeypatch.setattr(LI.LinearRegression, "fit", lambda self, df: fitted.append(df))
    steps = []
    solve = LI.Squares.solve
    monkeypatch.setattr(LI.Squares, "solve", lambda self, *a: steps.append(solve(self, *a)) or steps[-1])
    ML.fit_model("linear-regression", train)
    assert not fitted and len(steps[0][2]) > 5 and steps[0][2] == sorted(steps[0][2], reverse=True)


def test_a_narrow_model_is_spark_mls(spark):
    train = _frame(spark, 400, 20)
    a, b = ML.fit_model("linear-regression", train).stages[-1], ML.pipeline("linear-regression").fit(train).stages[-1]
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray())


def test_metrics_are_the_evaluators(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    pred = spark.range(200).select((F.xxhash64("id") % 90).cast("double").alias("y"), (F.xxhash64("id") % 90 + F.col("id") % 7).cast("double").alias("prediction"))
    ev = RegressionEvaluator(labelCol="y", predictionCol="prediction")
    assert np.allclose(ML.regression_metrics(pred), [ev.setMetricName(m).evaluate(pred) for m in ("mae", "rmse", "r2")])
