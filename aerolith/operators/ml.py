"""Model training and scoring with Spark ML.

* M3: location and sensor keys one-hot encoded (StringIndexer keeps unseen
  values in an extra bucket that OneHotEncoder(dropLast) turns into the zero
  vector, like ``handle_unknown='ignore'``); numeric features standardised.
* M4: ordinary least squares (regParam 0); with many one-hot keys
  ``operators.linear`` makes Spark ML's steps from sums by key.
* M5: random forest, 200 trees, at least 2 rows per leaf, all features per
  split, bootstrap, seed 42, depth at most ``RF_MAX_DEPTH`` (the reference's
  trees are unbounded). With one-hot keys ``operators.forest`` grows it, which
  counts only the keys that a node's rows have; with hashed keys Spark ML does.
* M6: the lower test MAE wins; the linear model wins ties; no refit.
* S16: the chosen PipelineModel and its metrics are saved together.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators import forest, linear
from aerolith.session import staged

CATEGORICAL = ["source_location_id", "source_sensor_id"]
NUMERIC = ["current_value", "previous_value", "rolling_3h", "rolling_6h", "hour", "minute", "weekday", "month"]
LABEL = "target_value"
RF_MAX_DEPTH = forest.MAX_DEPTH  # the deepest trees Spark ML grows
# Node statistics a task may hold (MB); results do not depend on it, a small
# one means more passes. Unset: a quarter of the heap over its tasks, at most
# Spark's default of 256 MB.
RF_MEMORY_CONF = "spark.aerolith.forest.maxMemoryInMB"
MODEL_NAMES = ("linear-regression", "random-forest")


HASHED_KEY_FEATURES = 4096


def forest_memory_mb(spark: SparkSession) -> int:
    said = spark.conf.get(RF_MEMORY_CONF, None)
    if said:
        return int(said)
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        heap = sc._jvm.java.lang.Runtime.getRuntime().maxMemory() >> 20
        tasks = sc.defaultParallelism
    else:
        conf = sc.getConf()
        heap = sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(conf.get("spark.executor.memory", "1g"))
        tasks = int(conf.get("spark.executor.cores", "1"))
    return max(16, min(256, heap // 4 // tasks))


def pipeline(model_name: str, seed: int = 42, key_encoding: str = "onehot") -> Pipeline:
    """``key_encoding``: 'onehot' (the reference's encoding; width grows with
    the number of sensors) or 'hashed' (FeatureHasher, fixed width
    ``HASHED_KEY_FEATURES`` however many sensors exist)."""
    if key_encoding == "hashed":
        keys = [FeatureHasher(inputCols=CATEGORICAL, categoricalCols=CATEGORICAL,
                              numFeatures=HASHED_KEY_FEATURES, outputCol="__keys")]
        key_cols = ["__keys"]
    else:
        idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                             stringOrderType="alphabetAsc") for c in CATEGORICAL]
        ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in CATEGORICAL],
                            outputCols=[f"{c}__ohe" for c in CATEGORICAL], dropLast=True, handleInvalid="keep")
        keys = [*idx, ohe]
        key_cols = [f"{c}__ohe" for c in CATEGORICAL]
    num = VectorAssembler(inputCols=NUMERIC, outputCol="__num")
    scale = StandardScaler(inputCol="__num", outputCol="__num_scaled", withMean=True, withStd=True)
    feats = VectorAssembler(inputCols=key_cols + ["__num_scaled"], outputCol="features")
    if model_name == "linear-regression":
        est = LinearRegression(featuresCol="features", labelCol=LABEL, regParam=0.0, elasticNetParam=0.0)
    else:
        est = RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=200, minInstancesPerNode=2,
                                    featureSubsetStrategy="all", bootstrap=True, subsamplingRate=1.0,
                                    maxDepth=RF_MAX_DEPTH, seed=seed,
                                    maxMemoryInMB=forest_memory_mb(SparkSession.active()))
    return Pipeline(stages=[*keys, num, scale, feats, est])


def fit_model(model_name: str, train: DataFrame, key_encoding: str = "onehot", seed: int = 42):
    """The fitted candidate: a PipelineModel, or a Forest over the slots of the one-hot keys."""
    whole = pipeline(model_name, seed, key_encoding)
    if key_encoding == "hashed":
        return whole.fit(train)
    if model_name == "linear-regression":
        prep = Pipeline(stages=whole.getStages()[:-1]).fit(train)
        sizes = next(m.categorySizes for m in prep.stages if isinstance(m, OneHotEncoderModel))
        return linear.fit(train, prep, sizes, "__num_scaled", [f"{c}__idx" for c in CATEGORICAL], whole.getStages()[-1])
    kept = (StringIndexer, VectorAssembler, StandardScaler)  # an index is the slot of its one-hot column
    prep = Pipeline(stages=[s for s in whole.getStages()[:-2] if isinstance(s, kept)]).fit(train)
    return forest.fit(train, prep, "__num_scaled", [f"{c}__idx" for c in CATEGORICAL], LABEL, seed)


def _cast(df: DataFrame) -> DataFrame:
    # StringIndexer takes the numeric keys as they are (it indexes their text)
    return df.select(*[F.col(c).cast("double").alias(c) if c in NUMERIC else F.col(c) for c in df.columns])


def regression_metrics(pred: DataFrame) -> tuple[float, float, float]:
    """MAE, RMSE and R2 of ``prediction`` for ``y``, as Spark ML's evaluator gives them."""
    e = F.col("prediction") - F.col("y")
    mean = pred.agg(F.avg("y")).first()[0]
    mae, mse, dev = pred.agg(F.avg(F.abs(e)), F.avg(e * e),
                                F.avg((F.col("y") - F.lit(mean)) * (F.col("y") - F.lit(mean)))).first()
    r2 = 1 - mse / dev if dev else (float("nan") if not mse else float("-inf"))
    return float(mae), float(mse) ** 0.5, float(r2)


def evaluate(split_frame: DataFrame, key_encoding: str = "onehot") -> tuple[PipelineModel | forest.Forest, DataFrame]:
    """M4-M6 on a frame with ``split`` = train/test. Returns the chosen model
    and a metrics frame (one row per candidate, ``chosen`` flag)."""
    # the split's many small partitions are read back as few: each step of the linear fit runs over all of them
    data = staged(_cast(split_frame), "split")
    train = data.filter(F.col("split") == "train").cache()
    test = data.filter(F.col("split") == "test").cache()
    spark = split_frame.sparkSession
    rows, best, best_mae, models = [], None, None, {}
    n_train, n_test = train.count(), test.count()
    for name in MODEL_NAMES:
        model = fit_model(name, train, key_encoding)
        # staged: a model with many keys is sent with the tasks of one job only
        pred = staged(model.transform(test).select(F.col(LABEL).cast("double").alias("y"), "prediction"), "scored")
        mae, rmse, r2 = regression_metrics(pred)
        rows.append((name, mae, rmse, r2, n_train, n_test))
        models[name] = model
        if best_mae is None or mae < best_mae:  # strictly lower: the first (linear) wins ties
            best, best_mae = name, mae
    train.unpersist()
    test.unpersist()
    metrics = spark.createDataFrame(rows, "model_name string, mae double, rmse double, r2 double, "
                                          "train_rows long, test_rows long") \
        .withColumn("chosen", F.col("model_name") == F.lit(best))
    return models[best], metrics


def save(model: PipelineModel | forest.Forest, metrics: DataFrame, path: str, model_version: str, trained_at) -> None:
    """Model and metrics bundle in one folder."""
    if isinstance(model, forest.Forest):
        model.save(f"{path}/forest")
    else:
        model.write().overwrite().save(f"{path}/model")
    chosen = metrics.filter("chosen").first()
    bundle = {"model_name": chosen["model_name"], "model_version": model_version,
              "trained_at": (trained_at.isoformat() if isinstance(trained_at, dt.datetime) else str(trained_at)),
              "kind": "forest" if isinstance(model, forest.Forest) else "model",
              "metrics": {k: chosen[k] for k in ("mae", "rmse", "r2", "train_rows", "test_rows")}}
    metrics.sparkSession.createDataFrame([(json.dumps(bundle),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/metrics")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel | forest.Forest, dict]:
    bundle = json.loads(spark.read.text(f"{path}/metrics").first()[0])
    read = forest.Forest.load if bundle["kind"] == "forest" else lambda _, p: PipelineModel.load(p)
    return read(spark, f"{path}/{bundle['kind']}"), bundle


def score(model: PipelineModel | forest.Forest, inputs: DataFrame) -> DataFrame:
    """M8: model predictions for prediction inputs (adds ``prediction``)."""
    return model.transform(_cast(inputs))
