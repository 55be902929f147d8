"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. UTC keeps date/time keys identical to the
# warehouse contract; AQE re-plans joins from runtime sizes (this is the size
# check behind every data-derived dimension join) and splits skewed partitions.
# Broadcasts are collected at the driver, and before a table is read only the
# size of its files is known: sequential keys and names take many times that
# in memory. The limit is on files, so that a build stays at some tens of MB.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
BROADCAST_CONF, BROADCAST_MB = "spark.sql.autoBroadcastJoinThreshold", 1


def limit_broadcasts(spark: SparkSession) -> None:
    """Hold the session's broadcast limit to ``BROADCAST_MB``; a lower one stays."""
    most, held = BROADCAST_MB << 20, spark.conf.get(BROADCAST_CONF)
    if not held.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > most:
        spark.conf.set(BROADCAST_CONF, str(most))


# Texts go to Python workers in Arrow batches, by default of 10,000 rows however
# long: the JVM, the worker and what the worker makes of a batch hold it whole,
# and workers live on with the memory they once took.
BATCH_CONF, BATCH_MB = "spark.sql.execution.arrow.maxBytesPerBatch", 2


def limit_batches(spark: SparkSession) -> None:
    """Hold the bytes of an Arrow batch to ``BATCH_MB``; a lower limit stays."""
    most = BATCH_MB << 20
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_CONF)) > most:
        spark.conf.set(BATCH_CONF, str(most))


def get_spark(master: str | None = None, app: str = "aerolith",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return a session with the engine's settings applied.

    On a cluster ``master`` is left unset (spark-submit decides) and the
    shuffle partition count comes from the cluster config; tests pass
    ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    limit_broadcasts(spark)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    local master gets a folder under the system temp folder; any other master
    is an error, since its executors would not see such a folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="aerolith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


# Sub-folder of the shared folder that published stores go to. Empty: stores
# are shared by every session; the bench sets a fresh one so each run
# measures the ingest instead of reusing an earlier run's stores.
STORE_NAMESPACE = ""


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a folder of its own under the shared folder and read
    back: cuts lineage like a checkpoint, in compressed columns."""
    path = scratch_path(df.sparkSession, "staged", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if STORE_NAMESPACE:
        base = os.path.join(base, STORE_NAMESPACE)
    return os.path.join(base, *parts)


def code_version(*modules) -> str:
    """Short hash of the source of the given modules and of the shared helpers
    they use: stores published in the shared folder are keyed by it, so a
    change to the code that builds them never reuses an old store."""
    import hashlib
    import inspect

    from aerolith.functions import scalars
    from aerolith.operators import filters, windows
    h = hashlib.sha1()
    for m in (*modules, scalars, filters, windows):
        h.update(inspect.getsource(m).encode())
    return h.hexdigest()[:12]
