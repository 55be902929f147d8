"""Small helpers over the shared folder, through Spark's own readers/writers
so they work on any file system the cluster mounts (HDFS, object stores)."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Held while a shared store is checked and, if missing, built and published,
# so concurrent callers in one driver never build the same store twice.
PUBLISH_LOCK = threading.RLock()


def exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018 - resolves the path
        return True
    except AnalysisException:
        return False


def input_version(spark: SparkSession, paths: list[str]) -> str:
    """Fingerprint of the files under ``paths`` (path, size, time of change):
    replaced or added files give another one. Lists files, reads no contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    n, mix = files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return f"{n}-{(mix or 0) & (2**64 - 1):016x}"


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Publish a marker (written last, so readers never see half a run)."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The published value, or None when absent or being rewritten by another
    process (the caller then builds its own run folder: wasteful, never wrong)."""
    try:
        row = spark.read.text(path).first()
    except Exception:  # noqa: BLE001 - missing, or replaced while listing
        return None
    return None if row is None or not row[0] else row[0]


def publish_once(spark: SparkSession, root: str, build, fmt: str = "parquet") -> str:
    """Build a table into ``root/run-<id>`` unless a published one exists;
    the marker naming the run folder is written last. Returns the folder."""
    import os
    import uuid
    marker = os.path.join(root, "_published")
    with PUBLISH_LOCK:
        path = read_marker(spark, marker)
        if path is None:
            path = os.path.join(root, f"run-{uuid.uuid4().hex[:12]}")
            build().write.mode("overwrite").format(fmt).save(path)
            write_marker(spark, marker, path)
    return path
