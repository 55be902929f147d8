"""Slowly changing dimensions, type 2 (E5, E6) and the as-of lookup.

The dimension is an immutable snapshot: each sync reads the current snapshot
and the source and returns the next snapshot (expired rows closed, new
versions appended). Both steps share one ``as_of`` so intervals are half open
and contiguous: old ``valid_to`` == new ``valid_from``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import scalars as S

LOCATION_TRACKED = ["openaq_location_id", "name", "city", "country", "latitude", "longitude"]
SENSOR_TRACKED = ["openaq_sensor_id", "location_id", "parameter_id", "unit"]


def _ts(v):
    if isinstance(v, str):
        v = dt.datetime.fromisoformat(v)
    return F.lit(v).cast("timestamp_ntz")


def empty_dim(spark: SparkSession, source: DataFrame, key: str, dim_key: str, attrs: list[str]) -> DataFrame:
    fields = [T.StructField(dim_key, source.schema[key].dataType)]
    fields += [T.StructField(a, source.schema[a].dataType) for a in attrs]
    fields += [T.StructField("valid_from", T.TimestampNTZType()), T.StructField("valid_to", T.TimestampNTZType()),
               T.StructField("is_current", T.BooleanType()), T.StructField("row_hash", T.StringType())]
    return spark.createDataFrame([], T.StructType(fields))


def scd2_sync(source: DataFrame, dim: DataFrame, key: str, dim_key: str, tracked: list[str],
              attrs: list[str], as_of, first_seen: str | None = "first_seen_at",
              active: str | None = "is_active", close_inactive: bool = False,
              null_marker: str | None = None) -> DataFrame:
    """One SCD2 step. ``source``: operational rows; ``dim``: current snapshot.

    1. current versions whose tracked-column hash differs from the (active)
       source row are closed at ``as_of``;
    2. every active source row without a current version after step 1 gets a
       new current version; ``valid_from`` is the source's first-seen time when
       the key was never in the dimension, else ``as_of``.

    Sources that went inactive stay current (the reference behaviour);
    ``close_inactive`` closes their current version instead. ``null_marker``
    hashes NULLs as that text, so (NULL, x) and (x, NULL) no longer collide.
    Both joins are on the business key, so they hash-partition the same way
    and the planner reuses the exchange of the dimension side.
    """
    as_of = _ts(as_of)
    src = source
    inactive_keys = None
    if active:
        if close_inactive:
            inactive_keys = src.filter(~F.col(active)).select(F.col(key).alias(dim_key),
                                                             F.lit(True).alias("__gone"))
        src = src.filter(F.col(active))
    hashed = tracked if null_marker is None else [F.coalesce(F.col(c).cast("string"), F.lit(null_marker))
                                                  for c in tracked]
    src = src.select(F.col(key).alias(dim_key), *attrs,
                     (F.col(first_seen) if first_seen else F.lit(None).cast("timestamp_ntz")).alias("__first"),
                     S.row_hash(*hashed).alias("__hash"))

    # step 1: close changed current versions
    d = dim.join(src.select(dim_key, F.col("__hash").alias("__src_hash")), dim_key, "left")
    changed = F.col("is_current") & F.col("__src_hash").isNotNull() & (F.col("__src_hash") != F.col("row_hash"))
    if inactive_keys is not None:
        d = d.join(inactive_keys, dim_key, "left")
        changed = changed | (F.col("is_current") & F.col("__gone").isNotNull())
    closed = d.select(dim_key, *attrs, "valid_from",
                      F.when(changed, as_of).otherwise(F.col("valid_to")).alias("valid_to"),
                      F.when(changed, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
                      "row_hash")

    # step 2: new versions for sources with no (unchanged) current version
    summary = dim.groupBy(dim_key).agg(
        F.max(F.when(F.col("is_current"), F.col("row_hash"))).alias("__cur_hash"),
        F.lit(True).alias("__seen"))
    s = src.join(summary, dim_key, "left")
    s = s.filter(F.col("__cur_hash").isNull() | (F.col("__cur_hash") != F.col("__hash")))
    inserted = s.select(dim_key, *attrs,
                        F.when(F.col("__seen").isNull(), F.coalesce(F.col("__first"), as_of))
                        .otherwise(as_of).alias("valid_from"),
                        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                        F.lit(True).alias("is_current"),
                        F.col("__hash").alias("row_hash"))
    return closed.unionByName(inserted)


def changed_keys(source: DataFrame, dim: DataFrame, key: str, dim_key: str, tracked: list[str]) -> DataFrame:
    """Business keys (as ``dim_key``) that a sync would write versions for:
    active sources without a current version of the same hash."""
    src = source.filter("is_active").select(F.col(key).alias(dim_key), S.row_hash(*tracked).alias("__hash"))
    cur = current(dim).select(F.col(dim_key), F.col("row_hash").alias("__hash"))
    return src.join(cur, [dim_key, "__hash"], "left_anti").select(dim_key)


def with_surrogate(dim: DataFrame, dim_key: str, surrogate: str) -> DataFrame:
    """Deterministic surrogate key: xxhash64(business key, valid_from)."""
    return dim.withColumn(surrogate, F.xxhash64(F.col(dim_key), F.col("valid_from")))


def location_source(location: DataFrame) -> DataFrame:
    return location.select("location_id", *LOCATION_TRACKED, "first_seen_at", "is_active")


def sync_locations(location: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    """E5."""
    return scd2_sync(location_source(location), dim, "location_id", "source_location_id",
                     LOCATION_TRACKED, LOCATION_TRACKED, as_of)


def sync_sensors(sensor: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    """E6."""
    src = sensor.select("sensor_id", *SENSOR_TRACKED, "first_seen_at", "is_active")
    return scd2_sync(src, dim, "sensor_id", "source_sensor_id", SENSOR_TRACKED, SENSOR_TRACKED, as_of)


def empty_location_dim(spark, location):
    return empty_dim(spark, location, "location_id", "source_location_id", LOCATION_TRACKED)


def empty_sensor_dim(spark, sensor):
    return empty_dim(spark, sensor, "sensor_id", "source_sensor_id", SENSOR_TRACKED)


def current(dim: DataFrame) -> DataFrame:
    """Current versions only."""
    return dim.filter(F.col("is_current"))


def as_of_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, ts: str) -> DataFrame:
    """The dimension version valid at the fact's event time.

    Equi join on the business key plus ``valid_from <= ts < coalesce(valid_to, inf)``;
    the equi part hash-partitions (or broadcasts by size), the interval is a
    residual on the few versions per key. Skewed keys are split by AQE.
    """
    cond = (facts[fact_key] == dim[dim_key]) & (facts[ts] >= dim["valid_from"]) & \
        (dim["valid_to"].isNull() | (facts[ts] < dim["valid_to"]))
    return facts.join(dim, cond, "inner")
