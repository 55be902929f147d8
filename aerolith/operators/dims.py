"""Conformed dimensions E1-E4."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.functions import scalars as S

DATE_FROM = "2024-01-01"
DATE_TO = "2026-12-31"


def dim_date(spark: SparkSession, start: str = DATE_FROM, end: str = DATE_TO) -> DataFrame:
    """One row per day, inclusive range (1096 rows for the default range).

    ``spark.range`` generates the day offsets in parallel; no driver-side list.
    """
    n = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return spark.range(n).select(d.alias("full_date")).select(
        S.date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        S.iso_weekday("full_date").alias("weekday"),
        S.iso_weekday("full_date").isin(6, 7).alias("is_weekend"),
    )


def date_key_range(start: str = DATE_FROM, end: str = DATE_TO) -> tuple[int, int]:
    """First and last date key of dim_date (the fact date foreign key's range)."""
    return int(start.replace("-", "")), int(end.replace("-", ""))


def dim_time(spark: SparkSession) -> DataFrame:
    """1440 minutes of the day (hour x minute without a cross join)."""
    h = (F.col("id") / 60).cast("int")
    mi = (F.col("id") % 60).cast("int")
    return spark.range(1440).select(
        (h * 100 + mi).alias("time_key"), h.alias("hour"), mi.alias("minute"),
        S.part_of_day(h).alias("part_of_day"))


def dim_risk_class(spark: SparkSession) -> DataFrame:
    """The four fixed risk bands."""
    rows = [(order, code, label, lo, hi, order) for code, label, lo, hi, order in S.RISK_CLASSES]
    df = spark.createDataFrame(rows, "risk_class_key int, code string, label string, "
                                     "min_value int, max_value int, sort_order int")
    return df.select("risk_class_key", "code", "label",
                     F.col("min_value").cast("decimal(12,4)").alias("min_value"),
                     F.col("max_value").cast("decimal(12,4)").alias("max_value"), "sort_order")


def upsert_by_key(new: DataFrame, current: DataFrame, keys: list[str], update: list[str],
                  insert_only: list[str] = ()) -> DataFrame:
    """Insert-or-update by key on immutable snapshots (no MERGE on Parquet).

    Listed ``update`` columns take the new value; ``insert_only`` columns keep
    the current value when the key already exists; other current columns are
    preserved. One full outer join on the key, no per-row work on the driver.
    """
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in new.columns if c not in keys],
                   F.lit(True).alias("__in_new"))
    c = current.select(*keys, *[F.col(x).alias(f"__c_{x}") for x in current.columns if x not in keys],
                       F.lit(True).alias("__in_cur"))
    j = n.join(c, keys, "full_outer")
    cols = list(dict.fromkeys([x for x in current.columns if x not in keys] +
                              [x for x in new.columns if x not in keys]))
    out = [F.col(k) for k in keys]
    for x in cols:
        has_n = x in new.columns
        has_c = x in current.columns
        if has_n and has_c:
            if x in update:
                e = F.when(F.col("__in_new"), F.col(f"__n_{x}")).otherwise(F.col(f"__c_{x}"))
            else:  # insert-only or preserved: current wins when present
                e = F.when(F.col("__in_cur"), F.col(f"__c_{x}")).otherwise(F.col(f"__n_{x}"))
        elif has_n:
            e = F.col(f"__n_{x}")
        else:
            e = F.col(f"__c_{x}")
        out.append(e.alias(x))
    return j.select(*out)


def last_per_key(new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in ``order``, as if the rows were upserted one
    after another (ties: the greatest remaining values)."""
    rest = [c for c in new.columns if c not in keys]
    at = F.struct(*order, *[c for c in rest if c not in order])
    return new.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("__last")).select(*keys, "__last.*")


def with_new_ids(new: DataFrame, current: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Give rows whose key is not stored the ids after the current maximum, in
    key order; other rows get no id (an upsert keeps theirs). The ranking runs
    over the new keys of a small rule or vocabulary table."""
    top = current.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    fresh = new.join(current.select(*keys), keys, "left_anti").select(*keys)
    ids = fresh.select(*keys, (top + F.row_number().over(Window.orderBy(*keys)))
                       .cast(current.schema[id_col].dataType).alias(id_col))
    return new.join(ids, keys, "left")


PARAMETER_COLS = ["source_parameter_id", "display_name", "preferred_unit", "is_active"]


def dim_parameter(parameter: DataFrame) -> DataFrame:
    """Source parameter rows in dimension shape, without the dimension's key.
    A source that does not say so has active parameters only."""
    active = F.col("is_active") if "is_active" in parameter.columns else F.lit(True)
    return parameter.select("code", F.col("parameter_id").alias("source_parameter_id"), "display_name", "preferred_unit",
                            active.alias("is_active"))


def empty_parameter_dim(parameter: DataFrame) -> DataFrame:
    return dim_parameter(parameter).select("code", F.lit(0).alias("parameter_key"), *PARAMETER_COLS).limit(0)


def dim_parameter_upsert(parameter: DataFrame, current_dim: DataFrame) -> DataFrame:
    """SCD1 upsert by code: the key of a stored code is kept, new codes get
    the keys after the greatest one, in code order."""
    new = with_new_ids(dim_parameter(parameter), current_dim, ["code"], "parameter_key")
    return upsert_by_key(new, current_dim, ["code"], update=PARAMETER_COLS)


def backfill_from_parent(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str],
                         column: str, parent_column: str) -> DataFrame:
    """Fill ``column`` of child rows where it is NULL from the parent row
    with the same key (UPDATE ... FROM). Only the rows that need the value
    take part in the join; the rest pass through untouched."""
    need = child.filter(F.col(column).isNull())
    done = child.filter(F.col(column).isNotNull())
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_key, child_key)],
                      F.col(parent_column).alias("__fill"))
    filled = need.join(p, child_key, "left").withColumn(column, F.coalesce(F.col(column), F.col("__fill"))) \
        .drop("__fill").select(*child.columns)
    return done.unionByName(filled)
