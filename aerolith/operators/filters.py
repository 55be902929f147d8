"""Optional filters (P1-P3, P6) and ordered limits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def optional_eq(df: DataFrame, column: str, value) -> DataFrame:
    """``value IS NULL OR column = value``, folded on the driver: no
    predicate at all when the value is unset, so Catalyst has nothing to keep."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def _ts(v):
    if isinstance(v, str):
        v = dt.datetime.fromisoformat(v.replace("Z", "+00:00"))
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def time_bounds(df: DataFrame, column: str, date_from=None, date_to=None,
                month_column: str | None = None) -> DataFrame:
    """Inclusive bounds. When the table is month partitioned, the same
    bounds are also stated on the partition column, because Spark does not
    derive a partition predicate from a predicate on the time column."""
    date_from, date_to = _ts(date_from), _ts(date_to)
    if date_from is not None:
        df = df.filter(F.col(column) >= F.lit(date_from).cast("timestamp_ntz"))
        if month_column:
            df = df.filter(F.col(month_column) >= F.trunc(F.lit(date_from).cast("date"), "MM"))
    if date_to is not None:
        df = df.filter(F.col(column) <= F.lit(date_to).cast("timestamp_ntz"))
        if month_column:
            df = df.filter(F.col(month_column) <= F.trunc(F.lit(date_to).cast("date"), "MM"))
    return df


def day_range(df: DataFrame, column: str, start=None, end=None, month_column: str | None = None) -> DataFrame:
    """Dashboard day range, half open ``[start, end + 1 day)``; rows with
    an unparsable (NULL) time drop out. ``month_column``: see ``time_bounds``."""
    if month_column:
        for day, op in ((start, "__ge__"), (end, "__le__")):
            if day is not None:
                df = df.filter(getattr(F.col(month_column), op)(F.trunc(F.lit(day).cast("date"), "MM")))
    df = df.filter(F.col(column).isNotNull())
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date").cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(column) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return df


def all_option(df: DataFrame, column: str, value, all_label: str = "All") -> DataFrame:
    """A dashboard select where 'All' (or nothing) means no filter."""
    if value is None or value == all_label:
        return df
    return df.filter(F.col(column) == F.lit(value))


def top_n(df: DataFrame, order: list, limit: int | None, lo: int = 1, hi: int | None = None) -> DataFrame:
    """``ORDER BY ... LIMIT n`` (TakeOrderedAndProject: each partition keeps
    its own top n, only n rows per partition reach the final merge)."""
    if limit is None:
        return df.orderBy(*order)
    if limit < lo or (hi is not None and limit > hi):
        raise ValueError(f"limit must be within [{lo}, {hi}]")
    return df.orderBy(*order).limit(limit)


def edge_months(df: DataFrame, *ends, month: str = "measured_month") -> DataFrame:
    """Rows of the first (``F.min``) and last (``F.max``) month that there is,
    which hold the least and greatest time. The months come from the partition
    values, so no other partition's columns are read."""
    keep = None
    for end in ends:
        one = F.col(month) == df.agg(end(month)).scalar()
        keep = one if keep is None else keep | one
    return df.filter(keep)
