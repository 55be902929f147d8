"""Row windows over per-series sequences that stay bounded when one series is hot.

A plain ``Window.partitionBy(series)`` puts a whole series into one task; if
one sensor holds a third of all readings, that task does a third of the job.
Here a series is cut into chunks of about ``TARGET_ROWS`` rows each, by
position: rows are counted per (series, hour) and an hour belongs to the chunk
its first row's position falls in, so bursts are cut as finely as steady
series (a calendar bucket can be passed instead). Rows meet their chunk by
(series, hour), never by the series alone. Window functions run per
(series, chunk); the rows they need from neighbouring chunks (the last
``before`` rows of earlier chunks, the first ``after`` rows of later ones) are
copied in as *halo* rows and dropped afterwards. Chunks are numbered by a
ranking over chunk summaries (one row per series and chunk), so no step ever
holds a whole series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


TARGET_ROWS = 1_000_000
_COPIES = "array<struct<t:int,h:boolean>>"


def with_chunks(df: DataFrame, key: list[str], ts: str, chunk=None, target_rows: int | None = None) -> DataFrame:
    """Add ``__chunk``. Given a column, use it; otherwise chunks of about
    ``target_rows`` rows: an hour of a series goes to the chunk that holds the
    number of rows before it, so a chunk exceeds the target by less than one
    hour of the series."""
    if chunk is not None:
        return df.withColumn("__chunk", chunk)
    target_rows = target_rows or TARGET_ROWS
    b = with_rows_before(df, key, ts)
    return b.withColumn("__chunk", F.floor(F.col("__before") / F.lit(target_rows))).drop("__before", "__hour")


def with_rows_before(df: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Add ``__hour`` and ``__before``, the rows of the series in earlier hours.
    The running total is over one row per (series, hour)."""
    b = df.withColumn("__hour", F.date_trunc("hour", F.col(ts)))
    per_hour = b.groupBy(*key, "__hour").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*key).orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    before = per_hour.select(*key, "__hour", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return b.join(before, [*key, "__hour"])


def _ranked(df: DataFrame, key: list[str], chunk, ts: str) -> DataFrame:
    b = with_chunks(df, key, ts, chunk)
    summ = b.groupBy(*key, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    summ = summ.withColumn("__crank", F.row_number().over(Window.partitionBy(*key).orderBy("__chunk")))
    return b.join(summ.select(*key, "__chunk", "__crank"), [*key, "__chunk"])


def sequence_window(df: DataFrame, key: list[str], order: list[str], before: int, after: int,
                    compute: Callable[[DataFrame, WindowSpec], DataFrame], chunk=None) -> DataFrame:
    """Apply ``compute(frame, w)`` where ``w`` orders each series by ``order``
    and may look ``before`` rows back and ``after`` rows ahead.

    One pass: every row is emitted for its own chunk, and the last ``before``
    rows of a chunk (first ``after`` rows) are also emitted as halo rows for
    the next ``before`` (previous ``after``) chunks, all by one ``explode``.
    A chunk may receive more halo rows than needed; they sit further away in
    the order than the window reaches, so they change nothing.
    ``order`` must be unique within a series (add a tie-break column).
    """
    b = _ranked(df, key, chunk, order[0])
    cols = df.columns
    in_chunk = Window.partitionBy(*key, "__chunk")
    b = b.withColumn("__rd", F.row_number().over(in_chunk.orderBy(*[F.desc(c) for c in order]))) \
        .withColumn("__ra", F.row_number().over(in_chunk.orderBy(*order)))
    target = lambda t, halo: F.struct(t.alias("t"), F.lit(halo).alias("h"))
    copies = F.array(target(F.col("__crank"), False))
    if before > 0:
        fwd = F.transform(F.sequence(F.lit(1), F.lit(before)), lambda k: target(F.col("__crank") + k, True))
        copies = F.concat(copies, F.when(F.col("__rd") <= before, fwd).otherwise(F.array().cast(_COPIES)))
    if after > 0:
        back = F.transform(F.sequence(F.lit(1), F.lit(after)), lambda k: target(F.col("__crank") - k, True))
        copies = F.concat(copies, F.when(F.col("__ra") <= after, back).otherwise(F.array().cast(_COPIES)))
    ctx = b.select(*cols, F.explode(copies).alias("__c")) \
        .select(*cols, F.col("__c.t").alias("__target"), F.col("__c.h").alias("__halo"))
    w = Window.partitionBy(*key, "__target").orderBy(*order)
    out = compute(ctx, w)
    return out.filter(~F.col("__halo")).drop("__target", "__halo")


def top_k_per_key(df: DataFrame, key: list[str], order_desc: list[str], k: int) -> DataFrame:
    """The k last rows per series (by ``order_desc`` descending). Adds
    ``rank_desc`` 1..k. Spark pushes the rank limit below the shuffle, so at
    most k rows per series and task travel."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order_desc])
    return df.withColumn("rank_desc", F.row_number().over(w)).filter(F.col("rank_desc") <= k)
