"""Regular grid with linear interpolation (W11) and the dashboard forecasts
(M9 hourly, M10 daily): least squares on [1, t, sin, cos] per series.

* The grid is generated per series with ``sequence`` + ``explode`` between
  its first and last point, so its size is bounded by the time span, not by
  the number of readings; interpolation uses last/first-non-null windows.
* The fit is the normal equations: the 10 + 4 sums of x_i*x_j and x_i*y are
  one Spark aggregate per series, and the 4x4 system is solved by symmetric
  elimination in column expressions (no Python). Grid positions come from
  ``posexplode``, so the sums need no window.
* Basis. 1, t, sin, cos of a period far longer than the series are nearly
  dependent (thirty days of a year: condition number 4e8). The fit is the same
  in any basis of the same space, so it is made in 1, u, 1 - cos(a) and
  sin(a) - s*u: u is t from the middle of the series, a the phase from the
  phase there, and s the angle of one step where the series is shorter than a
  period, else 0. These behave like 1, u, u^2, u^3 on a short series and like
  the plain basis on a long one, and the sums keep their digits.
* Near-singular series: a column of which less than ``RANK_SHARE`` of its square
  sum is left beside the columns before it has the coefficient 0. A series of
  as many consecutive points as ``min_points`` asks for has full rank.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TWO_PI = 2 * math.pi
#: share of a column's square sum below which it counts as dependent on the others
RANK_SHARE = 1e-10
SIZE = 4


def regular_grid(series: DataFrame, keys: list[str], ts: str, value: str, step: str,
                 with_position: bool = False, min_points: int = 1) -> DataFrame:
    """Grid rows from first to last point of each series, step ``step``
    (e.g. '1 hour', '1 day'); missing values linearly interpolated (equal
    spacing, so position and time interpolation agree). Adds ``is_observed``;
    ``with_position`` also keeps each point's position, the grid length and its
    first time (straight from ``posexplode``/``size``, no ranking window)."""
    s = series.select(*keys, ts, value).where(F.col(value).isNotNull())
    b = s.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"), F.count(F.lit(1)).alias("__obs"))
    b = b.filter(F.col("__obs") >= min_points)  # short series: no grid (and no forecast)
    seq = F.sequence("__lo", "__hi", F.expr(f"INTERVAL {step}"))
    grid = b.select(*keys, F.size(seq).alias("grid_n"), F.col("__lo").alias("grid_lo"), F.posexplode(seq).alias("grid_pos", ts))
    g = grid.join(s, [*keys, ts], "left")
    # Both neighbours are running frames (start of partition to current row),
    # which Spark evaluates incrementally; "next known" is the running last
    # value in descending time order (a frame reaching to the partition end
    # would be re-aggregated for every row).
    back = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, 0)
    secs = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    known_t = F.when(F.col(value).isNotNull(), secs)
    pv, pt = F.last(value, True).over(back), F.last(known_t, True).over(back)
    nv, nt = F.last(value, True).over(ahead), F.last(known_t, True).over(ahead)
    interp = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
        F.when(nt == pt, pv).otherwise(pv + (nv - pv) * (secs - pt) / (nt - pt)))
    extra = ["grid_pos", "grid_n", "grid_lo"] if with_position else []
    return g.select(*keys, ts, interp.alias(value), F.col(value).isNotNull().alias("is_observed"), *extra)


def _basis(t: Column, n: Column, phase: Column, first_phase: Column, period: float) -> list[Column]:
    """The four columns of the fit at grid position ``t`` of a series of ``n``
    points whose first phase is ``first_phase``."""
    step = F.lit(TWO_PI / period)
    middle = (n - 1) / 2
    u, angle = t - middle, step * (phase - first_phase - middle)
    half = F.sin(angle / 2)
    return [F.lit(1.0), u, 2 * half * half, F.sin(angle) - F.when(n * step < TWO_PI, step * u).otherwise(F.lit(0.0))]


def _design_sums(grid: DataFrame, keys: list[str], ts: str, value: str, period: float, phase) -> DataFrame:
    """Per series: n, first_at, last_at and the normal-equation sums a_ij, b_i."""
    x = _basis(F.col("grid_pos").cast("double"), F.col("grid_n").cast("double"), phase(F.col(ts)), phase(F.col("grid_lo")), period)
    g = grid.select(*keys, ts, F.col(value).alias("__y"), *[c.alias(f"__x{i}") for i, c in enumerate(x)])
    x = [F.col(f"__x{i}") for i in range(SIZE)]
    return g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"),
        *[F.sum(x[i] * x[j]).alias(f"a{i}{j}") for i in range(SIZE) for j in range(i, SIZE)],
        *[F.sum(x[i] * F.col("__y")).alias(f"b{i}") for i in range(SIZE)])


def solve(sums: DataFrame) -> DataFrame:
    """c0..c3 of the symmetric systems a_ij (upper triangle), b_i, one a row.

    Elimination down the diagonal, a projection per pivot: a row whose pivot
    has fallen below ``RANK_SHARE`` of its diagonal is left out (its
    coefficient is 0), then substitution upwards."""
    keep = [c for c in sums.columns if not (c[0] in "ab" and c[1:].isdigit())]
    a = lambda i, j: F.col(f"a{min(i, j)}{max(i, j)}")
    df = sums.withColumns({f"d{i}": a(i, i) for i in range(SIZE)})
    for k in range(SIZE):
        df = df.withColumn(f"r{k}", a(k, k) > RANK_SHARE * F.col(f"d{k}"))
        share = {i: F.when(F.col(f"r{k}"), a(k, i) / a(k, k)).otherwise(F.lit(0.0)) for i in range(k + 1, SIZE)}
        df = df.withColumns({**{f"a{i}{j}": a(i, j) - share[i] * a(k, j) for i in range(k + 1, SIZE) for j in range(i, SIZE)},
                             **{f"b{i}": F.col(f"b{i}") - share[i] * F.col(f"b{k}") for i in range(k + 1, SIZE)}})
    for k in reversed(range(SIZE)):
        rest = F.col(f"b{k}")
        for j in range(k + 1, SIZE):
            rest = rest - a(k, j) * F.col(f"c{j}")
        df = df.withColumn(f"c{k}", F.when(F.col(f"r{k}"), rest / a(k, k)).otherwise(F.lit(0.0)))
    return df.select(*keep, *[f"c{i}" for i in range(SIZE)])


def fit(grid: DataFrame, keys: list[str], ts: str, value: str, period: float, phase) -> DataFrame:
    return solve(_design_sums(grid, keys, ts, value, period, phase))


def _curve(points: DataFrame, keys: list[str], ts: str, name: str, period: float, phase) -> DataFrame:
    """The fitted value, at least 0, at each row's ``__t`` and ``ts``."""
    x = _basis(F.col("__t").cast("double"), F.col("n").cast("double"), phase(F.col(ts)), phase(F.col("first_at")), period)
    y = F.col("c0")
    for i in range(1, SIZE):
        y = y + F.col(f"c{i}") * x[i]
    return points.select(*keys, ts, F.greatest(y, F.lit(0.0)).alias(name))


def hourly_forecast(hourly: DataFrame, keys: list[str], horizon_hours: int = 72, min_points: int = 6,
                    ts: str = "measured_hour", value: str = "hourly_mean") -> DataFrame:
    """M9: per series fit on the hourly grid; forecast the next ``horizon_hours``
    hours after the last point; hour-of-day seasonality; clipped at 0;
    series with fewer than ``min_points`` observed hours get no forecast."""
    phase = lambda c: F.hour(c).cast("double")
    grid = regular_grid(hourly, keys, ts, value, "1 hour", with_position=True, min_points=min_points)
    ahead = fit(grid, keys, ts, value, 24.0, phase).withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(horizon_hours))))
    points = ahead.withColumns({ts: F.timestamp_add("HOUR", F.col("__k"), F.col("last_at")), "__t": F.col("n") - 1 + F.col("__k")})
    return _curve(points, keys, ts, "forecast_value", 24.0, phase)


def daily_forecast(daily: DataFrame, keys: list[str], horizon_days: int = 14, min_points: int = 4,
                   ts: str = "day", value: str = "daily_mean") -> DataFrame:
    """Per series fit on the daily grid with day-of-year seasonality
    (period 365.25 d); values over the whole history plus ``horizon_days``
    days; clipped at 0; fewer than ``min_points`` days -> no forecast."""
    phase = lambda c: F.dayofyear(c).cast("double")
    grid = regular_grid(daily, keys, ts, value, "1 day", with_position=True, min_points=min_points)
    every = F.sequence(F.lit(0), (F.col("n") - 1 + horizon_days).cast("int"))
    points = fit(grid, keys, ts, value, 365.25, phase).withColumn("__t", F.explode(every))
    points = points.withColumn(ts, F.date_add("first_at", F.col("__t")))
    return _curve(points, keys, ts, "predicted_daily_mean", 365.25, phase)
