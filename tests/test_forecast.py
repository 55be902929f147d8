"""Forecasts against a direct numpy statement of the reference algorithm
(regular grid, linear interpolation, lstsq on [1, t, sin, cos])."""

import numpy as np
import pandas as pd

from aerolith.operators import forecast as FC
from aerolith.operators import reads
from aerolith.operators import reports as R
from aerolith.sources.driver_tables import core
from tests.conftest import SF_MID


def _numpy_hourly(s: pd.Series, horizon=72):
    s = s.sort_index().asfreq("h").interpolate(limit_direction="both")
    n = len(s)
    hours = s.index.hour.to_numpy(float)
    X = np.column_stack([np.ones(n), np.arange(n, dtype=float), np.sin(2 * np.pi * hours / 24),
                         np.cos(2 * np.pi * hours / 24)])
    c, *_ = np.linalg.lstsq(X, s.to_numpy(float), rcond=None)
    idx = pd.date_range(s.index.max() + pd.Timedelta(hours=1), periods=horizon, freq="h")
    fh = idx.hour.to_numpy(float)
    Xf = np.column_stack([np.ones(horizon), np.arange(n, n + horizon, dtype=float),
                          np.sin(2 * np.pi * fh / 24), np.cos(2 * np.pi * fh / 24)])
    return pd.Series(np.maximum(Xf @ c, 0), index=idx)


def _numpy_daily(s: pd.Series, horizon=14):
    s = s.sort_index().asfreq("D").interpolate(limit_direction="both")
    n = len(s)
    doy = s.index.dayofyear.to_numpy(float)
    X = np.column_stack([np.ones(n), np.arange(n, dtype=float), np.sin(2 * np.pi * doy / 365.25),
                         np.cos(2 * np.pi * doy / 365.25)])
    c, *_ = np.linalg.lstsq(X, s.to_numpy(float), rcond=None)
    idx = pd.date_range(s.index.min(), s.index.max() + pd.Timedelta(days=horizon), freq="D")
    d = idx.dayofyear.to_numpy(float)
    Xf = np.column_stack([np.ones(len(idx)), np.arange(len(idx), dtype=float),
                          np.sin(2 * np.pi * d / 365.25), np.cos(2 * np.pi * d / 365.25)])
    return pd.Series(np.maximum(Xf @ c, 0), index=idx)


def test_hourly_forecast_matches_numpy(spark):
    c = core(spark, SF_MID)
    hm = R.hourly_mean(reads.hourly_series(c, limit=None)).select(
        "city", "parameter_code", "measured_hour", "average_value").withColumnRenamed("average_value", "hourly_mean")
    keys = [("NATION_3", "click"), ("NATION_11", "view")]
    sub = hm.filter(" OR ".join(f"(city = '{a}' AND parameter_code = '{b}')" for a, b in keys))
    got = FC.hourly_forecast(sub, ["city", "parameter_code"]).toPandas()
    src = sub.toPandas()
    for city, code in keys:
        s = src[(src.city == city) & (src.parameter_code == code)].set_index("measured_hour")["hourly_mean"]
        want = _numpy_hourly(s)
        g = got[(got.city == city) & (got.parameter_code == code)].set_index("measured_hour")["forecast_value"]
        assert len(g) == 72
        np.testing.assert_allclose(g.sort_index().to_numpy(), want.to_numpy(), rtol=1e-6, atol=1e-6)


def test_daily_forecast_matches_numpy(spark):
    c = core(spark, SF_MID)
    d = R.daily_mean(reads.hourly_series(c, limit=None))
    got = FC.daily_forecast(d, ["parameter_code"]).toPandas()
    src = d.toPandas()
    for code in ["click", "purchase"]:
        s = src[src.parameter_code == code].set_index("day")["daily_mean"]
        s.index = pd.to_datetime(s.index)
        want = _numpy_daily(s)
        g = got[got.parameter_code == code].set_index("day")["predicted_daily_mean"].sort_index()
        assert len(g) == len(want)
        np.testing.assert_allclose(g.to_numpy(), want.to_numpy(), rtol=1e-5, atol=1e-5)


def test_short_series_get_no_forecast(spark):
    import datetime as dt
    rows = [("A", "x", dt.datetime(2024, 1, 1, h), float(h)) for h in range(5)]
    df = spark.createDataFrame(rows, "city string, parameter_code string, measured_hour timestamp_ntz, "
                                     "hourly_mean double")
    assert FC.hourly_forecast(df, ["city", "parameter_code"]).count() == 0
