"""Ordinary least squares over one-hot keys and numeric columns (M4) where they
are more than Spark ML solves by normal equations.

Spark ML then minimises the squared error by L-BFGS (Breeze's: ten steps of
history, a strong Wolfe line search), and every step passes over all rows with
a dense gradient of every column in each task. The error is a quadratic form:
rows count, and sums of the label and of the numeric columns, by each pair of
keys that occurs give its value and gradient. These are taken from the rows
once; the same steps are then made from them. The driver holds a few vectors as
long as the model's coefficients, as Spark ML's optimiser does, and the sums of
a pair.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.session import staged

NORMAL_MAX = 4096  # columns up to which Spark ML solves normal equations
HISTORY, FUNCTION_MEMORY = 10, 20
C1, C2, ZOOMS, SEARCHES = 1e-4, 0.9, 10, 10


class SearchFailed(Exception):
    pass


def _line_search(phi, t: float) -> float:
    """Breeze's StrongWolfeLineSearch from step ``t``; ``phi(t)`` is (t, slope, value)."""
    def interp(lo, hi):
        d1 = lo[1] + hi[1] - 3 * (lo[2] - hi[2]) / (lo[0] - hi[0])
        d2 = math.sqrt(d1 * d1 - lo[1] * hi[1]) if d1 * d1 >= lo[1] * hi[1] else math.nan
        span = hi[0] - lo[0]
        t = hi[0] - span * (hi[1] + d2 - d1) / (hi[1] - lo[1] + 2 * d2)
        return max(min(t, lo[0] + 0.9 * span), lo[0] + 0.1 * span) if t == t else t

    def zoom(lo, hi):
        for _ in range(ZOOMS):
            c = phi(interp(hi, lo) if lo[0] > hi[0] else interp(lo, hi))
            if c[2] > start[2] + C1 * c[0] * start[1] or c[2] >= lo[2]:
                hi = c
            else:
                if abs(c[1]) <= C2 * abs(start[1]):
                    return c[0]
                if c[1] * (hi[0] - lo[0]) >= 0:
                    hi = lo
                lo = c
        raise SearchFailed("zoom")
    start = low = phi(0.0)
    if start[1] > 0:
        raise SearchFailed("no descent")
    for i in range(SEARCHES):
        c = phi(t)
        if not math.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > start[2] + C1 * t * start[1] or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= C2 * abs(start[1]):
            return c[0]
        if c[1] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise SearchFailed("search")


def minimise(fun, x: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """Breeze's LBFGS: the last point and the value of each. ``fun`` gives value and gradient."""
    value, grad = fun(x)
    first, values, steps, failed = value, [value], [], False
    while True:
        recent = ([math.inf] + values[1:])[-FUNCTION_MEMORY:]
        if len(values) - 1 >= max_iter or (len(values) > 1 and abs(value - max(recent)) <= tol * abs(first)) \
                or np.linalg.norm(grad) <= max(tol * value, 1e-8):
            return x, values
        try:
            way, kept = grad.copy(), []
            for s, y, rho in steps:
                kept.append(s @ way / rho)
                way -= kept[-1] * y
            if steps:
                s, y, rho = steps[0]
                if not rho >= 0 or any(k != k for k in kept):
                    raise SearchFailed("history")
                way *= rho / (y @ y)
            for (s, y, rho), k in zip(reversed(steps), reversed(kept)):
                way += (k - y @ way / rho) * s
            way = -way
            seen = {}

            def phi(t):
                seen[t] = (value, grad) if t == 0 else fun(x + t * way)
                return t, seen[t][1] @ way, seen[t][0]
            t = _line_search(phi, 1.0 if len(values) > 1 else 1 / float(np.linalg.norm(way)))
            if t * np.linalg.norm(grad) < 1e-10:
                raise SearchFailed("underflow")
        except SearchFailed:
            if failed:
                return x, values
            failed, steps = True, []
            continue
        failed = False
        value_, grad_ = seen[t]
        step, delta = t * way, grad_ - grad
        steps = [(step, delta, step @ delta), *steps][:HISTORY]
        x, value, grad = x + step, value_, grad_
        values.append(value)


class Squares:
    """Half the mean squared error in standardised columns, from sums by pair of keys."""

    def __init__(self, slots: np.ndarray, sizes: list[int], n: np.ndarray, sx: np.ndarray, sy: np.ndarray, xx: np.ndarray,
                 xy: np.ndarray, yy: float, y_mean: float):
        """``slots``: a column of slot numbers a key; ``sx``, ``sy``: sums by pair of the
        numeric columns and of the label less ``y_mean``; ``xx``, ``xy``, ``yy``: sums of products."""
        self.rows, self.n, self.slots, self.sizes = int(n.sum()), n, slots, sizes
        rows = float(self.rows)
        dev = lambda squares, sums: np.sqrt(np.maximum(squares - sums * sums / rows, 0) / (rows - 1))
        count = np.concatenate([np.bincount(s, n, size) for s, size in zip(slots, sizes)])
        x_mean = sx.sum(0) / rows
        self.mean = np.r_[count / rows, x_mean]
        self.std = np.r_[dev(count, count), dev(np.diag(xx), sx.sum(0))]
        self.y_mean, self.y_std = y_mean + sy.sum() / rows, float(dev(yy, sy.sum()))
        self.inverse = np.divide(1.0, self.std, out=np.zeros_like(self.std), where=self.std > 0)
        scale = 1 / self.y_std if self.y_std else 0.0
        off = sy.sum() / rows
        self.sx, self.sy = sx - np.outer(n, x_mean), (sy - n * off) * scale
        self.xx = xx - rows * np.outer(x_mean, x_mean)
        self.xy = (xy - rows * x_mean * off) * scale
        self.yy = (yy - rows * off * off) * scale * scale

    def __call__(self, beta: np.ndarray) -> tuple[float, np.ndarray]:
        b, k = beta * self.inverse, sum(self.sizes)
        begin = np.r_[0, np.cumsum(self.sizes)]
        at = np.full(len(self.n), -float(b[:k] @ self.mean[:k]))
        for i, s in enumerate(self.slots):
            at += b[begin[i]:begin[i + 1]][s]
        rest = self.sx @ b[k:] - self.sy
        error = self.n * at + rest
        value = at @ (error + rest) + b[k:] @ (self.xx @ b[k:]) - 2 * b[k:] @ self.xy + self.yy
        grad = np.concatenate([*(np.bincount(s, error, size) for s, size in zip(self.slots, self.sizes)),
                               self.sx.T @ at + self.xx @ b[k:] - self.xy])
        grad[:k] -= self.mean[:k] * error.sum()
        return float(value) / (2 * self.rows), grad * self.inverse / self.rows

    def solve(self, max_iter: int, tol: float) -> tuple[np.ndarray, float, list[float]]:
        """Coefficients of the columns as they are, intercept, and the values of the steps."""
        beta, values = minimise(self, np.zeros(len(self.mean)), max_iter, tol)
        coefficients = beta * self.inverse * self.y_std
        return coefficients, self.y_mean - float(coefficients @ self.mean), values


def sums(df: DataFrame, numeric: str, keys: list[str], label: str, sizes: list[int]) -> Squares:
    """``df`` has the vector ``numeric`` and the slot numbers ``keys``."""
    rows = staged(df.select(*[F.col(k).cast("int").alias(f"k{i}") for i, k in enumerate(keys)],
                            vector_to_array(numeric).alias("x"), F.col(label).cast("double").alias("y")), "linear-train")
    n, y_mean, width = rows.agg(F.count("y"), F.avg("y"), F.max(F.size("x"))).first()
    x, y = [F.col("x")[i] for i in range(width)], F.col("y") - F.lit(y_mean)
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    whole = rows.agg(F.count(F.lit(1)), F.sum(y * y), *[F.sum(c * y) for c in x], *[F.sum(x[i] * x[j]) for i, j in pairs]).first()
    if whole[0] != n or not all(v is not None and math.isfinite(v) for v in whole):
        raise ValueError("labels and numeric columns of the training rows must be finite numbers")
    xx = np.zeros((width, width))
    for (i, j), v in zip(pairs, whole[2 + width:]):
        xx[i, j] = xx[j, i] = v
    by = (rows.groupBy(*[f"k{i}" for i in range(len(keys))])
          .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), *[F.sum(c).alias(f"x{i}") for i, c in enumerate(x)]).toPandas())
    return Squares(by[[f"k{i}" for i in range(len(keys))]].to_numpy().T, sizes, by["n"].to_numpy(float),
                   by[[f"x{i}" for i in range(width)]].to_numpy(float), by["y"].to_numpy(float), xx,
                   np.array(whole[2:2 + width]), float(whole[1]), float(y_mean))


def fit(train: DataFrame, prep: PipelineModel, sizes: list[int], numeric: str, keys: list[str],
        regression: LinearRegression) -> PipelineModel:
    """``prep`` with the fitted ``regression``; ``sizes``: columns of each one-hot key."""
    df = prep.transform(train)
    if sum(sizes) <= NORMAL_MAX - len(df.first()[numeric]):
        return PipelineModel([*prep.stages, regression.fit(df)])
    s = sums(df, numeric, keys, regression.getLabelCol(), sizes)
    if not s.y_std:  # Spark ML's answer to a constant label
        return PipelineModel([*prep.stages, regression.fit(df)])
    coefficients, intercept, _ = s.solve(regression.getMaxIter(), regression.getTol())
    sc = train.sparkSession.sparkContext
    made = LinearRegressionModel(sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        regression.uid, _py2java(sc, Vectors.dense(coefficients)), intercept))
    for p in (made.labelCol, made.featuresCol, made.predictionCol):
        made._set(**{p.name: regression.getOrDefault(p.name)})
    made._transfer_params_to_java()
    return PipelineModel([*prep.stages, made])
