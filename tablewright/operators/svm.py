"""Support vector parts Spark ML does not have: random features for the RBF kernel, and the
epsilon-insensitive regressor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.vectors import matrix

EPSILON = 0.1  # fixed value: width of the regressor's tube
SMOOTHING = (0.1, 0.01, 0.001)  # the loss is quadratic over these shares of the target's deviation, in turn
MEMORY = 10  # past steps the optimiser keeps
NORMAL_COLUMNS = 4096  # the most columns Spark ML solves exactly


@dataclass(frozen=True)
class RandomFeatures:
    """cos(Wx + b) with W drawn for an RBF kernel (Rahimi and Recht, 2007): a linear model on these columns
    approximates the kernel model on the original ones."""

    gamma: float
    inputs: int
    outputs: int = 200
    seed: int = 42

    def transform(self, df: DataFrame, column: str = "features") -> DataFrame:
        rng = np.random.default_rng(self.seed)
        w = rng.normal(0.0, np.sqrt(2 * self.gamma), (self.inputs, self.outputs))
        b = rng.uniform(0.0, 2 * np.pi, self.outputs)
        size = np.sqrt(2.0 / self.outputs)

        def each(x: pa.Array) -> pa.Array:
            out = size * np.cos(matrix(x, np.arange(self.inputs)) @ w + b)
            return pa.ListArray.from_arrays(np.arange(0, out.size + 1, self.outputs, dtype=np.int32), out.ravel())

        project = F.arrow_udf(each, "array<double>")
        return df.withColumn(column, array_to_vector(project(vector_to_array(column))))


def scale_gamma(df: DataFrame, column: str = "features") -> tuple[float, int]:
    """1 / (columns * variance over all entries), and the number of columns: one pass."""
    s = df.agg(Summarizer.metrics("mean", "normL2", "count").summary(F.col(column)).alias("s")).first().s
    mean, squares = s.mean.toArray(), s.normL2.toArray() ** 2 / s["count"]
    var = squares.mean() - mean.mean() ** 2
    return (1.0 / (len(mean) * var) if var > 0 else 1.0), len(mean)


def fit_svr(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    C: float = 1.0,
    epsilon: float = EPSILON,
    max_iter: int = 100,
    tol: float = 1e-6,
) -> LinearRegressionModel:
    """Minimises |w|^2/2 + C * sum(max(0, |y - wx - b| - epsilon)) by L-BFGS on ever less smoothed losses. Each step
    is one pass in which every task reduces its rows to one (loss, gradient) row. Inside, columns are standardised
    (the penalty stays that of the original ones); the returned coefficients are for the original columns."""
    base = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).persist()
    about = df.agg(
        Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("x"),
        F.avg(label).alias("y"),
        F.stddev_pop(label).alias("s"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    center, spread = about.x.mean.toArray(), np.sqrt(about.x.variance.toArray())
    unit = np.where(spread > 0, spread, 1.0)
    rows, width = about.n, len(center) + 1
    shrink = np.append(1.0 / unit**2, 0.0) / (C * rows)  # mean loss, so numbers do not grow with the rows

    def objective(w: np.ndarray, mu: float) -> tuple[float, np.ndarray]:
        def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width + 1)
            for pdf in batches:
                if len(pdf):
                    x = (np.stack(pdf["x"].to_list()) - center) / unit
                    r = x @ w[:-1] + w[-1] - pdf["y"].to_numpy()
                    out = np.maximum(np.abs(r) - epsilon, 0.0)
                    small = out < mu
                    slope = np.sign(r) * np.where(small, out / mu, 1.0)
                    total[0] += np.where(small, out * out / (2 * mu), out - mu / 2).sum()
                    total[1:-1] += slope @ x
                    total[-1] += slope.sum()
            yield pd.DataFrame({"v": [total]})

        parts = base.mapInPandas(reduce, "v array<double>")
        v = parts.agg(Summarizer.sum(array_to_vector("v")).alias("v")).first().v.toArray()
        return v[0] / rows + 0.5 * (shrink * w) @ w, v[1:] / rows + shrink * w

    w = np.append(np.zeros(width - 1), about.y)
    for share in SMOOTHING:
        mu = share * (about.s or 1.0)
        w, converged = _minimise(lambda at, mu=mu: objective(at, mu), w, about.s or 1.0, max_iter, tol)
    base.unpersist()
    if not converged:
        warnings.warn(f"the support vector regressor has not converged in {max_iter} steps", stacklevel=2)
    coefficients = w[:-1] / unit
    return linear_model(df, coefficients, w[-1] - center @ coefficients)


def _minimise(objective, w: np.ndarray, scale: float, max_iter: int, tol: float) -> tuple[np.ndarray, bool]:
    """L-BFGS with backtracking, and whether it converged: the gradient is small, or no step along it lowers the value. Only
    the parameter vector lives on the driver. ``scale`` sizes the first step."""
    value, grad = objective(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        if np.abs(grad).max() < tol:
            return w, True
        direction, coefs = -grad, []
        for s, y in reversed(steps):
            a = (s @ direction) / (y @ s)
            coefs.append(a)
            direction = direction - a * y
        if steps:
            s, y = steps[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction * (0.1 * scale / np.linalg.norm(grad))
        for (s, y), a in zip(steps, reversed(coefs), strict=True):
            direction = direction + (a - (y @ direction) / (y @ s)) * s
        rate, slope, better = 1.0, grad @ direction, None
        while rate > 1e-6:
            new = w + rate * direction
            new_value, new_grad = objective(new)
            if new_value <= value + 1e-4 * rate * slope:
                better = new
                break
            rate *= 0.3
        if better is None:
            return w, True
        s, y = better - w, new_grad - grad
        if s @ y > 1e-12 * (s @ s):
            steps = [*steps[-(MEMORY - 1) :], (s, y)]
        still = value - new_value <= 1e-12 * max(abs(value), 1e-12)
        w, value, grad = better, new_value, new_grad
        if still:
            return w, True
    return w, False


def linear_model(df: DataFrame, coefficients: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A Spark ML linear model with given coefficients, so that scoring and saving stay Spark's own: least squares
    through one point per coefficient plus the origin has exactly these."""
    n = len(coefficients)
    if n > NORMAL_COLUMNS:  # too many for the exact solver: the model class itself, by its coefficients
        jvm = df.sparkSession._jvm
        vector = jvm.org.apache.spark.ml.linalg.DenseVector(_doubles(df, coefficients))
        return LinearRegressionModel(jvm.org.apache.spark.ml.regression.LinearRegressionModel("svr", vector, float(intercept)))
    points = [(Vectors.sparse(n, {}), float(intercept))]
    points += [(Vectors.sparse(n, {j: 1.0}), float(intercept + c)) for j, c in enumerate(coefficients)]
    table = df.sparkSession.createDataFrame(points, ["features", "label"])
    return LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(table)


def _doubles(df: DataFrame, values: np.ndarray):
    gateway = df.sparkSession.sparkContext._gateway
    out = gateway.new_array(gateway.jvm.double, len(values))
    for i, v in enumerate(values):
        out[i] = float(v)
    return out
