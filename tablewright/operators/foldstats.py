"""Least squares over folds from sufficient statistics.

One pass gives every fold its count, means and co-moments of the columns and the target, merged pairwise so that nothing cancels. The
fit that leaves a fold out comes from all folds' moments but its own, and its squared errors on that fold come from the fold's moments:
neither rows are read again nor a model fitted on them, for any number of folds or settings. Only absolute errors take a second pass, for all
folds and settings together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.functions.vectors import matrix, width

MOST_COLUMNS = 512  # a fold's moments are the square of it; wider tables are fitted fold by fold


@dataclass
class Moments:
    """Count, means and sums of products of deviations; the target is the last column."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, z: np.ndarray) -> Moments:
        mean = z.mean(axis=0)
        return cls(float(len(z)), mean, (z - mean).T @ (z - mean))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    def fit(self, intercept: bool) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of least squares; columns without a spread of their own get the smallest coefficients that do."""
        size = np.sqrt(np.diag(self.products))
        size[size == 0] = 1.0
        # rows with the same products as the data's deviations; without an intercept the means are one more row
        strength, across = np.linalg.eigh(self.products / np.outer(size, size))
        strength[strength < 1e-12 * max(strength[-1], 0.0)] = 0.0
        rows = np.sqrt(np.maximum(strength, 0.0))[:, None] * across.T
        if not intercept:
            rows = np.vstack([rows, np.sqrt(self.n) * self.mean / size])
        length = np.linalg.norm(rows[:, :-1], axis=0)
        length[length == 0] = 1.0
        beta = np.linalg.lstsq(rows[:, :-1] / length, rows[:, -1], rcond=1e-9)[0] * size[-1] / (length * size[:-1])
        return beta, float(self.mean[-1] - beta @ self.mean[:-1]) if intercept else 0.0

    def squared_error(self, beta: np.ndarray, intercept: float) -> float:
        """Sum over these rows of (y - intercept - beta x) squared."""
        p, centre = self.products, self.mean[-1] - intercept - beta @ self.mean[:-1]
        return float(max(p[-1, -1] - 2 * beta @ p[:-1, -1] + beta @ p[:-1, :-1] @ beta, 0.0) + self.n * centre * centre)


def fold_moments(df: DataFrame) -> dict[int, Moments]:
    """Moments of every fold of ``df`` (features, label, fold): one pass, one row a fold and task shuffled."""
    names, schema = ["fold", "n", "mean", "products"], "fold int, n double, mean binary, products binary"

    def out(held: dict[int, Moments]) -> Iterator[pa.RecordBatch]:
        for f, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([m.n]), pa.array([m.mean.tobytes()], pa.binary()), pa.array([m.products.tobytes()], pa.binary())], names)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            if b.num_rows:
                w = width(b.column(0))
                z = np.column_stack([matrix(b.column(0), np.arange(w)), b.column(1).to_numpy(zero_copy_only=False)])
                fold = b.column(2).to_numpy(zero_copy_only=False)
                for f in np.unique(fold).tolist():
                    m = Moments.of(z[fold == f])
                    held[f] = held[f] + m if f in held else m
        yield from out(held)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            for f, n, mean, products in zip(*(c.to_pylist() for c in b.columns), strict=True):
                mean = np.frombuffer(mean)
                m = Moments(n, mean, np.frombuffer(products).reshape(len(mean), -1))
                held[f] = held[f] + m if f in held else m
        yield from out(held)

    parts = df.select("features", df["label"].cast("double"), df["fold"].cast("int")).mapInArrow(measured, schema)
    rows = parts.repartition("fold").sortWithinPartitions("fold", "n").mapInArrow(merged, schema).collect()
    return {r.fold: Moments(r.n, np.frombuffer(r.mean), np.frombuffer(r.products).reshape(len(r.mean) // 8, -1)) for r in rows}


def _absolute_errors(df: DataFrame, fits: dict[int, np.ndarray], settings: int) -> dict[int, np.ndarray]:
    """Sums of absolute errors per fold and setting; ``fits`` has a row of coefficients and intercept for each setting."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                x = np.column_stack([matrix(b.column(0), np.arange(width(b.column(0)))), np.ones(b.num_rows)])
                y, fold = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
                for f in np.unique(fold).tolist():
                    of = fold == f
                    held[f] = held.get(f, 0.0) + np.abs(y[of][:, None] - x[of] @ fits[f].T).sum(axis=0)
        rows = [(f, k, float(v)) for f, sums in held.items() for k, v in enumerate(sums)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.float64()), strict=True)], ["fold", "setting", "e"])

    sums = df.select("features", df["label"].cast("double"), df["fold"].cast("int")).mapInArrow(each, "fold int, setting int, e double").groupBy("fold", "setting").sum("e")
    out = {f: np.zeros(settings) for f in fits}
    for r in sums.collect():
        out[r[0]][r[1]] = r[2]
    return out


def fold_scores(df: DataFrame, settings: Sequence[dict[str, Any]], metrics: Sequence[str]) -> list[tuple[int, int, dict[str, float]]] | None:
    """(setting, fold, metrics) of least squares with each setting, every fold left out in turn; errors are not negated. None if the
    table is too wide for moments."""
    first = df.select("features").first()
    if first is None or first.features.size > MOST_COLUMNS:
        return None
    folds = fold_moments(df)
    fits: dict[int, list[tuple[np.ndarray, float]]] = {}
    for f in folds:
        rest = None
        for g, m in sorted(folds.items()):
            if g != f:
                rest = m if rest is None else rest + m
        if rest is None:
            raise ValueError("one fold alone leaves no rows to fit on")
        fits[f] = [rest.fit(bool(s.get("fit_intercept", True))) for s in settings]
    absolute = _absolute_errors(df, {f: np.array([[*beta, a] for beta, a in of]) for f, of in fits.items()}, len(settings)) if "mae" in metrics else None
    out = []
    for k in range(len(settings)):
        for f, m in sorted(folds.items()):
            mse, spread = m.squared_error(*fits[f][k]) / m.n, m.products[-1, -1] / m.n
            values = {"mse": mse, "rmse": mse**0.5, "r2": 1 - mse / spread if spread > 0 else float(mse == 0)}
            if absolute:
                values["mae"] = absolute[f][k] / m.n
            out.append((k, f, {name: float(values[name]) for name in metrics}))
    return out
