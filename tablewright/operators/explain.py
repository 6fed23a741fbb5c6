"""Per-feature contributions to predictions, as a long table (key..., class, feature, phi).

For every row, the contributions and the base value of its class add up to the model's output: the value for
regression, the class probability for forests, the log-odds for boosted trees and linear classifiers.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.kernelshap import default_coalitions, is_exact, kernel_contributions
from tablewright.operators.models import Trained
from tablewright.operators.treeshap import tree_contributions
from tablewright.sources.files import sample_rows

SAMPLE_ROWS, BACKGROUND_ROWS = 100, 50  # fixed values
MOST_EXACT = 30  # columns whose coalitions can all be scored, if asked for


@dataclass
class Explanation:
    values: DataFrame
    base: list[float]  # per class
    method: str = "exact"


def explanation_sample(df: DataFrame, key: str | Sequence[str] | None, n: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    return sample_rows(df, n, key, seed)


def importance(values: DataFrame) -> DataFrame:
    """(feature, importance): the mean size of a feature's contributions."""
    return values.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def _names(trained: Trained, width: int) -> Column:
    return _constant(trained.feature_names or [f"f{i}" for i in range(width)], "array<string>")


# ---------------------------------------------------------------------------------------------- linear


def _linear_parts(model) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, intercepts), one row per explained class."""
    if hasattr(model, "coefficientMatrix") and model.numClasses > 2:
        return model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    return model.coefficients.toArray()[None, :], np.array([model.intercept])


def explain_linear(trained: Trained, df: DataFrame, background: DataFrame, keep: Sequence[str]) -> Explanation:
    """coefficient * (value - background mean), as column expressions; the means take one pass."""
    coefs, intercepts = _linear_parts(trained.model)
    mean = background.agg(Summarizer.mean(F.col("features")).alias("m")).first().m.toArray()
    x = vector_to_array("features")

    def of_class(c: int) -> Column:
        w, m = (_constant([float(v) for v in values], "array<double>") for values in (coefs[c], mean))
        phi = F.transform(x, lambda v, i: F.get(w, i) * (v - F.get(m, i)))
        return F.struct(F.lit(c).alias("class"), phi.alias("phi"))

    first = 1 if len(coefs) == 1 and trained.learner.task == "classification" else 0
    per_class = df.select(*keep, F.inline(F.array(*[of_class(c) for c in range(len(coefs))])))
    named = _long(per_class.withColumn("class", F.col("class") + first), keep, _names(trained, coefs.shape[1]))
    return Explanation(named, [float(b + w @ mean) for w, b in zip(coefs, intercepts, strict=True)])


def _long(df: DataFrame, keep: Sequence[str], names: Column) -> DataFrame:
    """(keep..., class, phi[]) to one row per feature."""
    out = df.select(*keep, "class", F.posexplode("phi").alias("position", "phi"))
    return out.select(*keep, "class", F.get(names, F.col("position")).alias("feature"), "phi")


# ----------------------------------------------------------------------------------------------- trees


def explain_trees(trained: Trained, df: DataFrame, keep: Sequence[str]) -> Explanation:
    """Path-dependent Shapley values of forests (on class probabilities) and boosted trees (on margins), see ``treeshap``."""
    rows, base, classes = tree_contributions(trained, df, keep)
    first = 1 if classes == 1 and trained.learner.task == "classification" else 0
    out = rows.withColumn("class", F.col("class") + first)
    return Explanation(_long(out, keep, _names(trained, trained.n_features)), base)


# ----------------------------------------------------------------------------------- any other model


def explain_by_scoring(
    trained: Trained,
    df: DataFrame,
    background: DataFrame,
    keep: Sequence[str],
    n_background: int = BACKGROUND_ROWS,
    coalitions: int | None = None,
    seed: int = 42,
    output: str = "prediction",
    method: str = "auto",
) -> Explanation:
    """Shapley values of any model from its predictions on mixtures of a row and background rows, see ``kernelshap``.

    ``method`` is exact (all coalitions are scored), sampled (``coalitions`` drawn ones, twice the columns and 2,048 by default) or
    auto (exact if no more than that); the explanation says which it was, and ``values`` have a ``standard_error`` (0 where exact).
    ``keep`` must identify a row.
    """
    if method not in ("auto", "exact", "sampled"):
        raise ValueError(f"method {method!r}; there are auto, exact and sampled")
    picked = np.stack([v.toArray() for v in _background(background, n_background, seed)])
    width = picked.shape[1]
    n = default_coalitions(width) if coalitions is None else int(coalitions)
    exact = method == "exact" or method == "auto" and is_exact(width, n)
    if exact and width > MOST_EXACT:
        raise ValueError(f"{width} columns have too many coalitions; {MOST_EXACT} columns can be explained exactly")
    rows, base = kernel_contributions(trained, df, picked, keep, n, exact, seed, output)
    names = _names(trained, width)
    long = rows.select(*keep, "class", F.posexplode(F.arrays_zip("phi", "error")).alias("position", "s"))
    values = long.select(*keep, "class", F.get(names, F.col("position")).alias("feature"), F.col("s.phi").alias("phi"), F.col("s.error").alias("standard_error"))
    return Explanation(values, [base], "exact" if exact else "sampled")


def _constant(value, ddl: str) -> Column:
    """A nested constant as one expression, folded before the query runs."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def _background(df: DataFrame, n: int, seed: int) -> list:
    """At most ``n`` background rows, the same ones each time."""
    return [r.features for r in sample_rows(df.select("features"), n, None, seed).collect()]


def explain(trained: Trained, df: DataFrame, background: DataFrame, keep: Sequence[str], rows: int = SAMPLE_ROWS) -> Explanation:
    """The method that fits the model: trees, linear, or scoring of mixtures, which explains a sample of ``rows`` rows."""
    parts = getattr(trained.model, "models", None)
    if trained.front is None and parts is None:
        kind = type(trained.model)
        if hasattr(kind, "featureImportances"):
            return explain_trees(trained, df, keep)
        if hasattr(kind, "coefficients"):
            return explain_linear(trained, df, background, keep)
    return explain_by_scoring(trained, explanation_sample(df, list(keep), rows), background, keep)
