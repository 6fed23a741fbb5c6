import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.operators import condense, models
from tablewright.operators.models import make_learner

SHARES = {"bootstrap": False, "max_features": "all", "n_estimators": 2, "max_depth": 4}


@pytest.fixture(scope="module")
def repeated(spark):
    """3,000 rows of six different vectors: a class and a value that depend on them and on chance."""
    rng = np.random.default_rng(3)
    rows = [(Vectors.dense([float(a), float(b)]), float(rng.random() < 0.2 + 0.1 * a + 0.2 * b), float(rng.normal(3 * a - b))) for a, b in rng.integers(0, [3, 2], (3000, 2))]
    return spark.createDataFrame(rows, ["features", "class", "value"]).cache()


def rows_fitted(monkeypatch):
    seen = []
    monkeypatch.setattr(models, "condensed", lambda *a: seen.append(condense.condensed(*a)) or seen[-1])
    return seen


@pytest.mark.parametrize("model,task,params", [
    ("random_forest", "classification", SHARES), ("random_forest", "regression", SHARES),
    ("xgboost", "classification", {"n_estimators": 3}), ("xgboost", "regression", {"n_estimators": 3}), ("svm", "classification", {"max_iter": 20}),
])
def test_fits_see_equal_rows_once(spark, repeated, monkeypatch, model, task, params):
    df = repeated.select("features", F.col("class" if task == "classification" else "value").alias("label"))
    seen = rows_fitted(monkeypatch)
    short = make_learner(model, task, params).fit(df)
    assert len(seen) == 1 and seen[0].count() <= 64 and seen[0].agg(F.sum("weight")).first()[0] == 3000
    monkeypatch.setattr(models, "worth_it", lambda *a: False)
    whole = make_learner(model, task, params).fit(df)
    assert len(seen) == 1 and short.metadata["n_samples_trained"] == whole.metadata["n_samples_trained"] == 3000
    a, b = (np.array([r.prediction for r in t.predict(df.select("features").distinct()).orderBy(F.col("features").cast("string")).collect()]) for t in (short, whole))
    assert np.allclose(a, b, rtol=1e-9)
    if model == "random_forest":
        assert np.allclose(short.model.featureImportances.toArray(), whole.model.featureImportances.toArray())


def test_other_fits_see_every_row(spark, repeated, monkeypatch):
    df = repeated.select("features", F.col("class").alias("label"))
    seen = rows_fitted(monkeypatch)
    make_learner("random_forest", "classification", {"n_estimators": 2, "max_depth": 2}).fit(df)
    make_learner("xgboost", "classification", {"n_estimators": 1, "subsample": 0.5}).fit(df)
    make_learner("random_forest", "classification", SHARES).fit(df.limit(500))
    make_learner("random_forest", "classification", SHARES).fit(df.withColumn("features", F.udf(lambda i: Vectors.dense([float(i), 0.0]), repeated.schema["features"].dataType)(F.monotonically_increasing_id())))
    assert not seen
