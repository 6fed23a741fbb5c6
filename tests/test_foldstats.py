import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import foldstats
from tablewright.operators.models import make_learner
from tablewright.operators.selection import cross_validate, tune
from tablewright.operators.stats import distinct_up_to
from tests.test_models import frame


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(1e6, 3, 240), rng.normal(size=240), rng.integers(0, 2, 240)])
    x = np.column_stack([x, 1 - x[:, 2]])  # the last two add up to one
    y = 2 * x[:, 0] - x[:, 1] + 5 * x[:, 2] + rng.normal(size=240)
    return frame(spark, x, y).withColumn("fold", (F.col("id") % 4).cast("int")).repartition(3).cache(), x, y


def expected(x, y, f, intercept):
    fold = np.arange(len(y)) % 4
    a = np.column_stack([x, np.ones(len(y))]) if intercept else x
    beta = np.linalg.lstsq(a[fold != f] - 0, y[fold != f], rcond=None)[0]
    e = y[fold == f] - a[fold == f] @ beta
    return {"mse": (e**2).mean(), "rmse": (e**2).mean() ** 0.5, "mae": np.abs(e).mean(), "r2": 1 - (e**2).mean() / y[fold == f].var()}


def test_scores_equal_refitting(folded):
    df, x, y = folded
    got = foldstats.fold_scores(df, [{"fit_intercept": False}, {}], ("mse", "rmse", "mae", "r2"))
    assert [(k, f) for k, f, _ in got] == [(k, f) for k in (0, 1) for f in range(4)]
    for k, f, values in got:
        want = expected(x - [1e6, 0, 0, 0], y - 2e6, f, True) if k else expected(x, y, f, False)
        assert values == pytest.approx(want, rel=1e-5)


def test_validation_and_search_use_them(folded, monkeypatch):
    df, _, _ = folded
    learner = make_learner("linear_regression")
    fast = {r.metric: (r.score, r.std, r.folds) for r in cross_validate(learner, df, ("rmse", "r2", "accuracy")).collect()}
    found = tune(learner, df, {"fit_intercept": [True, False]}, scoring="rmse")
    monkeypatch.setattr(foldstats, "MOST_COLUMNS", 1)  # wider tables are fitted fold by fold
    slow = {r.metric: (r.score, r.std, r.folds) for r in cross_validate(learner, df, ("rmse", "r2")).collect()}
    assert fast.keys() == slow.keys() == {"rmse", "r2"}
    for m, values in slow.items():
        assert fast[m] == pytest.approx(values, rel=2e-3)  # the other solver is not as exact on such columns
    assert found.candidates.count() == 2 and found.best_score == pytest.approx(slow["rmse"][0], rel=1e-2)


def test_merged_moments():
    rng = np.random.default_rng(0)
    z = rng.normal(1e8, 1, (50, 3))
    parts = [foldstats.Moments.of(p) for p in np.split(z, [7, 8, 30])]
    whole = foldstats.Moments.of(z)
    total = parts[0] + parts[1] + parts[2] + parts[3]
    assert total.n == 50 and np.allclose(total.mean, whole.mean) and np.allclose(total.products, whole.products, rtol=1e-6)


def test_distinct_up_to(spark):
    df = spark.createDataFrame([(float(i % 7) if i % 5 else None, f"t{i % 3}", float("nan")) for i in range(100)], "a double, b string, c double").repartition(4)
    assert [distinct_up_to(df, F.col("a"), k) for k in (2, 6, 7, 50)] == [3, 7, 7, 7]
    assert distinct_up_to(df, F.col("b"), 2) == 3 and distinct_up_to(df, F.col("c"), 1) == 1
    assert distinct_up_to(df.where("false"), F.col("a"), 2) == 0
