import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.operators.metrics import classification_metrics, detect_task, evaluate, is_classification, metric_frame, regression_metrics
from tablewright.operators.models import make_learner
from tablewright.operators.selection import compare_models, cross_validate, draw, grid, iteration_summary, suggest_improvements, tune
from tablewright.operators.split import assign_folds
from tests.test_models import frame


def pairs(spark, y, p):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p, strict=True)], "label double, prediction double")


def by_hand(y, p, binary):
    y, p = np.array(y), np.array(p)
    out = {}
    for c in sorted({*y, *p}):
        tp, called, support = ((y == c) & (p == c)).sum(), (p == c).sum(), (y == c).sum()
        out[c] = (support, tp / called if called else 0.0, tp / support if support else 0.0, 2 * tp / (called + support))
    if binary:
        return out[1][1:]
    return tuple(sum(v[0] * v[i] for v in out.values()) / len(y) for i in (1, 2, 3))


@pytest.mark.parametrize(
    "y,p,binary",
    [
        ([0, 1, 0, 1, 0, 1], [0, 1, 1, 1, 0, 0], True),
        ([0, 1, 0, 1], [0, 0, 0, 0], True),
        ([0, 1, 2, 2, 1, 0, 2], [0, 2, 2, 1, 1, 0, 0], False),
        ([0, 1, 2], [3, 3, 3], False),
        ([1, 1, 1], [1, 1, 0], False),
    ],
)
def test_classification(spark, y, p, binary):
    got = classification_metrics(pairs(spark, y, p)).first()
    assert got.accuracy == pytest.approx(np.mean(np.array(y) == np.array(p)))
    assert (got.precision, got.recall, got.f1) == pytest.approx(by_hand(y, p, binary))
    weighted = classification_metrics(pairs(spark, y, p), average="weighted").first()
    assert (weighted.precision, weighted.recall, weighted.f1) == pytest.approx(by_hand(y, p, False))


def test_regression(spark):
    y, p = np.array([10.5, 20.3, 30.1, 40.8, 50.2]), np.array([11.0, 19.0, 33.0, 40.0, 50.0])
    got = regression_metrics(pairs(spark, y, p)).first()
    mse = ((y - p) ** 2).mean()
    assert (got.mse, got.rmse, got.mae) == pytest.approx((mse, math.sqrt(mse), abs(y - p).mean()))
    assert got.r2 == pytest.approx(1 - mse / y.var())
    assert regression_metrics(pairs(spark, [2, 2], [2, 2])).first().r2 == 1.0
    assert regression_metrics(pairs(spark, [2, 2], [2, 3])).first().r2 == 0.0


def test_mixed_and_unknown_metrics(spark):
    df = pairs(spark, [0, 1], [0, 1])
    assert metric_frame(df, ["accuracy", "rmse"]).first().asDict() == {"accuracy": 1.0, "rmse": 0.0}
    with pytest.raises(ValueError, match="Unsupported metric: speed"):
        metric_frame(df, ["accuracy", "speed"])


def test_task_detection(spark):
    assert is_classification(pairs(spark, [0, 1, 0, 1], [0] * 4))
    assert not is_classification(pairs(spark, [1.5, 2.3, 3.7, 4.1], [0] * 4))
    assert not is_classification(pairs(spark, range(10), [0] * 10))


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 2))
    y = x @ [1.0, -2.0] + 5 + rng.normal(size=120) * 0.3
    return frame(spark, x, y).cache(), x, y


def test_evaluate_keeps_history(line):
    df, _, _ = line
    trained = make_learner("linear_regression").fit(df)
    got = evaluate(trained, df, ["rmse", "r2"])
    assert trained.metadata["performance_history"][0]["metrics"] == got
    with pytest.raises(ValueError):
        evaluate(trained, df, ["unsupported_metric"])


def test_cross_validation(line):
    df, x, y = line
    folded = assign_folds(df, 4, "id").cache()
    fold = np.array([r.fold for r in folded.orderBy("id").collect()])
    want = {"rmse": [], "r2": []}
    for f in range(4):
        a = np.column_stack([x, np.ones(len(x))])
        w, *_ = np.linalg.lstsq(a[fold != f], y[fold != f], rcond=None)
        e = y[fold == f] - a[fold == f] @ w
        want["rmse"].append(-math.sqrt((e**2).mean()))
        want["r2"].append(1 - (e**2).mean() / y[fold == f].var())
    got = {r.metric: r for r in cross_validate(make_learner("linear_regression"), folded, ["rmse", "accuracy", "r2"]).collect()}
    assert set(got) == {"rmse", "r2"}
    for m in want:
        assert (got[m].score, got[m].std, got[m].folds) == pytest.approx((np.mean(want[m]), np.std(want[m]), 4))


def test_grid_and_draws():
    space = {"a": [1, 2, 3], "b": [None, "x"]}
    assert len(grid(space)) == 6 and {"a": 3, "b": None} in grid(space)
    assert draw(space, 4, 42) == draw(space, 4, 42)
    assert len({str(c) for c in draw(space, 4, 42)}) == 4
    assert len(draw(space, 100, 42)) == 6


def test_tuning(line):
    df, _, _ = line
    folded = assign_folds(df, 3, "id")
    got = tune(make_learner("linear_regression"), folded, {"fit_intercept": [False, True]})
    assert got.best_params == {"fit_intercept": True}
    assert got.best_score == got.candidates.first().score > 0.9
    assert got.model.model.intercept == pytest.approx(5, abs=0.1)
    drawn = tune(make_learner("xgboost", "regression"), folded, {"n_estimators": [1, 2], "max_depth": [1, 2]}, "random", n_iter=2)
    assert drawn.candidates.count() == 2
    with pytest.raises(ValueError, match="Unsupported tuning method"):
        tune(make_learner("linear_regression"), folded, {}, "guess")


def test_comparison(spark):
    rows = [("b", "rmse", 1.0), ("a", "rmse", 1.0), ("a", "r2", 0.2), ("b", "r2", 0.3), ("b", "mae", 0.1)]
    got = {r.metric: (r.best_model, r.best_value) for r in compare_models(spark.createDataFrame(rows, "model string, metric string, value double")).collect()}
    assert got == {"rmse": ("a", 1.0), "r2": ("b", 0.3)}


def test_suggestions(spark):
    rows = [("m1", "random_forest", 50, 100, {}), ("m2", "xgboost", 100, 5000, {"max_depth": "3"}), ("m3", "xgboost", None, None, {}), ("m4", "random_forest", None, 2000, {"n_estimators": "100"})]
    runs = spark.createDataFrame(rows, "model string, model_type string, epochs int, n_samples_trained long, hyperparameters map<string,string>")
    got = {r.model: len(r.suggestions) for r in suggest_improvements(runs).collect()}
    assert got == {"m1": 3, "m3": 1}


def test_iteration_summary(spark):
    df = spark.createDataFrame([("r2", 1.0), ("r2", 3.0), ("mae", 4.0)], "metric string, value double")
    got = {r.metric: (r["mean"], r["std"], r.runs) for r in iteration_summary(df).collect()}
    assert got == {"r2": (2.0, 1.0, 2), "mae": (4.0, 0.0, 1)}


def test_single_class_fold(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 5), 0 if i < 4 else 1) for i in range(10)], ["features", "label", "fold"])
    df = df.withColumn("fold", F.col("fold").cast("int"))
    got = cross_validate(make_learner("logistic_regression"), df, ["accuracy", "f1"])
    assert got.count() == 2


def test_task_detection_counts_all_values(spark):
    df = spark.createDataFrame([(float(a),) for a in [*range(37), 5]] + [(None,)], "label double")
    got = detect_task(df).first()
    assert (got.distinct, got.integral, got.is_classification) == (37, True, False)
