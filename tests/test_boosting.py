import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.functions.vectors import matrix, width
from tablewright.operators import boosting
from tablewright.operators.boosting import BoostedTrees, Penalties, fit_boosted, gradients, losses
from tablewright.operators.models import Trained, make_learner


def frame(spark, x, y):
    rows = [(i, Vectors.sparse(len(a), {j: float(v) for j, v in enumerate(a) if v}) if i % 2 else Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3)


def grown(x, g, h, p, depth, rate, gamma):
    """A tree grown on plain arrays, exact cuts between all values: (feature, cut, left, right) or a leaf's value."""
    leaf = float(p.weight(g.sum(), h.sum())) * rate
    best = (boosting.LEAST_GAIN, None)
    if depth:
        for f in range(x.shape[1]):
            v = np.unique(x[:, f])
            for a, b in zip(v[:-1], v[1:]):
                left = x[:, f] <= (a + b) / 2
                hl, hr = h[left].sum(), h[~left].sum()
                if min(hl, hr) >= p.min_child_weight:
                    gain = p.score(g[left].sum(), hl) + p.score(g[~left].sum(), hr) - p.score(g.sum(), h.sum())
                    if gain > best[0] + 1e-9:
                        best = gain, (f, (a + b) / 2)
    if best[1] is None:
        return leaf
    f, cut = best[1]
    left = x[:, f] <= cut
    kids = [grown(x[s], g[s], h[s], p, depth - 1, rate, gamma) for s in (left, ~left)]
    if best[0] < gamma and not any(isinstance(k, tuple) for k in kids):
        return leaf
    return f, cut, *kids


def valued(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2 if row[tree[0]] <= tree[1] else 3]
    return tree


def brute(x, y, task, classes, rounds, depth, rate, lam=1.0, alpha=0.0, gamma=0.0, child=1.0):
    k = classes if task == "classification" and classes > 2 else 1
    m = np.full((len(y), k), y.mean() if task == "regression" else 0.0)
    p = Penalties(lam, alpha, gamma, child)
    for _ in range(rounds):
        g, h = gradients(task, classes, m, y)
        trees = [grown(x, g[:, j], h[:, j], p, depth, rate, gamma) for j in range(k)]
        m = m + np.array([[valued(t, r) for t in trees] for r in x])
    return m


CASES = [
    ("regression", 0, {}),
    ("regression", 0, {"reg_lambda": 5.0, "reg_alpha": 3.0, "min_child_weight": 12}),
    ("regression", 0, {"gamma": 40.0, "reg_lambda": 0.0}),
    ("classification", 2, {"min_child_weight": 3, "reg_lambda": 0.5}),
    ("classification", 3, {"gamma": 1.0}),
]


@pytest.mark.parametrize(("task", "classes", "more"), CASES)
def test_equals_plain_boosting(spark, task, classes, more):
    rng = np.random.default_rng(len(more) + classes)
    x = np.column_stack([rng.integers(0, 9, 160), rng.normal(size=160).round(1), rng.integers(0, 2, 160)]).astype(float)
    signal = x[:, 0] * (1 + x[:, 2]) + 3 * x[:, 1] + rng.normal(size=160)
    y = signal if task == "regression" else np.digitize(signal, [4, 10])[:].astype(float) if classes == 3 else (signal > 6).astype(float)
    names = {"reg_lambda": "lam", "reg_alpha": "alpha", "gamma": "gamma", "min_child_weight": "child"}
    want = brute(x, y, task, classes, 5, 3, 0.4, **{names[k]: v for k, v in more.items()})
    df = frame(spark, x, y)
    model = fit_boosted(df, task, classes, {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.4, **more})
    got = {r.id: r.asDict() for r in model.transform(df).collect()}
    for i in range(len(y)):
        if task == "regression":
            assert got[i]["prediction"] == pytest.approx(want[i, 0], abs=1e-6)
        else:
            p = boosting.softmax(want[i : i + 1])[0] if classes > 2 else np.array([1 / (1 + np.exp(want[i, 0])), 1 / (1 + np.exp(-want[i, 0]))])
            assert got[i]["probability"].toArray() == pytest.approx(p, abs=1e-6) and got[i]["prediction"] == p.argmax()


def test_derivatives():
    rng = np.random.default_rng(0)
    for task, classes, k in (("regression", 0, 1), ("classification", 2, 1), ("classification", 4, 4)):
        m, y = rng.normal(size=(50, k)), rng.integers(0, max(classes, 2), 50).astype(float)
        g, h = gradients(task, classes, m, y)
        e = 1e-5
        for j in range(k):
            step = np.eye(k)[j] * e
            slope = (losses(task, classes, m + step, y) - losses(task, classes, m - step, y)) / (2 * e)
            assert np.allclose(slope * (0.5 if task == "regression" else 1), g[:, j], atol=1e-6) and (h[:, j] > 0).all()


def test_many_values_and_features_in_several_passes(spark, monkeypatch):
    """More values than bins, histograms cut into passes: the same model as in one pass, and a good one."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = np.sin(2 * x[:, 0]) * 3 + x[:, 1] ** 2
    df = frame(spark, x, y).cache()
    params = {"n_estimators": 9, "max_depth": 3, "max_bins": 40}
    one = [r.prediction for r in fit_boosted(df, "regression", 0, params).transform(df).orderBy("id").collect()]
    monkeypatch.setattr(boosting, "MOST_SUMS", 100)
    two = [r.prediction for r in fit_boosted(df, "regression", 0, params).transform(df).orderBy("id").collect()]
    assert one == two and np.mean((np.array(one) - y) ** 2) < 0.3 * y.var()


def test_samples_of_rows_and_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 6))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    df = frame(spark, x, y).cache()
    model = fit_boosted(df, "classification", 2, {"n_estimators": 12, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.5})
    assert model.transform(df).where("prediction = label").count() > 700
    assert len({tuple(sorted({f for f in t.feature if f >= 0})) for (t,) in model.rounds}) > 1 and all(len({f for f in t.feature if f >= 0}) <= 3 for (t,) in model.rounds)
    whole = fit_boosted(df, "classification", 2, {"n_estimators": 2, "max_depth": 3})
    assert sum(model.featureImportances) == pytest.approx(1)
    assert whole.rounds[0][0].cover[0] == pytest.approx(200) and 90 < model.rounds[0][0].cover[0] < 150  # a quarter of the rows


def test_early_stopping(spark):
    """Labels of the held-out half say the opposite: no round helps, the first one stays."""
    x = np.arange(400).reshape(-1, 1) % 4
    rng = np.random.default_rng(0)
    df = frame(spark, x.astype(float), rng.normal(size=400) + x[:, 0]).withColumn("row_key", F.col("id").cast("string"))
    learner = make_learner("xgboost", "regression", {"n_estimators": 60, "early_stopping": True, "early_stopping_patience": 4, "validation_split": 0.3})
    trained = learner.fit(df, key="row_key")
    valid = [e["valid_loss"] for e in trained.metadata["losses"]]
    best = int(np.argmin(valid)) + 1
    assert trained.metadata["best_round"] == best == trained.model.getNumTrees and len(valid) in (best + 4, 60)
    assert learner.fit(df, key="row_key").metadata["losses"] == trained.metadata["losses"]
    plain = make_learner("xgboost", "regression", {"n_estimators": 5, "validation_split": 0.3}).fit(df)
    assert plain.metadata["best_round"] is None and "valid_loss" not in plain.metadata["losses"][0] and plain.metadata["iterations"] == 5


def test_store(spark):
    x, y = np.random.default_rng(1).normal(size=(60, 3)), np.arange(60) % 3
    df = frame(spark, x, y)
    trained = make_learner("xgboost", "classification", {"n_estimators": 3, "max_depth": 3}).fit(df, ["a", "b", "c"])
    path = new_path(spark, "boosted")
    trained.save(spark, path)
    again = Trained.load(spark, path)
    assert isinstance(again.model, BoostedTrees) and again.model == trained.model
    assert [r.probability for r in again.predict(df).orderBy("id").collect()] == [r.probability for r in trained.predict(df).orderBy("id").collect()]


def test_no_cut_to_make(spark):
    """One row, equal rows, one class: a single leaf, and no crash."""
    for x, y in (([[1.0]], [3.0]), ([[1.0]] * 5, [1.0, 2.0, 3.0, 4.0, 5.0])):
        model = fit_boosted(frame(spark, np.array(x), y), "regression", 0, {"n_estimators": 2})
        assert all(t.feature == [-1] for (t,) in model.rounds) and model.transform(frame(spark, np.array(x), y)).first().prediction == pytest.approx(np.mean(y))
    with pytest.raises(ValueError, match="no rows"):
        make_learner("xgboost", "regression").fit(frame(spark, np.ones((2, 1)), [1.0, 2.0]).where("false"))


def test_vectors_in_tasks(spark):
    rows = [Vectors.dense([1, 2, 3, 0]), Vectors.sparse(4, [1, 3], [5.0, 7.0]), Vectors.sparse(4, [], []), Vectors.dense([0, 0, 0, 9])]
    df = spark.createDataFrame([(v,) for v in rows], ["features"]).coalesce(1)
    for wanted in ([0, 1, 2, 3], [3, 1], [2], []):

        def each(batches, wanted=wanted):
            import pyarrow as pa

            for b in batches:
                got = matrix(b.column(0), np.array(wanted, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([str(got.tolist())]), pa.array([width(b.column(0))])], ["m", "w"])

        r = df.mapInArrow(each, "m string, w long").first()
        assert r.m == str(np.array([v.toArray()[wanted] for v in rows]).tolist()) and r.w == 4
