import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators.explain import explain, explain_by_scoring, explain_linear, explain_trees, importance
from tablewright.operators.models import make_learner
from tests.test_models import frame


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4)).round(2)
    y = x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=150) * 0.1
    return frame(spark, x, y).repartition(3).cache(), x, y


def shares(explanation, cls=0):
    rows = explanation.values.where(F.col("class") == cls).groupBy("id").pivot("feature").agg(F.first("phi")).orderBy("id")
    return np.array([[r[f"f{i}"] for i in range(4)] for r in rows.collect()])


def shapley(value, d):
    """Straight from the definition, over all subsets."""
    out = np.zeros(d)
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        for k in range(d):
            for s in itertools.combinations(rest, k):
                w = factorial(k) * factorial(d - k - 1) / factorial(d)
                out[i] += w * (value({*s, i}) - value(set(s)))
    return out


def test_trees_match_the_definition(spark, data):
    df, x, y = data
    model = make_learner("xgboost", "regression", {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5}).fit(df)
    got = shares(explain_trees(model, df, ["id"]))

    def expected(row, known):
        """The path-dependent game: a cut by an unknown feature is passed to both sides, by their covers."""

        def at(t, n):
            if t.feature[n] < 0:
                return t.value[n]
            if t.feature[n] in known:
                return at(t, t.left[n] if row[t.feature[n]] <= t.cut[n] else t.right[n])
            return sum(t.cover[c] * at(t, c) for c in (t.left[n], t.right[n])) / t.cover[n]

        return sum(at(t, 0) for (t,) in model.model.rounds)

    for i in (0, 17, 149):
        assert np.allclose(got[i], shapley(lambda s, i=i: expected(x[i], s), 4))


@pytest.mark.parametrize("model,task", [("random_forest", "regression"), ("xgboost", "regression"), ("random_forest", "classification"), ("xgboost", "classification")])
def test_tree_shares_add_up(spark, data, model, task):
    df, x, y = data
    if task == "classification":
        df = df.withColumn("label", (F.col("label") > 0.3).cast("double"))
    trained = make_learner(model, task, {"n_estimators": 4, "max_depth": 4}).fit(df)
    got = explain_trees(trained, df, ["id"])
    scored = trained.predict(df).orderBy("id").collect()
    if task == "regression":
        want, cls = [r.prediction for r in scored], 0
    elif model == "random_forest":
        want, cls = [r.probability[1] for r in scored], 1
    else:
        want, cls = [np.log(r.probability[1] / r.probability[0]) for r in scored], 1
    base = got.base[cls if len(got.base) > 1 else 0]
    assert np.allclose(shares(got, cls).sum(axis=1) + base, want, atol=1e-9)


def test_categorical_splits(spark):
    """One-hot columns are split by category sets, not thresholds."""
    from tablewright.operators.transforms import fit_transforms
    from tests.conftest import make_spec

    df = spark.createDataFrame([(i, "abc"[i % 3], "xy"[i % 2], float(i % 3 * 10 + i % 2)) for i in range(60)], "id int, c string, d string, y double")
    fitted = fit_transforms(df, make_spec([("c", "categorical", "one-hot"), ("d", "categorical", "one-hot")], ("y", "continuous")))
    rows = fitted.transform(df, label="label")
    trained = make_learner("random_forest", "regression", {"n_estimators": 1, "max_depth": 4, "bootstrap": False}).fit(rows, fitted.feature_names)
    got = explain_trees(trained, rows, ["id", "y"])
    sums = got.values.groupBy("id", "y").agg(F.sum("phi").alias("s")).collect()
    assert all(r.s + got.base[0] == pytest.approx(r.y) for r in sums)


def test_linear(data):
    df, x, y = data
    trained = make_learner("linear_regression").fit(df)
    got = explain_linear(trained, df, df, ["id"])
    assert np.allclose(shares(got), (x - x.mean(axis=0)) * trained.model.coefficients.toArray())
    assert got.base[0] == pytest.approx(y.mean())
    bars = {r.feature: r.importance for r in importance(got.values).collect()}
    assert bars["f2"] == pytest.approx(np.abs(shares(got)[:, 2]).mean())


def test_scoring_all_coalitions(data):
    df, x, y = data
    trained = make_learner("xgboost", "regression", {"n_estimators": 3, "max_depth": 3}).fit(df)
    behind = df.where("id < 7")
    got = explain_by_scoring(trained, df.where("id >= 145"), behind, ["id"])
    model = trained.model

    def value(row, known):
        mixed = x[:7].copy()
        for j in known:
            mixed[:, j] = row[j]
        from pyspark.ml.linalg import Vectors

        return np.mean([model.predict(Vectors.dense(m)) for m in mixed])

    assert np.allclose(shares(got)[0], shapley(lambda s: value(x[145], s), 4))


def test_scoring_drawn_coalitions(spark):
    """Sums of functions of one column each are found exactly from drawn coalitions; others within their errors."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 2, (300, 14)).astype(float)
    df = frame(spark, x, x @ np.arange(14.0)).cache()
    linear = make_learner("linear_regression").fit(df)
    got = explain_by_scoring(linear, df.where("id < 4"), df.where("id >= 280"), ["id"], coalitions=200)
    assert got.method == "sampled" and got.values.where("standard_error > 1e-6").count() == 0
    table = {(r.id, int(r.feature[1:])): r.phi for r in got.values.collect()}
    want = (x[:4] - x[280:].mean(axis=0)) * linear.model.coefficients.toArray()
    assert all(table[i, j] == pytest.approx(want[i, j], abs=1e-6) for i in range(4) for j in range(14))

    wide = frame(spark, x[:, :8], x[:, 0] * x[:, 1] * 10 + x[:, 2] * x[:, 3] * 6 + x[:, 4]).cache()
    trees = make_learner("xgboost", "regression", {"n_estimators": 12, "max_depth": 4}).fit(wide)
    some, behind = wide.where("id < 6"), wide.where("id >= 290")
    exact = explain_by_scoring(trees, some, behind, ["id"], method="exact")
    drawn = explain_by_scoring(trees, some, behind, ["id"], method="sampled", coalitions=700)
    assert (exact.method, drawn.method) == ("exact", "sampled") and exact.values.where("standard_error <> 0").count() == 0
    both = exact.values.alias("e").join(drawn.values.alias("d"), ["id", "feature"]).select("id", F.col("e.phi").alias("want"), F.col("d.phi").alias("got"), F.col("d.standard_error").alias("se")).collect()
    assert len(both) == 48 and sum(abs(r.want - r.got) <= 3 * r.se + 1e-9 for r in both) >= 45 and max(r.se for r in both) < 0.3
    again = explain_by_scoring(trees, some.repartition(2), behind, ["id"], method="sampled", coalitions=700).values.collect()
    assert {(r.id, r.feature): round(r.phi, 9) for r in again} == {(r.id, r.feature): round(r.phi, 9) for r in drawn.values.collect()}


def test_scoring_one_column(spark):
    df = frame(spark, np.arange(6.0)[:, None], np.arange(6.0) * 2)
    got = explain_by_scoring(make_learner("linear_regression").fit(df), df.coalesce(1), df, ["id"])
    assert got.values.count() == 6 and all(r.phi == pytest.approx(2 * (r.id - 2.5)) and r.standard_error == 0 for r in got.values.collect())
    with pytest.raises(ValueError, match="method"):
        explain_by_scoring(None, df, df, ["id"], method="other")


def test_choice_of_method(data):
    df, _, _ = data
    one = df.where("id < 3")
    for model, task, params in (("linear_regression", None, {}), ("random_forest", "regression", {"n_estimators": 2, "max_depth": 2}), ("svm", "regression", {"n_components": 10, "max_iter": 3})):
        trained = make_learner(model, task, params).fit(df)
        assert explain(trained, one, df, ["id"]).values.count() == 12


def test_groups_of_trees_add_up(spark, data, monkeypatch):
    """More leaves than one pass takes give the same values in several."""
    df, x, _ = data
    model = make_learner("random_forest", "classification", {"n_estimators": 5, "max_depth": 3}).fit(df.withColumn("label", (F.col("label") > 0).cast("double")))
    once = explain_trees(model, df, ["id"])
    monkeypatch.setattr("tablewright.operators.treeshap.MAX_NODES", 20)
    several = explain_trees(model, df, ["id"])
    for c in (0, 1):
        assert np.allclose(shares(once, c), shares(several, c), atol=1e-12)
    assert np.allclose(once.base, several.base)
