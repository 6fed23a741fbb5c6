import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.operators.metrics import evaluate
from tablewright.operators.models import Learner, Trained, infer_task, make_learner, usable_params
from tablewright.operators.svm import RandomFeatures

X = np.arange(1.0, 16.0).reshape(5, 3)


def frame(spark, x, y):
    return spark.createDataFrame([(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], ["id", "features", "label"])


@pytest.fixture(scope="module")
def classes(spark):
    return frame(spark, X, [0, 1, 0, 1, 0]).cache()


@pytest.fixture(scope="module")
def values(spark):
    return frame(spark, X, [10.5, 20.3, 30.1, 40.8, 50.2]).cache()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 300)
    x = rng.normal(size=(300, 2)) + np.array([[0, 0], [3, 0], [0, 3]])[y]
    return frame(spark, x, y).repartition(3).cache(), x, y


def test_catalogue():
    assert infer_task("svr") == infer_task("random_forest_regressor") == infer_task("linear_regression") == "regression"
    assert infer_task("random_forest") == infer_task("xgboost_classifier") == "classification"
    assert make_learner("SVR").model_type == "svm" and make_learner("SVR").task == "regression"
    with pytest.raises(ValueError, match="Unsupported model type"):
        make_learner("linear_regression", "classification")
    with pytest.raises(ValueError, match="Unsupported task"):
        make_learner("svm", "ranking")


def test_parameters(spark):
    given = {"epochs": 7, "batch_size": 4, "learning_rate": 0.5, "early_stopping": True, "validation_split": 0.1, "max_depth": 3}
    assert usable_params("random_forest", given) == {"max_depth": 3}
    assert usable_params("xgboost", given) == {"n_estimators": 7, "learning_rate": 0.5, "max_depth": 3}
    assert usable_params("xgboost", {"epochs": 7, "n_estimators": 2}) == {"n_estimators": 2}
    assert usable_params("svm", None) == {}
    forest = Learner("random_forest", "classification").estimator()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (100, 30, "sqrt")
    assert Learner("random_forest", "regression").estimator().getFeatureSubsetStrategy() == "all"
    boosted = Learner("xgboost", "regression").estimator()
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (100, 0.3, 6)
    assert Learner("random_forest", "regression", {"min_samples_split": 10}).estimator().getMinInstancesPerNode() == 5
    assert given["epochs"] == 7


@pytest.mark.parametrize("model", ["random_forest", "logistic_regression", "xgboost", "svm"])
def test_classifiers(spark, classes, model):
    trained = make_learner(model, "classification", {"n_estimators": 3, "n_components": 20, "max_iter": 10}).fit(classes)
    assert {r.prediction for r in trained.predict(classes).collect()} <= {0.0, 1.0}
    assert trained.metadata["n_samples_trained"] == 5 and trained.metadata["n_features"] == 3
    assert trained.predict(classes).first().features.size == 3
    if model == "svm":
        with pytest.raises(NotImplementedError):
            trained.predict_proba(classes)
    else:
        proba = trained.predict_proba(classes, "id").groupBy("id").agg(F.sum("probability").alias("s"), F.count("class").alias("n")).collect()
        assert all(r.n == 2 and r.s == pytest.approx(1) for r in proba)


@pytest.mark.parametrize("model", ["random_forest", "linear_regression", "xgboost", "svm"])
def test_regressors(spark, values, model):
    trained = make_learner(model, "regression", {"n_estimators": 3, "n_components": 20, "max_iter": 6}).fit(values)
    assert trained.predict(values).where("prediction IS NULL").count() == 0
    path = new_path(spark, "model")
    trained.save(spark, path)
    again = Trained.load(spark, path)
    want = [r.prediction for r in trained.predict(values).orderBy("id").collect()]
    assert [r.prediction for r in again.predict(values).orderBy("id").collect()] == want
    assert again.metadata["model_type"] == model and again.learner == trained.learner


def test_model_stored_without_description(spark, values):
    from pyspark.ml import PipelineModel

    trained = make_learner("linear_regression").fit(values)
    path = new_path(spark, "bare")
    PipelineModel([trained.model]).save(f"{path}/model")
    again = Trained.load(spark, path)
    assert again.metadata == {} and again.learner.task == "regression"
    assert again.predict(values).count() == 5


def test_multiclass(blobs):
    df, x, y = blobs
    for model, params in (("xgboost", {"n_estimators": 3, "max_depth": 2}), ("logistic_regression", {}), ("svm", {"kernel": "linear"}), ("random_forest", {"n_estimators": 5})):
        trained = make_learner(model, "classification", params).fit(df)
        assert evaluate(trained, df, ["accuracy"])["accuracy"] > 0.85, model
        assert trained.metadata["classes"] == 3


def test_logistic_matches_numpy(spark, blobs):
    """The penalty is that of C = 1: half the squared coefficients plus the summed log loss."""
    df, x, y = blobs
    t = (y == 1).astype(float)
    got = make_learner("logistic_regression", params={"C": 0.5, "tol": 1e-10}).fit(df.withColumn("label", (F.col("label") == 1).cast("double")))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(3)
    ridge = np.diag([1, 1, 0]) / 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - t) + ridge @ w)
    assert np.allclose(np.append(got.model.coefficients.toArray(), got.model.intercept), w, atol=1e-4)


def test_least_squares_matches_numpy(blobs):
    df, x, y = blobs
    got = make_learner("linear_regression").fit(df).model
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y.astype(float), rcond=None)
    assert np.allclose(np.append(got.coefficients.toArray(), got.intercept), want)


def test_support_vector_regression(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2)) * [1, 50]
    y = 2 * x[:, 0] - 0.1 * x[:, 1] + 3 + rng.normal(size=400) * 0.05
    y[:20] += 100  # outliers pull least squares, not this loss
    df = frame(spark, x, y).repartition(2).cache()
    got = make_learner("svr", params={"kernel": "linear", "C": 1.0, "epsilon": 0.1, "max_iter": 90}).fit(df).model
    assert np.allclose([*got.coefficients, got.intercept], [2, -0.1, 3], atol=0.05)


def test_random_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 3))
    z = np.array([r.features.toArray() for r in RandomFeatures(0.3, 3, 4000).transform(frame(spark, x, np.zeros(20))).orderBy("id").collect()])
    kernel = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.1


def test_importances(spark, blobs):
    df, x, y = blobs
    trained = make_learner("random_forest", "classification", {"n_estimators": 5, "max_depth": 3}).fit(df, ["a", "b"])
    rows = trained.importances(spark).orderBy("position").collect()
    assert [r.feature for r in rows] == ["a", "b"] and sum(r.importance for r in rows) == pytest.approx(1)
    with pytest.raises(NotImplementedError):
        make_learner("linear_regression").fit(df).importances(spark)


def test_fit_without_rows(spark, values):
    with pytest.raises(ValueError, match="no rows"):
        make_learner("linear_regression").fit(values.limit(0))


def test_parameters_are_used_or_refused(spark):
    with pytest.raises(ValueError, match="n_estimatorz"):
        make_learner("random_forest", params={"n_estimatorz": 3}).estimator()
    with pytest.raises(ValueError, match="30"):
        make_learner("random_forest", params={"max_depth": 50}).estimator()
    with pytest.raises(NotImplementedError):
        make_learner("svm", params={"kernel": "poly"}).estimator()
    with pytest.raises(ValueError):
        make_learner("logistic_regression", params={"penalty": "l3"}).estimator()
    with pytest.warns(UserWarning, match="kernel"):
        make_learner("logistic_regression", params={"kernel": "linear"}).estimator()
    share = {p: make_learner("logistic_regression", params={"penalty": p, "l1_ratio": 0.25}).estimator().getElasticNetParam() for p in ("l1", "l2", "elasticnet")}
    assert share == {"l1": 1.0, "l2": 0.0, "elasticnet": 0.25}


def test_l1_drops_a_weak_column(spark):
    rows = [(Vectors.dense([float(i % 2), float(i % 3)]), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"])
    coefficients = make_learner("logistic_regression", params={"penalty": "l1", "C": 0.1}).fit(df).model.coefficients
    assert coefficients[1] == 0.0 and coefficients[0] > 0


def test_svr_reaches_the_optimum(spark):
    """One column, against a search over slope and intercept."""
    x, y = np.arange(24) / 8 - 1.5, np.array([((7 * i) % 11) / 3 + i / 6 for i in range(24)])
    df = spark.createDataFrame([(Vectors.dense([a]), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"])
    model = make_learner("svr", params={"kernel": "linear"}).fit(df).model

    def loss(w, b):
        return w * w / 2 + np.maximum(np.abs(y - w * x - b) - 0.1, 0).sum()

    best = min(loss(w, b) for w in np.linspace(-3, 5, 161) for b in np.linspace(-1, 6, 141))
    assert loss(model.coefficients[0], model.intercept) <= best * 1.002


def test_linear_model_beyond_the_exact_solver(spark):
    from tablewright.operators.svm import linear_model

    wanted = np.sin(np.arange(5000.0))
    got = linear_model(spark.range(1), wanted, 2.5)
    assert np.abs(got.coefficients.toArray() - wanted).max() == 0 and got.intercept == 2.5
    x = spark.createDataFrame([(Vectors.dense(np.ones(5000)),)], ["features"])
    assert abs(got.transform(x).first().prediction - wanted.sum() - 2.5) < 1e-9
