import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright import score, sweep, train, train_iterations
from tablewright.functions.storage import new_path
from tablewright.plans.train import load_trained
from tablewright.sources.runs import read_runs
from tablewright.streaming.score import quarantine_stream, score_stream
from tests.conftest import make_spec

FEATURES = [("size", "numeric", "scale"), ("area", "categorical", "one-hot"), ("sold", "datetime", "components"), ("pool", "boolean")]


@pytest.fixture(scope="module")
def houses(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, float(i % 17), "abc"[i % 3], start + dt.timedelta(days=i), str(i % 2), 10.0 * (i % 17) + 5 * (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, size double, area string, sold timestamp, pool string, price double")
    return df.withColumn("dear", F.when(F.col("price") > 85, "yes").otherwise("no")).cache()


PRICE = make_spec(FEATURES, ("price", "continuous"), "regression")
DEAR = make_spec(FEATURES, ("dear", "binary"), "classification")


def test_train_save_score(spark, houses):
    out = new_path(spark, "out")
    got = train(houses, PRICE, "linear_regression", key="id", output=out, experiment="houses")
    assert got.metrics["r2"] == pytest.approx(1) and set(got.metrics) == {"rmse", "mae", "r2"}
    run = read_runs(spark, f"{out}/runs").first()
    assert (run.n_samples_trained, run.n_features, run.experiment) == (160, 9, "houses")
    trained, fitted = load_trained(spark, run.model_path)
    want = score(houses, got.trained, got.fitted, ["id"]).orderBy("id").collect()
    assert score(houses, trained, fitted, ["id"]).orderBy("id").collect() == want


def test_classes_come_back_by_name(houses):
    got = train(houses, DEAR, "random_forest", {"model_params": {"n_estimators": 5, "max_depth": 4}}, key="id")
    assert set(got.metrics) == {"accuracy", "f1", "precision", "recall"} and got.metrics["accuracy"] > 0.8
    assert {r.predicted for r in score(houses, got.trained, got.fitted).collect()} == {"yes", "no"}


def test_rows_without_target_and_fit_on_train(houses):
    holed = houses.withColumn("price", F.when(F.col("id") % 10 != 0, F.col("price")))
    got = train(holed, PRICE, "linear_regression", {"fit_on": "train", "cross_validation": True, "cv_folds": 3}, key="id")
    assert got.run["n_samples_trained"] == 144
    assert got.cv.where("metric = 'r2'").first().folds == 3


def test_training_checks_first(houses):
    with pytest.raises(ValueError, match="not compatible"):
        train(houses, PRICE, "logistic_regression")
    with pytest.raises(TypeError, match="size"):
        train(houses.withColumn("size", F.lit("big")), PRICE, "linear_regression")


def test_same_result_however_partitioned(houses):
    a = train(houses, PRICE, "linear_regression", {"test_size": 0.3}, key="id").metrics
    b = train(houses.repartition(7), PRICE, "linear_regression", {"test_size": 0.3}, key="id").metrics
    assert a == pytest.approx(b, abs=1e-6)


def test_tuned_training(houses):
    cfg = {"param_grid": {"n_estimators": [1, 3], "max_depth": [2]}, "tuning_method": "grid", "tuning_folds": 2}
    got = train(houses, PRICE, "random_forest", cfg, key="id", tune_model=True)
    assert got.trained.metadata["tuned_params"]["n_estimators"] in (1, 3)
    with pytest.warns(UserWarning, match="no parameter grid"):
        train(houses, PRICE, "linear_regression", key="id", tune_model=True)


def test_iterations(houses):
    results, table = train_iterations(houses, PRICE, "linear_regression", 3, key="id")
    assert [r.run["iteration"] for r in results] == [1, 2, 3]
    assert {r.metric: r.runs for r in table.collect()} == {"rmse": 3, "mae": 3, "r2": 3}


def test_sweep(houses):
    got = sweep({"price": (houses, PRICE), "dear": (houses, DEAR)}, ["linear_regression", "logistic_regression", "svm"], {"model_params": {"kernel": "linear", "max_iter": 6}}, {"price": "id", "dear": "id"})
    assert got.runs.count() == 4 and got.failures.count() == 0
    best = {(r.experiment, r.metric): r.best_model for r in got.best.collect()}
    assert best[("price", "rmse")] == "linear_regression"
    broken = sweep({"price": (houses.withColumn("size", F.lit("x")), PRICE)}, ["linear_regression"])
    assert broken.failures.first().model_type == "linear_regression" and broken.best.count() == 0


def test_stream_equals_batch(spark, houses):
    got = train(houses, DEAR, "logistic_regression", key="id")
    source = new_path(spark, "arriving")
    houses.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(houses.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out, checkpoint = new_path(spark, "scored"), new_path(spark, "checkpoint")
    score_stream(stream, got.trained, got.fitted, out, checkpoint, ["id"], once=True).awaitTermination()
    want = score(houses, got.trained, got.fitted, ["id"]).orderBy("id").collect()
    assert spark.read.parquet(out).orderBy("id").collect() == want
    score_stream(stream, got.trained, got.fitted, out, checkpoint, ["id"], once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 200


def test_each_event_once(spark, houses):
    got = train(houses, PRICE, "linear_regression", key="id")
    source = new_path(spark, "twice")
    houses.union(houses).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(houses.schema).parquet(source)
    out = new_path(spark, "once")
    score_stream(stream, got.trained, got.fitted, out, new_path(spark, "c"), ["id"], once=True, event_key=["id"], event_time="sold", late="400 days").awaitTermination()
    assert spark.read.parquet(out).count() == 200


def test_stream_goes_on_past_bad_rows(spark):
    """Unreadable numbers, labels never seen and values out of bounds are routed; a batch done again changes nothing."""
    from tablewright.operators.models import make_learner
    from tablewright.operators.transforms import fit_transforms
    from tests.conftest import make_spec

    known = spark.createDataFrame([(i, str(i), "abc"[i % 3], float(i)) for i in range(30)], "id long, n string, c string, y double")
    wanted = make_spec([{"name": "n", "type": "numeric", "constraints": {"max": 100}}, ("c", "categorical", "label")], ("y", "continuous"))
    fitted = fit_transforms(known, wanted)
    model = make_learner("linear_regression").fit(fitted.transform(known, label="label"), fitted.feature_names)
    rows = [(1, "5", "a"), (2, "x", "a"), (3, "7", "z"), (4, "y", "z"), (5, "900", "b"), (6, "8", "c")]
    source, base = new_path(spark, "mixed"), new_path(spark, "routed")
    spark.createDataFrame(rows, "id long, n string, c string").repartition(2).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("id long, n string, c string").option("maxFilesPerTrigger", 1).parquet(source)
        score_stream(stream, model, fitted, f"{base}/good", f"{base}/c{_}", ["id"], once=True, bad=f"{base}/bad").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{base}/good").collect()) == [1, 6]
    bad = {r.id: r.problems for r in spark.read.parquet(f"{base}/bad").collect()}
    assert bad == {2: ["numeric:n"], 3: ["unseen:c"], 4: ["numeric:n", "unseen:c"], 5: ["constraint:n"]}


def test_stream_quarantine(spark, houses):
    source = new_path(spark, "dirty")
    houses.withColumn("pool", F.when(F.col("id") % 4 == 0, "maybe").otherwise(F.col("pool"))).repartition(2).write.parquet(source)
    stream = spark.readStream.schema(houses.schema).option("maxFilesPerTrigger", 1).parquet(source)
    base = new_path(spark, "quarantine")
    quarantine_stream(stream, PRICE, f"{base}/good", f"{base}/bad", f"{base}/c", once=True).awaitTermination()
    assert spark.read.parquet(f"{base}/good").count() == 150
    bad = spark.read.parquet(f"{base}/bad")
    assert bad.count() == 50 and bad.first().broken_rules == ["boolean:pool"]
