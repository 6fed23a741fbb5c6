import json

import pytest
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.sources.files import read_csv, read_table, sample_rows, spread
from tablewright.sources.runs import append_runs, best_runs, list_runs, read_runs, run_row, runs_frame
from tablewright.spec import TableSpec, check_model_fits, list_models, load_spec, merged_config
from tests.conftest import make_spec

DOC = {
    "features": [
        {"name": "age", "type": "numeric", "preprocessing": "scale", "constraints": {"min": 0}},
        {"name": "city", "type": "categorical", "preprocessing": {"imputation": "constant", "encoding": "one-hot"}, "nullable": True},
    ],
    "target": {"name": "y", "type": "binary"},
    "metadata": {"task_type": "classification"},
    "training_params": {"test_size": 0.3},
}


def test_spec_roundtrip_and_file(spark, tmp_path):
    spec = TableSpec.from_dict(DOC)
    assert TableSpec.from_dict(spec.to_dict()) == spec
    (tmp_path / "spec.json").write_text(json.dumps(DOC, indent=2))
    assert load_spec(spark, str(tmp_path / "spec.json")) == spec
    assert [f.kind for f in spec.features] == ["standard", "onehot"]
    assert [f.imputation for f in spec.features] == ["mean", "constant"]


@pytest.mark.parametrize(
    "change",
    [
        {"features": [{"name": "age"}]},
        {"features": [{"name": "age", "type": "number"}]},
        {"target": {"name": "y", "type": "ordinal"}},
        {"training_params": {"test_size": 1.5}},
        {"training_params": {"cv_folds": 1}},
        {"training_params": {"stratify": "yes"}},
        {"metadata": {"task_type": "ranking"}},
    ],
)
def test_bad_spec(change):
    with pytest.raises(ValueError, match="Invalid specification"):
        TableSpec.from_dict({**DOC, **change})


def test_parameter_without_effect_is_named():
    with pytest.warns(UserWarning, match="normalize_target"):
        TableSpec.from_dict({**DOC, "training_params": {"normalize_target": True}})


def test_config_order():
    cfg = merged_config(TableSpec.from_dict(DOC), {"random_state": 7})
    assert (cfg["test_size"], cfg["random_state"], cfg["cv_folds"]) == (0.3, 7, 5)
    assert merged_config(TableSpec.from_dict(DOC), {"test_size": 0.1})["test_size"] == 0.1


def test_model_compatibility():
    spec = TableSpec.from_dict(DOC)
    check_model_fits("Random_Forest", spec)
    with pytest.raises(ValueError, match="not compatible"):
        check_model_fits("linear_regression", spec)
    with pytest.raises(ValueError, match="Unknown task"):
        check_model_fits("xgboost", make_spec([("a", "numeric")]))
    assert set(list_models()) == {"classification", "regression"}


def test_csv(spark, people, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('id,name,age,score,note,flag\n1,Alice,25,90.5,"said ""hi"",\nleft",True\n2,N/A,,85,plain,False\n3,null,35,NaN,"",True\n')
    df = read_table(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "age": "bigint", "score": "double", "note": "string", "flag": "boolean"}
    rows = df.orderBy("id").collect()
    assert rows[0].note == 'said "hi",\nleft'
    assert (rows[1].name, rows[1].age, rows[2].name, rows[2].score, rows[2].note) == (None, None, None, None, None)
    raw = read_csv(spark, str(path), infer=False, na_values=())
    assert {t for _, t in raw.dtypes} == {"string"}
    semicolons = tmp_path / "other.csv"
    semicolons.write_text("a;b\n1;x\n")
    assert read_table(spark, str(semicolons), sep=";").first().b == "x"


def test_csv_equals_table(spark, people):
    path = new_path(spark, "people") + ".csv"
    people.write.option("header", True).csv(path)
    assert sorted(read_table(spark, path).collect()) == sorted(people.collect())


def test_json_and_parquet(spark, people, tmp_path):
    (tmp_path / "people.json").write_text(json.dumps([r.asDict() for r in people.collect()]))
    assert sorted(read_table(spark, str(tmp_path / "people.json")).select(people.columns).collect()) == sorted(people.collect())
    path = new_path(spark, "people") + ".pq"
    people.write.parquet(path)
    assert sorted(read_table(spark, path).collect()) == sorted(people.collect())


def test_unreadable(spark, tmp_path):
    (tmp_path / "people.txt").write_text("x")
    with pytest.raises(ValueError, match="Unsupported file format"):
        read_table(spark, str(tmp_path / "people.txt"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "nothing.csv"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "nothing.parquet"))


def test_sample(spark, people):
    three = sample_rows(people, 3, "id")
    assert three.count() == 3
    assert sorted(three.collect()) == sorted(sample_rows(people.repartition(5), 3, "id").collect())
    assert sample_rows(people, 10).count() == 5
    assert sample_rows(people.union(people), 7).count() == 7


def test_spread(spark):
    one = spark.range(20_000).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 20_000, 1, 32)
    assert spread(many) is many


def test_run_log(spark):
    meta = {"model_type": "random_forest", "task_type": "regression", "hyperparameters": {"n_estimators": 5}, "performance_history": [{"metrics": {"r2": 0.1}, "timestamp": 1.0, "epoch": 3}]}
    path = new_path(spark, "runs")
    rows = [run_row("a", meta, {"rmse": 2.0, "r2": 0.5}), run_row("a", meta, {"rmse": 1.0, "r2": 0.4}, 2), run_row("b", meta, {"rmse": 3.0})]
    for r in rows:
        append_runs(runs_frame(spark, [r]), path)
    runs = read_runs(spark, path)
    assert runs.count() == 3
    assert runs.where("experiment = 'b'").first().history[0].epoch == 3
    latest = {r.experiment: r.iteration for r in list_runs(runs).collect()}
    assert latest == {"a": 2, "b": 1}
    best = {r.metric: r.value for r in best_runs(runs).collect()}
    assert best == {"rmse": 1.0, "r2": 0.5}
    assert runs.select(F.max("hyperparameters.n_estimators")).first()[0] == "5"
