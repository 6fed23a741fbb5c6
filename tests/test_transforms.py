import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.operators import stats, transforms
from tablewright.operators.text import fit_vocabulary
from tablewright.operators.transforms import FittedTable, fit_transforms
from tests.conftest import make_spec

CUSTOMER = [("age", "numeric", "scale"), ("income", "numeric", "minmax"), ("category", "categorical", "one-hot"), ("description", "text", "tfidf")]


def matrix(df, order):
    return np.array([r.features.toArray() for r in df.orderBy(order).select("features").collect()])


def test_customer_table(customers):
    fitted = fit_transforms(customers, make_spec(CUSTOMER))
    m = matrix(fitted.transform(customers, label="label"), "age")
    r = math.sqrt(0.5)
    assert np.allclose(m[:, 0], [-2 * r, -r, 0, r, 2 * r])
    assert np.allclose(m[:, 1], [0, 0.25, 0.5, 0.75, 1])
    assert np.array_equal(m[:, 2:5], [[1, 0, 0], [0, 1, 0], [1, 0, 0], [0, 0, 1], [0, 1, 0]])
    assert fitted.feature_names[:5] == ["age", "income", "category=A", "category=B", "category=C"]
    assert np.allclose(np.linalg.norm(m[:, 5:], axis=1), 1)
    labels = [x.label for x in fitted.transform(customers, label="label").orderBy("age").collect()]
    assert labels == [0, 1, 0, 1, 0]


def test_tfidf_by_hand(spark):
    texts = ["Red red fox", "fox! a b", "", None, "été_1 fox"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("target", F.lit(1))
    fitted = fit_transforms(df, make_spec([("t", "text")]))
    assert fitted.fitted["t"].terms == ["fox", "red", "été_1"]
    m = matrix(fitted.transform(df), "id")
    idf = {"fox": math.log(6 / 4) + 1, "red": math.log(6 / 2) + 1, "été_1": math.log(6 / 2) + 1}
    first = np.array([idf["fox"], 2 * idf["red"], 0])
    assert np.allclose(m[0], first / np.linalg.norm(first))
    assert np.allclose(m[1], [1, 0, 0])
    assert not m[2].any() and not m[3].any()
    counts = fit_transforms(df, make_spec([("t", "text", "count")])).transform(df)
    assert np.array_equal(matrix(counts, "id")[0], [1, 2, 0])


def test_vocabulary_cut_and_ties(spark):
    df = spark.createDataFrame([("bb aa cc cc",), ("dd",)], "t string")
    assert fit_vocabulary(df, F.col("t"), 2).terms == ["aa", "cc"]
    assert fit_vocabulary(df, F.col("t"), 100, min_df=1).containing == [1, 1, 1, 1]
    with pytest.raises(ValueError, match="empty vocabulary"):
        fit_vocabulary(df, F.col("t"), 2, min_df=2)


def test_imputation(spark):
    rows = [(1.0, 3, "b"), (2.0, 3, "a"), (3.0, 1, "b"), (10.0, 1, "a"), (None, None, None), (float("nan"), 7, None)]
    df = spark.createDataFrame(rows, "x double, k long, c string").withColumn("id", F.monotonically_increasing_id()).withColumn("target", F.lit(1))

    def fill(name, kind, how):
        return fit_transforms(df, make_spec([(name, kind, how)])).fitted[name].fill

    assert fill("x", "numeric", None) == 4.0
    assert fill("x", "numeric", "impute_median") == 2.5
    assert fill("x", "numeric", {"imputation": "constant"}) == 0.0
    assert fill("k", "numeric", "impute_mode") == 1.0
    assert fill("c", "categorical", "label") == "a"
    assert fill("c", "categorical", {"imputation": "constant"}) == "missing_value"
    assert fill("k", "categorical", {"imputation": "constant"}) == "0"
    assert fit_transforms(df, make_spec([("c", "categorical", {"imputation": "constant"})])).fitted["c"].categories == ["a", "b", "missing_value"]


def test_scaling_after_imputation(spark):
    values = [1.0, 2.0, None, 9.0, None, 4.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double").withColumn("target", F.lit(1))
    for how, fill in (({"scaling": "standard"}, 4.0), ({"imputation": "constant", "scaling": "standard"}, 0.0), ({"imputation": "median", "scaling": "standard"}, 3.0)):
        full = np.array([fill if v is None else v for v in values])
        m = matrix(fit_transforms(df, make_spec([("x", "numeric", how)])).transform(df), "id")[:, 0]
        assert np.allclose(m, (full - full.mean()) / full.std())
    low = matrix(fit_transforms(df, make_spec([("x", "numeric", {"imputation": "constant", "scaling": "minmax"})])).transform(df), "id")[:, 0]
    assert np.allclose(low, np.array([1, 2, 0, 9, 0, 4]) / 9)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None, None), (5.0, None, None)], "x double, e double, s string").withColumn("target", F.lit(1))
    for how in ("scale", "minmax"):
        assert not matrix(fit_transforms(df, make_spec([("x", "numeric", how)])).transform(df), "x").any()
    for bad in (("e", "numeric"), ("s", "categorical"), ("s", "datetime"), ("s", "boolean")):
        with pytest.raises(ValueError, match="no values"):
            fit_transforms(df, make_spec([bad]))


def test_numeric_categories_sort_as_numbers(spark):
    df = spark.createDataFrame([(10, 1.5), (2, 10.25), (2, 2.0)], "k int, d double").withColumn("target", F.lit(1))
    fitted = fit_transforms(df, make_spec([("k", "categorical"), ("d", "categorical")], ("k", "multiclass")))
    assert fitted.fitted["k"].categories == ["2", "10"]
    assert fitted.fitted["d"].categories == ["1.5", "2.0", "10.25"]
    assert fitted.classes == ["2", "10"]


def test_unseen_categories(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "c string").withColumn("target", F.lit(1))
    new = spark.createDataFrame([("z",), ("b",)], "c string")
    hot = fit_transforms(seen, make_spec([("c", "categorical", "one-hot")]))
    assert sorted(map(list, matrix(hot.transform(new), "c"))) == [[0, 0], [0, 1]]
    coded = fit_transforms(seen, make_spec([("c", "categorical", "label")]))
    with pytest.raises(Exception, match="[Uu]nseen"):
        coded.transform(new).collect()


def test_several_one_hot_of_different_sizes(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "c string, d string").withColumn("target", F.lit(1))
    fitted = fit_transforms(df, make_spec([("c", "categorical", "one-hot"), ("d", "categorical", "one-hot")]))
    new = spark.createDataFrame([("c", "q")], "c string, d string")
    assert matrix(fitted.transform(new), "c").tolist() == [[0, 0, 1, 0, 0]]


@pytest.mark.parametrize("broadcast", [1_000_000, 1])
def test_vocabularies_as_tables_give_the_same(spark, monkeypatch, broadcast):
    df = spark.createDataFrame([(i, f"v{i * 7 % 50:02d}" if i % 3 else "v00", i % 40) for i in range(300)], "id int, c string, k int")
    df = df.withColumn("target", F.concat(F.lit("t"), F.col("k") % 4))
    spec = make_spec([("c", "categorical", "one-hot"), ("k", "categorical", "label")], ("target", "multiclass"))
    want = fit_transforms(df, spec).transform(df, label="label")
    monkeypatch.setattr(transforms, "CONSTANT_VOCABULARY", 2)
    monkeypatch.setattr(transforms, "BROADCAST_VOCABULARY", broadcast)
    monkeypatch.setattr(transforms, "HOT_CATEGORIES", 3)
    fitted = fit_transforms(df, spec)
    assert set(fitted.tables) == {"c", "k", transforms.TARGET}
    path = new_path(spark, "pre")
    fitted.save(spark, path)
    for f in (fitted, FittedTable.load(spark, path)):
        got = f.transform(df, label="label")
        assert np.array_equal(matrix(got, "id"), matrix(want, "id"))
        assert [r.label for r in got.orderBy("id").collect()] == [r.label for r in want.orderBy("id").collect()]
        back = f.original_label(got, "label", "name").where("name != target").count()
        assert back == 0


def test_long_texts_are_not_held_as_constants(spark, monkeypatch):
    df = spark.createDataFrame([("x" * 50,), ("y" * 50,)], "c string").withColumn("target", F.lit(1))
    monkeypatch.setattr(transforms, "CONSTANT_CHARS", 99)
    fitted = fit_transforms(df, make_spec([("c", "categorical", "label")]))
    assert "c" in fitted.tables and fitted.fitted["c"].chars == 100
    assert sorted(matrix(fitted.transform(df), "c")[:, 0]) == [0, 1]


def test_datetime(spark):
    rows = [(1, dt.datetime(2024, 2, 29, 23, 59, 59, 900000)), (2, None), (3, dt.datetime(1969, 12, 31, 23, 59, 58, 500000)), (4, dt.datetime(2024, 2, 29, 23, 59, 59, 900000))]
    df = spark.createDataFrame(rows, "id int, t timestamp").withColumn("target", F.lit(1))
    parts = fit_transforms(df, make_spec([("t", "datetime", "components")]))
    assert parts.feature_names == ["t_year", "t_month", "t_day", "t_dayofweek"]
    assert matrix(parts.transform(df), "id")[:2].tolist() == [[2024, 2, 29, 3], [2024, 2, 29, 3]]
    epoch = matrix(fit_transforms(df, make_spec([("t", "datetime")])).transform(df), "id")[:, 0]
    assert epoch.tolist() == [1709251199, 1709251199, -2, 1709251199]
    text = spark.createDataFrame([(1, "2024-03-01"), (2, "2024-03-01 10:00:00")], "id int, t string").withColumn("target", F.lit(1))
    assert matrix(fit_transforms(text, make_spec([("t", "datetime")])).transform(text), "id")[:, 0].tolist() == [1709251200, 1709287200]


def test_boolean(spark):
    df = spark.createDataFrame([(1, "True"), (2, "0"), (3, None), (4, "1")], "id int, f string").withColumn("target", F.lit(1))
    fitted = fit_transforms(df, make_spec([("f", "boolean")]))
    assert matrix(fitted.transform(df), "id")[:, 0].tolist() == [1, 0, 1, 1]
    with pytest.raises(Exception, match="not boolean"):
        fitted.transform(spark.createDataFrame([("maybe",)], "f string")).collect()


def test_unreadable_values_stop_the_job(spark):
    seen = spark.createDataFrame([("1.5", "2024-01-01"), ("2", None)], "x string, t string").withColumn("target", F.lit(1))
    fitted = fit_transforms(seen, make_spec([("x", "numeric"), ("t", "datetime")]))
    assert fitted.transform(spark.createDataFrame([(None, "2024-01-05")], "x string, t string")).first().features[0] == 1.75
    for bad in (("x1", None), ("1", "soon")):
        with pytest.raises(Exception, match="is not"):
            fitted.transform(spark.createDataFrame([bad], "x string, t string")).collect()


def test_names_that_meet(spark):
    """Parts of a date do not mix with a feature of the same name, and names may hold dots."""
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1), 7.0, "a")], "t timestamp, t_year double, `c.d` string").withColumn("target", F.lit(1))
    fitted = fit_transforms(df, make_spec([("t", "datetime", "components"), ("t_year", "numeric"), ("c.d", "categorical", "one-hot")]))
    assert fitted.transform(df).first().features.toArray().tolist() == [2024, 5, 1, 2, 7, 1]


def test_exact_median_by_brackets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.round(rng.lognormal(3, 2, 20_000), 3)
    y = np.where(rng.random(20_000) < 0.4, 5.0, rng.normal(5, 1, 20_000))  # one value holds the middle
    z = np.concatenate([np.full(10_000, -1e9), rng.random(10_000) * 1e9])  # the middle lies in a gap
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), z.tolist(), strict=True)), "x double, y double, z double").repartition(4).cache()
    monkeypatch.setattr(stats, "EXACT_BUFFER_VALUES", 30)
    cols = {c: F.col(c) for c in "xyz"}
    got = stats.exact_medians(df, cols, stats.moments(df, cols, sketch="xyz"))
    assert got == pytest.approx({"x": np.median(x), "y": np.median(y), "z": np.median(z)}, abs=0)


def test_save_and_load(spark, customers):
    fitted = fit_transforms(customers, make_spec(CUSTOMER))
    path = new_path(spark, "pre")
    fitted.save(spark, path)
    loaded = FittedTable.load(spark, path)
    assert loaded.fitted == fitted.fitted and loaded.spec == fitted.spec
    assert np.array_equal(matrix(loaded.transform(customers), "age"), matrix(fitted.transform(customers), "age"))


def test_missing_feature_at_scoring(customers):
    fitted = fit_transforms(customers, make_spec(CUSTOMER))
    with pytest.raises(ValueError, match="Missing columns in data: income"):
        fitted.transform(customers.drop("income"))


def test_applying_needs_no_shuffle(customers):
    plan = fit_transforms(customers, make_spec(CUSTOMER)).transform(customers)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
