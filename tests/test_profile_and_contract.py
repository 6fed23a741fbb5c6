import pytest

from tablewright.operators.contract import check, project, quarantine, validate
from tablewright.operators.profile import class_distribution, numeric_stats, summary, top_values
from tests.conftest import make_spec


def test_summary(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 2.0, None), (2, None, "x" * 500)], "a long, b double, c string")
    rows = {r.column: r for r in summary(df).collect()}
    assert [(rows[c].missing, rows[c].distinct) for c in "abc"] == [(0, 2), (2, 1), (1, 2)]
    assert rows["b"].missing_pct == pytest.approx(200 / 3)
    assert rows["a"].dtype == "bigint" and rows["a"].rows == 3
    assert {r.column: r.distinct for r in summary(df, approximate=True).collect()} == {"a": 2, "b": 1, "c": 2}


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b double")
    rows = {r.column: r for r in summary(df).collect()}
    assert (rows["b"].missing, rows["b"].distinct) == (2, 0)
    b = next(r for r in numeric_stats(df).collect() if r.column == "b")
    assert (b.low, b.mean, b.missing_pct) == (None, None, 100.0)


def test_top_values(spark):
    values = ["b"] * 3 + ["a"] * 3 + ["c"] * 2 + ["d", "e", "f", None]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values * 3)], "v string, many string")
    got = [(r.value, r.n, r.rank) for r in top_values(df).orderBy("rank").collect()]
    assert got == [("a", 9, 1), ("b", 9, 2), ("c", 6, 3), ("d", 3, 4), ("e", 3, 5)]
    only = spark.createDataFrame([(str(i),) for i in range(100)], "many string")
    assert top_values(only).count() == 0


def test_class_distribution(spark):
    df = spark.createDataFrame([("train", 0), ("train", 0), ("train", 1), ("test", 1)], "split string, label int")
    got = {(r.split, r.label): (r.n, round(r.pct, 1)) for r in class_distribution(df).collect()}
    assert got == {("train", 0): (2, 66.7), ("train", 1): (1, 33.3), ("test", 1): (1, 100.0)}
    many = spark.createDataFrame([("train", i) for i in range(25)], "split string, label int")
    assert class_distribution(many).count() == 0


SPEC = [("age", "numeric"), ("category", "categorical")]


@pytest.fixture
def ages(spark):
    return spark.createDataFrame([(25, "A", 0), (30, "B", 1), (35, "A", 0), (40, "C", 1), (45, "B", 0)], "age long, category string, target long")


def test_valid(ages):
    assert validate(ages, make_spec(SPEC))


def test_missing_column(ages):
    with pytest.raises(ValueError, match="Missing columns in data: category"):
        validate(ages.drop("category"), make_spec(SPEC))
    with pytest.raises(ValueError, match="Missing"):
        project(ages.drop("age"), make_spec(SPEC))


def test_wrong_types(spark, ages):
    words = spark.createDataFrame([("twenty", "A", 0), ("1e3", "B", 1), ("1d", "B", 1)], "age string, category string, target long")
    with pytest.raises(TypeError, match="age"):
        validate(words, make_spec(SPEC))
    assert check(words, make_spec(SPEC)).where("rule = 'numeric'").first().n_bad == 2
    many = ages.withColumn("target", ages.age)
    with pytest.raises(ValueError, match="5 classes"):
        validate(many, make_spec(SPEC))
    with pytest.raises(TypeError, match="regression"):
        validate(words, make_spec([("category", "categorical")], ("age", "continuous")))


def test_booleans(spark):
    df = spark.createDataFrame([("True",), ("0",), ("true",), (None,)], "f string").selectExpr("f", "1 AS target")
    spec = make_spec([("f", "boolean")])
    assert check(df, spec).where("rule = 'boolean'").first().n_bad == 2
    assert check(df, spec, lenient=True).where("rule = 'boolean'").first().n_bad == 1
    native = spark.createDataFrame([(True, 1, 2.0), (False, 0, 1.0)], "a boolean, b int, c double").selectExpr("*", "1 AS target")
    bad = {r.column: r.n_bad for r in check(native, make_spec([("a", "boolean"), ("b", "boolean"), ("c", "boolean")])).collect()}
    assert (bad["a"], bad["b"], bad["c"]) == (0, 0, 1)


def test_nullable(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string").selectExpr("a", "1 AS target")
    spec = make_spec([{"name": "a", "type": "numeric", "nullable": True}])
    assert check(df, spec).first().n_bad == 1
    assert check(df, spec, strict=False).first().n_bad == 0


def test_quarantine(spark):
    df = spark.createDataFrame([(5, "2024-01-01"), (500, "2024-01-01"), (7, "soon"), (None, None)], "a long, t string").selectExpr("*", "1 AS target")
    spec = make_spec([{"name": "a", "type": "numeric", "constraints": {"min": 0, "max": 100}}, ("t", "datetime")])
    good, bad = quarantine(df, spec)
    assert good.count() == 2
    assert {tuple(r.broken_rules) for r in bad.collect()} == {("constraint:a",), ("datetime:t",)}
    assert {(r.rule, r.column): r.n_bad for r in check(df, spec).collect()}[("constraint", "a")] == 1


def test_dates_that_are_not_iso(spark):
    from tablewright.functions.columns import as_time

    rows = ["01/15/2020", "15 Jan 2020", "January 15, 2020", "2020/01/15", "20200115", "1/15/2020 0:0", "2020-01-15", "soon", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = [r.x for r in df.select(as_time(df, "t").cast("date").cast("string").alias("x")).collect()]
    assert got == ["2020-01-15"] * 7 + [None, None]


def test_rows_with_nested_maps_have_an_identity(spark):
    from pyspark.sql import functions as F

    from tablewright.functions.columns import key_text

    df = spark.range(3).select("id", F.array(F.create_map(F.lit("a"), "id")).alias("m"))
    assert df.select(key_text(df, None)).distinct().count() == 3
