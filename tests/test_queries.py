"""Every query with an SQL twin gives the same rows as DuckDB; the others run and keep their invariants."""

import pytest

import __spark_entry__ as driver
from queries import modelling
from tablewright.operators.boosting import DEFAULTS
from tablewright.operators.models import make_learner
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["metric", "value"]


def test_gbt_classify_boosts_all_rounds(spark, tmp_path, monkeypatch):
    """The query asks for the library's full-size model, not for a single tree."""

    class Made(Exception):
        pass

    def make(*a):
        raise Made(make_learner(*a))

    spark.sql("SELECT id AS l_orderkey, id % 50 AS l_quantity, IF(id % 3 = 0, 'A', 'N') AS l_returnflag, IF(id % 2 = 0, 'F', 'O') AS l_linestatus FROM range(60)").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(modelling, "make_learner", make)
    with pytest.raises(Made) as e:
        QUERIES["gbt_classify"](spark, str(tmp_path))
    model = e.value.args[0].estimator()
    assert (model.getMaxIter(), model.getStepSize(), model.getMaxDepth()) == tuple(DEFAULTS[k] for k in ("n_estimators", "learning_rate", "max_depth"))
