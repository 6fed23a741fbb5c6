"""Corpus queries with an SQL twin give the same rows as DuckDB; the others are held against brute force in their own files."""

import pytest

import __spark_entry__ as driver
from tablewright.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], SF) is None
