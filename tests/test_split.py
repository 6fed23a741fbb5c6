import hashlib
from collections import Counter
from math import ceil

import pytest
from pyspark.sql import functions as F

from tablewright.operators import split as S


def hashed(keys, seed=42):
    return sorted(keys, key=lambda k: (int(hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], 16), str(k)))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(1003).select(F.col("id"), F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("y"))
    return df.repartition(5).cache()


def test_five_rows(spark):
    out = S.random_split(spark.range(5), 0.2, "id")
    assert Counter(r.split for r in out.collect()) == {"train": 4, "test": 1}


def test_random(rows):
    out = S.random_split(rows, 0.2, "id")
    test = {r.id for r in out.where("split = 'test'").collect()}
    assert test == set(hashed(range(1003))[: ceil(0.2 * 1003)])
    again = S.random_split(rows.repartition(13), 0.2, "id")
    assert {r.id for r in again.where("split = 'test'").collect()} == test
    other = S.random_split(rows, 0.2, "id", seed=7)
    assert {r.id for r in other.where("split = 'test'").collect()} != test


@pytest.mark.parametrize("size,expected", [(0.0, 0), (1.0, 1003), (0.5, 502)])
def test_sizes(rows, size, expected):
    assert S.random_split(rows, size, "id").where("split = 'test'").count() == expected


@pytest.mark.parametrize("literal,broadcast", [(200, 100_000), (0, 100_000), (0, 0)])
def test_stratified(rows, monkeypatch, literal, broadcast):
    monkeypatch.setattr(S, "LITERAL_CUTS", literal)
    monkeypatch.setattr(S, "BROADCAST_CUTS", broadcast)
    out = S.stratified_split(rows, "y", 0.2, "id")
    got = Counter((r.y, r.split) for r in out.collect())
    n_test, sizes = 201, Counter(r.y for r in rows.collect())
    share = {y: sizes[y] * n_test / 1003 for y in sizes}
    want = {y: int(share[y]) for y in sizes}
    for y in sorted(sizes, key=lambda y: (-(share[y] - want[y]), y))[: n_test - sum(want.values())]:
        want[y] += 1
    assert {y: got[(y, "test")] for y in sizes} == want
    assert sum(got.values()) == 1003
    for y in sizes:
        mine = hashed([r.id for r in rows.collect() if r.y == y])
        assert {r.id for r in out.where((F.col("y") == y) & (F.col("split") == "test")).collect()} == set(mine[: want[y]])


def test_stratified_falls_back(spark):
    lone = spark.createDataFrame([(i, "a") for i in range(9)] + [(9, "b")], "id int, y string")
    assert S.stratified_split(lone, "y", 0.2, "id").where("split = 'test'").count() == 2
    small = spark.createDataFrame([(i, i % 3) for i in range(6)], "id int, y int")
    assert S.stratified_split(small, "y", 0.2, "id").where("split = 'test'").count() == 2


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_one_key_holds_most_rows(spark, monkeypatch, limit):
    """A cut inside the rows of one key still gives exact sizes, also when those rows are numbered over salts."""
    monkeypatch.setattr(S, "LOCAL_ROWS", limit)
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id")).alias("key"), F.lit("x").alias("v"), (F.col("id") % 2).alias("y"))
    assert S.random_split(df, 0.3, "key").groupBy("split").count().where("split = 'test'").first()["count"] == 600
    folds = Counter(r.fold for r in S.assign_folds(df, 3, "key").collect())
    assert sorted(folds.values()) == [666, 667, 667]
    both = Counter((r.y, r.split) for r in S.stratified_split(df, "y", 0.3, "key").collect())
    assert both[(0, "test")] == both[(1, "test")] == 300
    monkeypatch.setattr(S, "LITERAL_CUTS", 0)
    joined = Counter((r.y, r.split) for r in S.stratified_split(df, "y", 0.3, "key").collect())
    assert joined == both


def test_identical_rows(spark):
    df = spark.createDataFrame([("same",)] * 50, "v string")
    assert S.random_split(df, 0.25).where("split = 'test'").count() == 13


def test_folds(rows):
    out = S.assign_folds(rows, 4, "id")
    order = hashed(range(1003))
    want = {}
    start = 0
    for f, size in enumerate([251, 251, 251, 250]):
        want.update(dict.fromkeys(order[start : start + size], f))
        start += size
    assert {r.id: r.fold for r in out.collect()} == want
    with pytest.raises(ValueError):
        S.assign_folds(rows, 1, "id")


def test_bulk_is_not_shuffled(spark):
    plan = S.random_split(spark.range(1000), 0.2, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_class_shares_of_very_large_classes(spark):
    """Products of row counts beyond 64 bits."""
    from tablewright.operators.split import class_shares

    counts = {"a": 30_000_000_001, "b": 7_000_000_003, "c": 2}
    n = sum(counts.values())
    n_test = n // 5 + 1
    got = class_shares(spark.createDataFrame(list(counts.items()), "label string, n long"), n, n_test).collect()
    assert {r.label: (r.base, int(r.rest)) for r in got} == {k: divmod(v * n_test, n) for k, v in counts.items()}
