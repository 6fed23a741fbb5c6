"""Registration of queries with their SQL twins, and the helpers both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.spec import TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(col: Column | str, digits: int = 6) -> Column:
    """Rounded, with -0.0 made 0.0, so that equal values have equal hashes."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


def sql_hash(key: str, seed: int | str = 42) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|' || CAST({seed} AS VARCHAR)), 1, 8) AS UBIGINT) AS BIGINT)"


def spec(features: list[dict], target: tuple[str, str] = ("o_totalprice", "continuous"), task: str | None = None, **training) -> TableSpec:
    doc: dict = {"features": features, "target": {"name": target[0], "type": target[1]}, "training_params": training}
    if task:
        doc["metadata"] = {"task_type": task}
    return TableSpec.from_dict(doc)


def feature(name: str, kind: str, preprocessing=None, **more) -> dict:
    return {"name": name, "type": kind, **({"preprocessing": preprocessing} if preprocessing else {}), **more}


# Orders with values missing by a rule on the key, the same rule on both sides.
def holed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(k % 5 != 0, F.col("o_custkey") % 40).alias("cust"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(k % 13 != 0, F.col("o_orderdate")).alias("placed"),
        F.when(k % 17 != 0, F.when(k % 3 == 0, "True").when(k % 3 == 1, "0").otherwise("1")).alias("flag"),
        F.when(k % 19 != 0, F.col("o_orderstatus")).alias("status"),
    )


HOLED = """holed AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 != 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 5 != 0 THEN o_custkey % 40 END AS cust,
  CASE WHEN o_orderkey % 11 != 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 13 != 0 THEN o_orderdate END AS placed,
  CASE WHEN o_orderkey % 17 != 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'True' WHEN o_orderkey % 3 = 1 THEN '0' ELSE '1' END END AS flag,
  CASE WHEN o_orderkey % 19 != 0 THEN o_orderstatus END AS status
  FROM orders)"""


def sql_mode(col: str, source: str = "holed") -> str:
    return f"(SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"
