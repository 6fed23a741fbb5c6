"""Profiles and contract checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import HOLED, feature, holed_orders, query, rnd, spec, sql_hash, table
from tablewright.operators.contract import check, drop_null_target, project, quarantine
from tablewright.operators.profile import class_distribution, numeric_stats, summary, top_values
from tablewright.operators.split import stratified_split

HOLED_TYPES = {
    "o_orderkey": "bigint", "price": "double", "cust": "bigint", "priority": "string",
    "placed": "timestamp_ntz", "flag": "string", "status": "string",
}


def _union(lines: list[str]) -> str:
    return "\nUNION ALL ".join(lines)


@query(
    "profile_summary",
    f"WITH {HOLED} "
    + _union(
        [
            f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, count(*) AS rows, count(*) - count({c}) AS missing,
round((count(*) - count({c})) / count(*) * 100, 6) + 0.0 AS missing_pct, count(DISTINCT {c}) AS "distinct" FROM holed"""
            for i, (c, t) in enumerate(HOLED_TYPES.items())
        ]
    ),
)
def profile_summary(spark, sf_dir):
    return summary(holed_orders(spark, sf_dir)).withColumn("missing_pct", rnd("missing_pct"))


@query(
    "profile_numeric",
    f"WITH {HOLED} "
    + _union(
        [
            f"""SELECT '{c}' AS "column", min({c}) + 0.0::DOUBLE AS low, max({c}) + 0.0::DOUBLE AS high, round(avg({c}), 6) + 0.0 AS mean,
round(stddev_samp({c}), 6) + 0.0 AS std, count(*) - count({c}) AS missing, round((count(*) - count({c})) / count(*) * 100, 6) + 0.0 AS missing_pct FROM holed"""
            for c in ("o_orderkey", "price", "cust")
        ]
    ),
)
def profile_numeric(spark, sf_dir):
    stats = numeric_stats(holed_orders(spark, sf_dir))
    return stats.withColumns({c: rnd(c) for c in ("mean", "std", "missing_pct")})


@query(
    "profile_topk",
    f"WITH {HOLED}, long AS ("
    + _union([f"SELECT '{c}' AS \"column\", {c} AS value FROM holed" for c in ("priority", "flag", "status")])
    + """), counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank, count(*) OVER (PARTITION BY "column") AS "distinct"
FROM counts QUALIFY rank <= 5""",
)
def profile_topk(spark, sf_dir):
    return top_values(holed_orders(spark, sf_dir)).withColumn("rank", F.col("rank").cast("long"))


STRATIFIED = f"""counts AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS t FROM counts),
base AS (SELECT s, counts.n * t // total.n AS b, counts.n * t % total.n AS r, t FROM counts, total),
quota AS (SELECT s, b + CASE WHEN row_number() OVER (ORDER BY r DESC, s) <= t - sum(b) OVER () THEN 1 ELSE 0 END AS q FROM base),
sided AS (SELECT orders.*, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash("o_orderkey")}, CAST(o_orderkey AS VARCHAR)) <= q
  THEN 'test' ELSE 'train' END AS split FROM orders JOIN quota ON s = o_orderstatus)"""


@query(
    "class_distribution",
    f"""WITH {STRATIFIED} SELECT split, o_orderstatus AS label, count(*) AS n,
round(count(*) / sum(count(*)) OVER (PARTITION BY split) * 100, 6) + 0.0 AS pct FROM sided GROUP BY 1, 2""",
)
def class_shares(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    sides = stratified_split(o, "o_orderstatus", 0.2, "o_orderkey").withColumnRenamed("o_orderstatus", "label")
    return class_distribution(sides).withColumn("pct", rnd("pct"))


# A table with entries that break their column's contract, by rules on the key.
def dirty_orders(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 50 == 0, "twenty").when(k % 9 != 0, F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 60 == 0, "soon").when(k % 8 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("placed"),
        F.when(k % 70 == 0, "true").when(k % 2 == 0, "True").otherwise("0").alias("flag"),
        F.when(k % 90 != 0, F.when(k % 2 == 0, "1").otherwise("False")).alias("flag2"),
        "o_totalprice",
        "o_orderstatus",
        F.col("o_custkey").alias("amount"),
    )


DIRTY = """dirty AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 50 = 0 THEN 'twenty' WHEN o_orderkey % 9 != 0 THEN CAST(o_custkey AS VARCHAR) END AS cust,
  CASE WHEN o_orderkey % 60 = 0 THEN 'soon' WHEN o_orderkey % 8 != 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS placed,
  CASE WHEN o_orderkey % 70 = 0 THEN 'true' WHEN o_orderkey % 2 = 0 THEN 'True' ELSE '0' END AS flag,
  CASE WHEN o_orderkey % 90 != 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE 'False' END END AS flag2,
  o_totalprice, o_orderstatus, o_custkey AS amount FROM orders)"""


def _check_sql(rule: str, column: str, n_bad: str, ok: str | None = None) -> str:
    return f"""WITH {DIRTY}, c AS (SELECT CAST({n_bad} AS BIGINT) AS n_bad FROM dirty)
SELECT '{rule}' AS rule, '{column}' AS "column", n_bad, {ok or "n_bad = 0"} AS ok FROM c"""


def _checked(name: str, features: list[dict], sql: str, target=("o_totalprice", "continuous"), strict: bool = True):
    def run(spark, sf_dir):
        return check(dirty_orders(spark, sf_dir), spec(features, target), strict=strict)

    query(name, sql)(run)


NO_BAD = "UNION ALL SELECT '{}', '{}', CAST(0 AS BIGINT), true"
TARGET = NO_BAD.format("target", "o_totalprice")
NOT_A_NUMBER = "count(*) FILTER (cust IS NOT NULL AND TRY_CAST(cust AS DOUBLE) IS NULL)"

_checked("check_numeric", [feature("cust", "numeric", nullable=True)], f"{_check_sql('numeric', 'cust', NOT_A_NUMBER)} {TARGET}")
_checked("check_datetime", [feature("placed", "datetime", nullable=True)], _check_sql("datetime", "placed", "count(*) FILTER (placed IS NOT NULL AND TRY_CAST(placed AS TIMESTAMP) IS NULL)") + f" {TARGET}")
_checked("check_boolean", [feature("flag", "boolean"), feature("flag2", "boolean")],
    f"""WITH {DIRTY} SELECT 'boolean' AS rule, 'flag' AS "column", count(*) FILTER (flag IS NULL OR flag NOT IN ('True','False','1','0')) AS n_bad, n_bad = 0 AS ok FROM dirty
UNION ALL SELECT 'boolean', 'flag2', count(*) FILTER (flag2 IS NULL OR flag2 NOT IN ('True','False','1','0')) AS n_bad, n_bad = 0 FROM dirty {TARGET}""")  # fmt: skip
_checked("check_nullable", [feature("cust", "numeric", nullable=True), feature("amount", "numeric", nullable=True)],
    f"""WITH {DIRTY} SELECT 'numeric' AS rule, 'cust' AS "column", CASE WHEN count(*) > count(cust) THEN 0 ELSE {NOT_A_NUMBER} END AS n_bad, n_bad = 0 AS ok FROM dirty
{NO_BAD.format('numeric', 'amount')} {TARGET}""", strict=False)  # fmt: skip
_checked("check_binary_target", [feature("amount", "numeric")], _check_sql("binary_target", "o_orderstatus", "count(DISTINCT o_orderstatus)", "n_bad <= 2") + " " + NO_BAD.format("numeric", "amount"), ("o_orderstatus", "binary"))
_checked("check_constraints", [feature("amount", "numeric", constraints={"min": 5, "max": 1000}), feature("cust", "numeric", nullable=True, constraints={"min": 0, "max": 500})],
    f"""WITH {DIRTY} SELECT 'constraint' AS rule, 'amount' AS "column", count(*) FILTER (amount < 5 OR amount > 1000) AS n_bad, n_bad = 0 AS ok FROM dirty
UNION ALL SELECT 'constraint', 'cust', count(*) FILTER (TRY_CAST(cust AS DOUBLE) < 0 OR TRY_CAST(cust AS DOUBLE) > 500) AS n_bad, n_bad = 0 FROM dirty
UNION ALL SELECT 'numeric', 'cust', {NOT_A_NUMBER} AS n_bad, n_bad = 0 FROM dirty {NO_BAD.format('numeric', 'amount')} {TARGET}""")  # fmt: skip
_checked("check_target", [feature("amount", "numeric")], f"{_check_sql('target', 'cust', NOT_A_NUMBER)} {NO_BAD.format('numeric', 'amount')}", ("cust", "continuous"))

QUARANTINE_SPEC = spec(
    [
        feature("cust", "numeric", nullable=True),
        feature("placed", "datetime", nullable=True),
        feature("flag", "boolean"),
        feature("flag2", "boolean", nullable=True),
        feature("amount", "numeric", constraints={"min": 5}),
    ]
)
QUARANTINE_SQL = f"""WITH {DIRTY} SELECT o_orderkey, concat_ws(',', CASE WHEN cust IS NOT NULL AND TRY_CAST(cust AS DOUBLE) IS NULL THEN 'numeric:cust' END,
  CASE WHEN placed IS NOT NULL AND TRY_CAST(placed AS TIMESTAMP) IS NULL THEN 'datetime:placed' END,
  CASE WHEN flag IS NULL OR flag NOT IN ('True','False','1','0') THEN 'boolean:flag' END,
  CASE WHEN flag2 NOT IN ('True','False','1','0') THEN 'boolean:flag2' END,
  CASE WHEN amount < 5 THEN 'constraint:amount' END) AS broken FROM dirty"""


@query("quarantine", QUARANTINE_SQL)
def quarantined(spark, sf_dir):
    good, bad = quarantine(dirty_orders(spark, sf_dir), QUARANTINE_SPEC)
    return bad.select("o_orderkey", F.concat_ws(",", "broken_rules").alias("broken")).unionByName(good.select("o_orderkey", F.lit("").alias("broken")))


@query(
    "project_features",
    "SELECT l_shipdate::DATE::VARCHAR AS l_shipdate, l_quantity, l_returnflag, l_extendedprice FROM lineitem",
)
def projected(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    wanted = spec([feature("l_shipdate", "datetime"), feature("l_quantity", "numeric"), feature("l_returnflag", "categorical")], ("l_extendedprice", "continuous"))
    return project(li, wanted).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("drop_null_target", f"WITH {HOLED} SELECT o_orderkey, status FROM holed WHERE status IS NOT NULL")
def target_rows(spark, sf_dir):
    rows = drop_null_target(holed_orders(spark, sf_dir), spec([feature("price", "numeric")], ("status", "multiclass")))
    return rows.select("o_orderkey", "status")
