"""Splits, metrics on rule-based predictions, and summaries of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import query, rnd, sql_hash, table
from queries.profiling import STRATIFIED
from queries.sources import RUNS, logged_runs
from tablewright.operators.metrics import classification_metrics, detect_task, regression_metrics
from tablewright.operators.selection import compare_models, iteration_summary, suggest_improvements
from tablewright.operators.split import assign_folds, random_split, stratified_split

RANKED = f"ranked AS (SELECT *, row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, CAST(o_orderkey AS VARCHAR)) - 1 AS r, count(*) OVER () AS n FROM orders)"


@query("split_random", f"WITH {RANKED} SELECT o_orderkey, CASE WHEN r < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ranked")
def split_random(spark, sf_dir):
    return random_split(table(spark, sf_dir, "orders"), 0.2, "o_orderkey").select("o_orderkey", "split")


@query("split_stratified", f"WITH {STRATIFIED} SELECT o_orderkey, o_orderstatus, split FROM sided")
def split_stratified(spark, sf_dir):
    out = stratified_split(table(spark, sf_dir, "orders"), "o_orderstatus", 0.2, "o_orderkey")
    return out.select("o_orderkey", "o_orderstatus", "split")


FOLDED = """folded AS (SELECT *, CASE WHEN r < (n % 7) * (n // 7 + 1) THEN r // (n // 7 + 1)
  ELSE n % 7 + (r - (n % 7) * (n // 7 + 1)) // (n // 7) END AS fold FROM ranked)"""


@query("fold_assign", f"WITH {RANKED}, {FOLDED} SELECT o_orderkey, CAST(fold AS BIGINT) AS fold FROM folded")
def fold_assign(spark, sf_dir):
    out = assign_folds(table(spark, sf_dir, "orders"), 7, "o_orderkey")
    return out.select("o_orderkey", F.col("fold").cast("long").alias("fold"))


# Rule-based predictions: 'R' by discount (two classes), the return flag by quantity and discount (three).
def binary_calls(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), (F.col("l_discount") > 0.05).cast("double").alias("prediction")
    )


def three_calls(spark, sf_dir):
    code = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    guess = F.when(F.col("l_quantity") > 30, 0.0).when(F.col("l_discount") > 0.03, 1.0).otherwise(2.0)
    return table(spark, sf_dir, "lineitem").select(code.alias("label"), guess.alias("prediction"))


CALLS = """calls AS (SELECT 'binary' AS task, CAST(l_returnflag = 'R' AS INT) AS y, CAST(l_discount > 0.05 AS INT) AS p FROM lineitem
UNION ALL SELECT 'multiclass', CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, CASE WHEN l_quantity > 30 THEN 0 WHEN l_discount > 0.03 THEN 1 ELSE 2 END FROM lineitem),
per AS (SELECT task, c AS cls, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS called, count(*) FILTER (y = c AND p = c) AS tp
  FROM calls, (SELECT unnest([0, 1, 2]) AS c) GROUP BY 1, 2 HAVING support + called > 0),
scores AS (SELECT *, CASE WHEN called > 0 THEN tp / called ELSE 0 END AS "precision", CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  2 * tp / (support + called) AS f1 FROM per)"""


def _metric(name: str):
    inner = f'"{name}"' if name == "precision" else name
    sql = f"""WITH {CALLS} SELECT task, round(CASE WHEN task = 'binary' THEN max({inner}) FILTER (cls = 1) ELSE sum(support * {inner}) / sum(support) END, 6) + 0.0 AS value
FROM scores GROUP BY task"""
    if name == "accuracy":
        sql = f"WITH {CALLS} SELECT task, round(avg(CAST(y = p AS INT)), 6) + 0.0 AS value FROM calls GROUP BY task"

    @query(f"metric_{name}", sql)
    def run(spark, sf_dir):
        two = binary_calls(spark, sf_dir).withColumn("task", F.lit("binary"))
        both = two.unionByName(three_calls(spark, sf_dir).withColumn("task", F.lit("multiclass")))
        return classification_metrics(both, by=["task"]).select("task", rnd(name).alias("value"))


for _name in ("accuracy", "precision", "recall", "f1"):
    _metric(_name)


def price_guesses(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500 + 10000).alias("prediction")
    )


GUESSES = "g AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 + 10000 AS p FROM lineitem)"


@query(
    "metric_regression",
    f"""WITH {GUESSES} SELECT l_returnflag, round(sqrt(avg((y - p) ** 2)), 4) + 0.0 AS rmse, round(avg((y - p) ** 2), 1) + 0.0 AS mse,
round(avg(abs(y - p)), 4) + 0.0 AS mae FROM g GROUP BY 1""",
)
def metric_regression(spark, sf_dir):
    m = regression_metrics(price_guesses(spark, sf_dir), by=["l_returnflag"])
    return m.select("l_returnflag", rnd("rmse", 4).alias("rmse"), rnd("mse", 1).alias("mse"), rnd("mae", 4).alias("mae"))


@query(
    "metric_r2",
    f"WITH {GUESSES} SELECT l_returnflag, round(1 - avg((y - p) ** 2) / var_pop(y), 6) + 0.0 AS r2 FROM g GROUP BY 1",
)
def metric_r2(spark, sf_dir):
    return regression_metrics(price_guesses(spark, sf_dir), by=["l_returnflag"]).select("l_returnflag", rnd("r2").alias("r2"))


TASK_COLUMNS = ("l_linenumber", "l_quantity", "l_discount")


@query(
    "detect_task",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct", bool_and({c} = floor({c})) AS integral,
count(DISTINCT {c}) < 10 AND bool_and({c} = floor({c})) AS is_classification FROM lineitem"""
        for c in TASK_COLUMNS
    ),
)
def detected(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    parts = [detect_task(li, c).withColumn("column", F.lit(c)) for c in TASK_COLUMNS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def model_scores(spark, sf_dir):
    """Three rules for the price play the models."""
    li = table(spark, sf_dir, "lineitem")
    rules = {"flat": F.lit(50000.0), "by_quantity": F.col("l_quantity") * 1500 + 10000, "by_tax": 60000 - F.col("l_tax") * 100000}
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), p.cast("double").alias("prediction")) for m, p in rules.items()])
    calls = li.select(F.col("l_extendedprice").alias("label"), F.inline(pairs))
    wide = regression_metrics(calls, by=["model"])
    kept = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("rmse", "mae", "r2")])
    return wide.select("model", F.inline(kept))


@query(
    "compare_models",
    """WITH calls AS (SELECT 'flat' AS model, l_extendedprice AS y, 50000.0::DOUBLE AS p FROM lineitem UNION ALL
SELECT 'by_quantity', l_extendedprice, l_quantity * 1500 + 10000 FROM lineitem UNION ALL SELECT 'by_tax', l_extendedprice, 60000 - l_tax * 100000 FROM lineitem),
wide AS (SELECT model, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) ** 2) / var_pop(y) AS r2 FROM calls GROUP BY 1),
long AS (SELECT model, 'rmse' AS metric, rmse AS value, rmse AS o FROM wide UNION ALL SELECT model, 'mae', mae, mae FROM wide UNION ALL SELECT model, 'r2', r2, -r2 FROM wide)
SELECT metric, model AS best_model, round(value, 4) + 0.0 AS best_value, 3::BIGINT AS models FROM long QUALIFY row_number() OVER (PARTITION BY metric ORDER BY o, model) = 1""",
)
def compared(spark, sf_dir):
    return compare_models(model_scores(spark, sf_dir)).withColumn("best_value", rnd("best_value", 4))


@query(
    "suggest_improvements",
    f"""WITH {RUNS}, s AS (SELECT experiment || '_' || run_id AS model, concat_ws(';',
  CASE WHEN n % 2 = 0 AND n < 100 THEN 'Consider increasing number of epochs for better convergence' END,
  CASE WHEN n < 1000 THEN 'Consider collecting more training data' END,
  CASE WHEN model_type = 'random_forest' AND (n % 3 != 0 OR n < 100) THEN 'Consider increasing n_estimators for Random Forest' END,
  CASE WHEN model_type = 'xgboost' AND n % 3 != 1 THEN 'Consider tuning max_depth parameter for XGBoost' END) AS suggestions FROM runs)
SELECT * FROM s WHERE suggestions != ''""",
)
def suggested(spark, sf_dir):
    return suggest_improvements(logged_runs(spark, sf_dir)).select("model", F.concat_ws(";", "suggestions").alias("suggestions"))


@query(
    "iteration_summary",
    f"""WITH {RUNS}, long AS (SELECT 'rmse' AS metric, rmse AS v FROM runs UNION ALL SELECT 'r2', r2 FROM runs)
SELECT metric, round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std, count(*) AS runs FROM long GROUP BY 1""",
)
def summarised(spark, sf_dir):
    long = logged_runs(spark, sf_dir).select(F.explode("metrics").alias("metric", "value"))
    return iteration_summary(long).withColumns({"mean": rnd("mean"), "std": rnd("std")})
