"""Models, validation, tuning, explanation, training runs and scoring, on whole tables.

Where a model has a closed form (least squares, group means of a full tree on categories, group shares of an
unpenalised logistic model on indicators) the query uses that form's setting, so that SQL can check every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import feature, query, rnd, spec, sql_hash, table
from queries.splitting import RANKED
from tablewright.functions.storage import new_path
from tablewright.operators.explain import explain_by_scoring, explain_linear, explain_trees, explanation_sample, importance
from tablewright.operators.metrics import evaluate
from tablewright.operators.models import make_learner
from tablewright.operators.selection import GRIDS, cross_validate, tune
from tablewright.operators.split import assign_folds
from tablewright.operators.transforms import fit_transforms
from tablewright.plans.score import score
from tablewright.plans.train import sweep, train, train_iterations
from tablewright.sources.files import sample_rows
from tablewright.streaming.score import quarantine_stream, score_stream

# Settings small enough for a query; the library's defaults are the full-size ones.
SMALL = {"n_estimators": 5, "max_depth": 5}
ONE_TREE = {"n_estimators": 1, "max_depth": 6, "max_features": "all", "bootstrap": False}
FULL = {"max_features": "all", "bootstrap": False}  # a forest of the default size, every tree on all rows and columns
ONE_STEP = {"n_estimators": 1, "max_depth": 6, "learning_rate": 1.0}

GROUPED = [feature("l_returnflag", "categorical", "one-hot"), feature("l_linestatus", "categorical", "one-hot")]
LINE = [
    feature("l_quantity", "numeric", "scale"),
    feature("l_discount", "numeric", "minmax"),
    feature("l_tax", "numeric"),
    feature("l_linestatus", "categorical", "one-hot"),
    feature("l_shipdate", "datetime", "components"),
]
ORDER = [
    feature("o_totalprice", "numeric", "scale"),
    feature("o_orderpriority", "categorical", "one-hot"),
    feature("o_orderdate", "datetime", "components"),
]


def rows_for(df, wanted, *keep):
    """The fitted table, and ``df`` as keep columns, features and label."""
    fitted = fit_transforms(df, wanted)
    return fitted, fitted.transform(df, label="label").select(*keep, "features", "label")


def line_rows(spark, sf_dir, features, target, task, *keep):
    li = table(spark, sf_dir, "lineitem").withColumn("late", (F.col("l_quantity") > 25).cast("int"))
    return rows_for(li, spec(features, target, task), *keep)


def order_rows(spark, sf_dir, features=ORDER, target=("o_orderstatus", "multiclass"), task="classification"):
    return rows_for(table(spark, sf_dir, "orders"), spec(features, target, task), "o_orderkey")


# ---------------------------------------------------------------------------------------------- models

GROUP_COUNTS = """counts AS (SELECT l_returnflag, l_linestatus, {label} AS y, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
best AS (SELECT l_returnflag, l_linestatus, y FROM counts QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY n DESC, y) = 1)"""
MAJORITY = f"""WITH {GROUP_COUNTS} SELECT lineitem.l_returnflag, lineitem.l_linestatus, l_orderkey, y + 0.0::DOUBLE AS prediction
FROM lineitem JOIN best USING (l_returnflag, l_linestatus)"""
GROUP_MEAN = """SELECT l_orderkey, l_returnflag, l_linestatus, round(avg(l_extendedprice) OVER (PARTITION BY l_returnflag, l_linestatus), 4) + 0.0 AS prediction FROM lineitem"""
# A boosted step from the overall mean: the group's residuals over their number and the penalty of 1.
SHRUNK_MEAN = """WITH m AS (SELECT avg(l_extendedprice) AS mean FROM lineitem), g AS (SELECT l_returnflag, l_linestatus, count(*) AS n, avg(l_extendedprice) AS own FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_returnflag, l_linestatus, round(mean + n * (own - mean) / (n + 1), 4) + 0.0 AS prediction FROM lineitem JOIN g USING (l_returnflag, l_linestatus), m"""
LATE = "CAST(l_quantity > 25 AS INT)"


def _grouped_model(name, model, task, params, target, sql):
    def run(spark, sf_dir):
        fitted, rows = line_rows(spark, sf_dir, GROUPED, target, task, "l_orderkey", "l_returnflag", "l_linestatus")
        scored = make_learner(model, task, params).fit(rows, fitted.feature_names).predict(rows)
        return scored.select("l_orderkey", "l_returnflag", "l_linestatus", rnd("prediction", 4).alias("prediction"))

    query(name, sql)(run)


_late, _line, _price = ("late", "binary"), ("l_linenumber", "multiclass"), ("l_extendedprice", "continuous")
_grouped_model("rf_classify", "random_forest", "classification", FULL, _late, MAJORITY.format(label=LATE))
_grouped_model("rf_classify_multiclass", "random_forest", "classification", FULL, _line, MAJORITY.format(label="l_linenumber - 1"))
_grouped_model("rf_regress", "random_forest", "regression", FULL, _price, GROUP_MEAN)
_grouped_model("gbt_classify", "xgboost", "classification", {}, _late, MAJORITY.format(label=LATE))
_grouped_model("gbt_classify_multiclass", "xgboost", "classification", ONE_STEP, _line, MAJORITY.format(label="l_linenumber - 1"))
_grouped_model("gbt_regress", "xgboost", "regression", ONE_STEP, _price, SHRUNK_MEAN)


_status, _total = ("o_orderstatus", "multiclass"), ("o_totalprice", "continuous")

# Twelve rounds of boosting on rows of six groups: every tree tells all groups apart, so a group's margins follow a recursion.
STEP = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END + CASE l_linestatus WHEN 'F' THEN 3 ELSE 0 END"
SIZE = f"CASE WHEN l_quantity <= 5 + 4 * ({STEP}) THEN 'low' WHEN l_quantity <= 30 + 3 * ({STEP}) THEN 'mid' ELSE 'top' END"
ROUNDS, RATE = 12, 0.3  # without a penalty: with one, groups of nearly equal shares gain by staying together


def _next_margin(k):
    return f"m{k} - {RATE} * (n * p{k} - n{k}) / (2 * n * p{k} * (1 - p{k}))"


@query(
    "gbt_rounds_multiclass",
    f"""WITH RECURSIVE counts AS (SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (s = 'low') AS n0, count(*) FILTER (s = 'mid') AS n1, count(*) FILTER (s = 'top') AS n2
  FROM (SELECT *, {SIZE} AS s FROM lineitem) GROUP BY 1, 2),
boosted AS (SELECT *, 0 AS t, 0.0::DOUBLE AS m0, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2 FROM counts
  UNION ALL SELECT l_returnflag, l_linestatus, n, n0, n1, n2, t + 1, {", ".join(_next_margin(k) for k in range(3))}
  FROM (SELECT *, exp(m0) / (exp(m0) + exp(m1) + exp(m2)) AS p0, exp(m1) / (exp(m0) + exp(m1) + exp(m2)) AS p1, exp(m2) / (exp(m0) + exp(m1) + exp(m2)) AS p2 FROM boosted) WHERE t < {ROUNDS}),
shares AS (SELECT l_returnflag, l_linestatus, k AS class, exp([m0, m1, m2][k + 1]) / (exp(m0) + exp(m1) + exp(m2)) AS p FROM boosted, (SELECT unnest([0, 1, 2]) AS k) WHERE t = {ROUNDS})
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, class::BIGINT AS class, round(p, 5) + 0.0 AS probability FROM lineitem JOIN shares USING (l_returnflag, l_linestatus)""",
)
def gbt_rounds_multiclass(spark, sf_dir):
    """Softmax boosting: probabilities after twelve rounds."""
    li = table(spark, sf_dir, "lineitem").withColumn("size", F.expr(SIZE))
    fitted, rows = rows_for(li, spec(GROUPED, ("size", "multiclass"), "classification"), "l_orderkey", "l_linenumber")
    params = {"n_estimators": ROUNDS, "learning_rate": RATE, "reg_lambda": 0.0, "gamma": 0.0, "min_child_weight": 1}
    out = make_learner("xgboost", "classification", params).fit(rows, fitted.feature_names).predict_proba(rows, "l_orderkey", "l_linenumber")
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.col("class").cast("long").alias("class"), rnd("probability", 5).alias("probability"))


@query(
    "gbt_early_stopping",
    f"""WITH RECURSIVE cut AS (SELECT o_orderpriority AS g, o_totalprice AS y, {sql_hash("o_orderkey")} < 858993459 AS held FROM orders),
sums AS (SELECT g, count(*) FILTER (NOT held) AS n, avg(y) FILTER (NOT held) AS own, count(*) FILTER (held) AS nv, coalesce(sum(y) FILTER (held), 0) AS yv, coalesce(sum(y * y) FILTER (held), 0) AS yyv FROM cut GROUP BY g),
boosted AS (SELECT g, n, own, nv, yv, yyv, 0 AS t, (SELECT avg(y) FROM cut WHERE NOT held) AS m FROM sums
  UNION ALL SELECT g, n, own, nv, yv, yyv, t + 1, m - 0.5 * n * (m - own) / (n + 1) FROM boosted WHERE t < 10),
losses AS (SELECT t, sum(yyv - 2 * m * yv + nv * m * m) / sum(nv) AS loss FROM boosted WHERE t > 0 GROUP BY t),
best AS (SELECT t FROM losses ORDER BY loss, t LIMIT 1)
SELECT o_orderkey, t::BIGINT AS best_round, round(m, 4) + 0.0 AS prediction FROM orders JOIN boosted ON g = o_orderpriority JOIN best USING (t)""",
)
def gbt_early_stopping(spark, sf_dir):
    """A fifth of the orders, by the hash of their key, measures each round; the rounds up to the best of ten stay."""
    fitted, rows = order_rows(spark, sf_dir, [feature("o_orderpriority", "categorical", "one-hot")], _total, "regression")
    params = {"n_estimators": 10, "learning_rate": 0.5, "early_stopping": True, "early_stopping_patience": 10, "validation_split": 0.2}
    trained = make_learner("xgboost", "regression", params).fit(rows, fitted.feature_names, key="o_orderkey")
    best = F.lit(trained.metadata["best_round"]).cast("long").alias("best_round")
    return trained.predict(rows).select("o_orderkey", best, rnd("prediction", 4).alias("prediction"))


def _order_model(name, model, task, params, target):
    """Rows-only twins with several trees and all kinds of features."""

    def run(spark, sf_dir):
        features = [f for f in ORDER if f["name"] != target[0]]
        fitted, rows = order_rows(spark, sf_dir, features, target, task)
        scored = make_learner(model, task, params).fit(rows, fitted.feature_names).predict(rows)
        return scored.select("o_orderkey", "label", rnd("prediction", 4).alias("prediction"))

    query(name)(run)


_order_model("rf_classify_forest", "random_forest", "classification", SMALL, _status)
_order_model("rf_regress_forest", "random_forest", "regression", SMALL, _total)
_order_model("gbt_classify_boosted", "xgboost", "classification", SMALL, _status)
_order_model("gbt_regress_boosted", "xgboost", "regression", SMALL, _total)
_order_model("svm_regress", "svm", "regression", {"kernel": "linear"}, _total)


@query(
    "logistic",
    """SELECT o_orderkey, o_orderpriority, round(avg(CAST(o_orderstatus = 'F' AS INT)) OVER (PARTITION BY o_orderpriority), 4) + 0.0 AS probability FROM orders""",
)
def logistic(spark, sf_dir):
    """Unpenalised on indicators of one column: every group's probability is its share."""
    o = table(spark, sf_dir, "orders").withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    fitted, rows = rows_for(o, spec([feature("o_orderpriority", "categorical", "one-hot")], ("is_f", "binary"), "classification"), "o_orderkey", "o_orderpriority")
    model = make_learner("logistic_regression", params={"penalty": None, "tol": 1e-9, "max_iter": 200}).fit(rows, fitted.feature_names)
    return model.predict_proba(rows, "o_orderkey", "o_orderpriority").where(F.col("class") == 1).select("o_orderkey", "o_orderpriority", rnd("probability", 4).alias("probability"))


@query(
    "predict_proba",
    """WITH s AS (SELECT DISTINCT o_orderstatus AS status FROM orders), c AS (SELECT status, dense_rank() OVER (ORDER BY status) - 1 AS class FROM s),
p AS (SELECT o_orderpriority, status, class, count(*) FILTER (o_orderstatus = status) / count(*) AS probability FROM orders, c GROUP BY 1, 2, 3)
SELECT o_orderkey, class, round(probability, 4) + 0.0 AS probability FROM orders JOIN p USING (o_orderpriority)""",
)
def predict_proba(spark, sf_dir):
    fitted, rows = order_rows(spark, sf_dir, [feature("o_orderpriority", "categorical", "one-hot")])
    model = make_learner("logistic_regression", params={"penalty": None, "tol": 1e-9, "max_iter": 200}).fit(rows, fitted.feature_names)
    out = model.predict_proba(rows, "o_orderkey")
    return out.select("o_orderkey", F.col("class").cast("long").alias("class"), rnd("probability", 4).alias("probability"))


ODD = feature("odd", "numeric")
BITS = {"a": "CAST(l_quantity > 25 AS INT)", "b": "CAST(l_discount > 0.05 AS INT)"}


@query("svm_classify", "SELECT o_orderkey, (o_custkey % 2)::DOUBLE AS label, (o_custkey % 2)::DOUBLE AS prediction FROM orders")
def svm_classify(spark, sf_dir):
    """Default settings on classes that one column tells apart: every row gets its own."""
    o = table(spark, sf_dir, "orders").withColumns({"odd": F.col("o_custkey") % 2, "is_odd": F.col("o_custkey") % 2})
    fitted, rows = rows_for(o, spec([ODD], ("is_odd", "binary"), "classification"), "o_orderkey")
    return make_learner("svm", "classification").fit(rows, fitted.feature_names).predict(rows).select("o_orderkey", "label", "prediction")


# Newton's method for the log loss plus half the squared coefficient (C = 1), on the counts of the two groups.
@query(
    "logistic_penalised",
    """WITH RECURSIVE rows AS (SELECT o_orderkey, o_custkey % 2 AS x, CAST(o_totalprice > 150000 + 100000 * (o_custkey % 2) AS INT) AS y FROM orders),
c AS (SELECT count(*) FILTER (x = 0) AS n0, count(*) FILTER (x = 0 AND y = 1) AS k0, count(*) FILTER (x = 1) AS n1, count(*) FILTER (x = 1 AND y = 1) AS k1 FROM rows),
newton AS (SELECT 0 AS t, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b UNION ALL
  SELECT t + 1, a - (h11 * ga - h01 * gb) / (h00 * h11 - h01 * h01), b - (h00 * gb - h01 * ga) / (h00 * h11 - h01 * h01) FROM (
    SELECT t, a, b, n0 * p0 - k0 + n1 * p1 - k1 AS ga, n1 * p1 - k1 + b AS gb, n0 * p0 * (1 - p0) + n1 * p1 * (1 - p1) AS h00, n1 * p1 * (1 - p1) AS h01, n1 * p1 * (1 - p1) + 1 AS h11
    FROM (SELECT *, 1 / (1 + exp(-a)) AS p0, 1 / (1 + exp(-a - b)) AS p1 FROM newton, c) WHERE t < 15)),
best AS (SELECT a, b FROM newton WHERE t = 15)
SELECT o_orderkey, x, round(1 / (1 + exp(-a - b * x)), 4) + 0.0 AS probability FROM rows, best""",
)
def logistic_penalised(spark, sf_dir):
    """The default penalty."""
    o = table(spark, sf_dir, "orders").withColumns({"odd": F.col("o_custkey") % 2, "dear": (F.col("o_totalprice") > 150000 + 100000 * (F.col("o_custkey") % 2)).cast("int")})
    fitted, rows = rows_for(o, spec([ODD], ("dear", "binary"), "classification"), "o_orderkey", "odd")
    model = make_learner("logistic_regression", params={"tol": 1e-9}).fit(rows, fitted.feature_names)
    out = model.predict_proba(rows, "o_orderkey", "odd").where(F.col("class") == 1)
    return out.select("o_orderkey", F.col("odd").alias("x"), rnd("probability", 4).alias("probability"))


TWO = [feature("l_quantity", "numeric"), feature("l_discount", "numeric")]


@query(
    "linreg_fit",
    """WITH m AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_discount, l_discount) AS bb, covar_pop(l_quantity, l_discount) AS ab,
  covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_discount, l_extendedprice) AS b_y, avg(l_quantity) AS ma, avg(l_discount) AS mb, avg(l_extendedprice) AS my FROM lineitem),
c AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS ca, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM m)
SELECT 'l_quantity' AS term, round(ca, 4) + 0.0 AS coefficient FROM c UNION ALL SELECT 'l_discount', round(cb, 3) + 0.0 FROM c
UNION ALL SELECT 'intercept', round(my - ca * ma - cb * mb, 3) + 0.0 FROM c""",
)
def linreg_fit(spark, sf_dir):
    fitted, rows = line_rows(spark, sf_dir, TWO, _price, "regression")
    model = make_learner("linear_regression").fit(rows, fitted.feature_names).model
    q, d = model.coefficients
    pairs = [("l_quantity", round(float(q), 4)), ("l_discount", round(float(d), 3)), ("intercept", round(float(model.intercept), 3))]
    return spark.createDataFrame(pairs, "term string, coefficient double")


ONE = [feature("l_quantity", "numeric")]
LINE_FIT = "regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b"


@query("predict", f"WITH f AS (SELECT {LINE_FIT} FROM lineitem) SELECT l_orderkey, l_quantity, round(a + b * l_quantity, 4) + 0.0 AS prediction FROM lineitem, f")
def predict(spark, sf_dir):
    fitted, rows = line_rows(spark, sf_dir, ONE, _price, "regression", "l_orderkey", "l_quantity")
    model = make_learner("linear_regression").fit(rows, fitted.feature_names)
    return model.predict(rows).select("l_orderkey", "l_quantity", rnd("prediction", 4).alias("prediction"))


@query(
    "feature_importance",
    f"""WITH bits AS (SELECT l_extendedprice AS y, {BITS["a"]} AS a, {BITS["b"]} AS b FROM lineitem),
m AS (SELECT a, b, count(*) AS n, avg(y) AS m FROM bits GROUP BY a, b), t AS (SELECT sum(n * m) / sum(n) AS m FROM m),
ma AS (SELECT a, sum(n) AS n, sum(n * m) / sum(n) AS m FROM m GROUP BY a), mb AS (SELECT b, sum(n) AS n, sum(n * m) / sum(n) AS m FROM m GROUP BY b),
g AS (SELECT (SELECT sum(n * (ma.m - t.m) ** 2) FROM ma, t) AS ga, (SELECT sum(n * (mb.m - t.m) ** 2) FROM mb, t) AS gb, (SELECT sum(n * (m.m - t.m) ** 2) FROM m, t) AS g),
shares AS (SELECT CASE WHEN ga >= gb THEN ga ELSE g - gb END / g AS a FROM g)
SELECT 'a' AS feature, round(a, 6) + 0.0 AS importance FROM shares UNION ALL SELECT 'b', round(1 - a, 6) + 0.0 FROM shares""",
)
def feature_importance(spark, sf_dir):
    """A forest of the default size on two indicators: the shares of the spread that the first cut and those below it explain."""
    li = table(spark, sf_dir, "lineitem").withColumns({k: F.expr(e) for k, e in BITS.items()})
    fitted, rows = rows_for(li, spec([feature("a", "numeric"), feature("b", "numeric")], _price, "regression"))
    model = make_learner("random_forest", "regression", FULL).fit(rows, fitted.feature_names)
    return model.importances(spark).select("feature", rnd("importance").alias("importance"))


# ------------------------------------------------------------------------- evaluation, folds, tuning


@query(
    "evaluate_model",
    f"""WITH f AS (SELECT {LINE_FIT} FROM lineitem), e AS (SELECT l_extendedprice AS y, l_extendedprice - a - b * l_quantity AS e FROM lineitem, f)
SELECT round(sqrt(avg(e * e)), 4) + 0.0 AS rmse, round(avg(abs(e)), 4) + 0.0 AS mae, round(1 - avg(e * e) / var_pop(y), 6) + 0.0 AS r2 FROM e""",
)
def evaluate_model(spark, sf_dir):
    fitted, rows = line_rows(spark, sf_dir, ONE, _price, "regression")
    got = evaluate(make_learner("linear_regression").fit(rows, fitted.feature_names), rows, ("rmse", "mae", "r2"))
    frame = spark.createDataFrame([got], "rmse double, mae double, r2 double")
    return frame.select(rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"), rnd("r2").alias("r2"))


K = 5
FOLDS = f"""folded AS (SELECT *, CASE WHEN r < (n % {K}) * (n // {K} + 1) THEN r // (n // {K} + 1) ELSE n % {K} + (r - (n % {K}) * (n // {K} + 1)) // (n // {K}) END AS fold,
  o_custkey + 0.0::DOUBLE AS x, o_totalprice AS y FROM ranked)"""
FOLD_SCORES = f"""{RANKED}, {FOLDS}, k AS (SELECT unnest({list(range(K))}) AS f),
fits AS (SELECT f, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, sum(x * y) / sum(x * x) AS b0 FROM folded, k WHERE fold != f GROUP BY f),
errors AS (SELECT fold, y, y - a - b * x AS e, y - b0 * x AS e0 FROM folded JOIN fits ON fold = f),
scores AS (SELECT fold, -sqrt(avg(e * e)) AS rmse, -sqrt(avg(e0 * e0)) AS rmse_0, -avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2, 1 - avg(e0 * e0) / var_pop(y) AS r2_0 FROM errors GROUP BY fold)"""
CUST = [feature("o_custkey", "numeric")]


def _folded(spark, sf_dir, k=K):
    o = table(spark, sf_dir, "orders")
    _, rows = rows_for(o, spec(CUST, _total, "regression"), "o_orderkey")
    return assign_folds(rows, k, "o_orderkey").select("features", "label", "fold")


@query(
    "cv_linreg",
    f"""WITH {FOLD_SCORES} SELECT CAST(fold AS INT) AS fold, 'rmse' AS metric, round(rmse, 4) + 0.0 AS score FROM scores
UNION ALL SELECT CAST(fold AS INT), 'mae', round(mae, 4) + 0.0 FROM scores UNION ALL SELECT CAST(fold AS INT), 'r2', round(r2, 4) + 0.0 FROM scores""",
)
def cv_linreg(spark, sf_dir):
    out = cross_validate(make_learner("linear_regression"), _folded(spark, sf_dir), ("rmse", "mae", "r2"), per_fold=True)
    return out.withColumn("score", rnd("score", 4))


@query(
    "cross_validate",
    f"""WITH {FOLD_SCORES} SELECT 'rmse' AS metric, round(avg(rmse), 4) + 0.0 AS score, round(stddev_pop(rmse), 4) + 0.0 AS std, count(*) AS folds FROM scores
UNION ALL SELECT 'r2', round(avg(r2), 6) + 0.0, round(stddev_pop(r2), 6) + 0.0, count(*) FROM scores""",
)
def cross_validated(spark, sf_dir):
    out = cross_validate(make_learner("linear_regression"), _folded(spark, sf_dir), ("rmse", "r2"))
    digits = F.when(F.col("metric") == "rmse", 4).otherwise(6)
    return out.select("metric", *[(F.when(digits == 4, F.round(c, 4)).otherwise(F.round(c, 6)) + 0.0).alias(c) for c in ("score", "std")], "folds")


@query("cross_validate_forest")
def cross_validate_forest(spark, sf_dir):
    _, rows = order_rows(spark, sf_dir)
    out = cross_validate(make_learner("random_forest", "classification", SMALL), assign_folds(rows, 3, "o_orderkey"), ("accuracy", "f1", "precision", "recall"))
    return out.select("metric", rnd("score").alias("score"), rnd("std").alias("std"), "folds")


@query(
    "tune_grid",
    f"""WITH {FOLD_SCORES} SELECT 0 AS candidate, 'False' AS fit_intercept, round(avg(r2_0), 6) + 0.0 AS score FROM scores
UNION ALL SELECT 1, 'True', round(avg(r2), 6) + 0.0 FROM scores""",
)
def tune_grid(spark, sf_dir):
    got = tune(make_learner("linear_regression"), _folded(spark, sf_dir), {"fit_intercept": [False, True]}, "grid")
    return got.candidates.select("candidate", F.col("params")["fit_intercept"].alias("fit_intercept"), rnd("score").alias("score"))


@query(
    "tune_random",
    f"""WITH {FOLD_SCORES} SELECT 0 AS candidate, 'False' AS fit_intercept, round(avg(rmse_0), 4) + 0.0 AS score, round(stddev_pop(rmse_0), 4) + 0.0 AS std FROM scores
UNION ALL SELECT 1, 'True', round(avg(rmse), 4) + 0.0, round(stddev_pop(rmse), 4) + 0.0 FROM scores""",
)
def tune_random(spark, sf_dir):
    """Ten draws from a space of two take both; scored by errors, over the default number of folds."""
    got = tune(make_learner("linear_regression"), _folded(spark, sf_dir), {"fit_intercept": [False, True]}, "random", scoring="rmse")
    return got.candidates.select("candidate", F.col("params")["fit_intercept"].alias("fit_intercept"), rnd("score", 4).alias("score"), rnd("std", 4).alias("std"))


# ----------------------------------------------------------------------------------------- explanation

TWO_FIT = """m AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_discount, l_discount) AS bb, covar_pop(l_quantity, l_discount) AS ab,
  covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_discount, l_extendedprice) AS b_y, avg(l_quantity) AS ma, avg(l_discount) AS mb FROM lineitem),
phi AS (SELECT l_orderkey, (ay * bb - b_y * ab) / (aa * bb - ab * ab) * (l_quantity - ma) AS quantity, (b_y * aa - ay * ab) / (aa * bb - ab * ab) * (l_discount - mb) AS discount FROM lineitem, m)"""


def _linear_shares(spark, sf_dir):
    fitted, rows = line_rows(spark, sf_dir, TWO, _price, "regression", "l_orderkey")
    model = make_learner("linear_regression").fit(rows, fitted.feature_names)
    return explain_linear(model, rows, rows, ["l_orderkey"]).values


@query("shap_linear", f"WITH {TWO_FIT} SELECT l_orderkey, 'l_quantity' AS feature, round(quantity, 3) + 0.0 AS phi FROM phi UNION ALL SELECT l_orderkey, 'l_discount', round(discount, 3) + 0.0 FROM phi")
def shap_linear(spark, sf_dir):
    return _linear_shares(spark, sf_dir).select("l_orderkey", "feature", rnd("phi", 3).alias("phi"))


@query("shap_importance", f"WITH {TWO_FIT} SELECT 'l_quantity' AS feature, round(avg(abs(quantity)), 4) + 0.0 AS importance FROM phi UNION ALL SELECT 'l_discount', round(avg(abs(discount)), 4) + 0.0 FROM phi")
def shap_importance(spark, sf_dir):
    return importance(_linear_shares(spark, sf_dir)).select("feature", rnd("importance", 4).alias("importance"))


@query(
    "shap_tree",
    f"""WITH bits AS (SELECT l_orderkey, l_extendedprice AS y, {BITS["a"]} AS a, {BITS["b"]} AS b FROM lineitem),
m AS (SELECT a, b, count(*) AS n, avg(y) AS m FROM bits GROUP BY a, b), t AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS m FROM m),
ma AS (SELECT a, sum(n) AS n, sum(n * m) / sum(n) AS m FROM m GROUP BY a), mb AS (SELECT b, sum(n) AS n, sum(n * m) / sum(n) AS m FROM m GROUP BY b),
root AS (SELECT (SELECT sum(ma.n * (ma.m - t.m) ** 2) FROM ma, t) >= (SELECT sum(mb.n * (mb.m - t.m) ** 2) FROM mb, t) AS a),
va AS (SELECT m.a, CASE WHEN (SELECT a FROM root) THEN any_value(ma.m) ELSE sum(mb.n * m.m) / sum(mb.n) END AS m FROM m JOIN ma USING (a) JOIN mb USING (b) GROUP BY m.a),
vb AS (SELECT m.b, CASE WHEN (SELECT a FROM root) THEN sum(ma.n * m.m) / sum(ma.n) ELSE any_value(mb.m) END AS m FROM m JOIN ma USING (a) JOIN mb USING (b) GROUP BY m.b),
phi AS (SELECT m.a, m.b, (va.m - t.m + m.m - vb.m) / 2 AS pa, (vb.m - t.m + m.m - va.m) / 2 AS pb FROM m JOIN va ON va.a = m.a JOIN vb ON vb.b = m.b, t)
SELECT l_orderkey, a, b, feature, round(CASE feature WHEN 'a' THEN pa ELSE pb END, 3) + 0.0 AS phi FROM bits JOIN phi USING (a, b), (SELECT unnest(['a', 'b']) AS feature)""",
)
def shap_tree(spark, sf_dir):
    """A forest of the default size on two indicators, every tree grown on all rows: four leaves, cut by the stronger indicator first."""
    li = table(spark, sf_dir, "lineitem").withColumns({k: F.expr(e) for k, e in BITS.items()})
    fitted, rows = rows_for(li, spec([feature("a", "numeric"), feature("b", "numeric")], _price, "regression"), "l_orderkey", "a", "b")
    model = make_learner("random_forest", "regression", FULL).fit(rows, fitted.feature_names)
    values = explain_trees(model, rows, ["l_orderkey", "a", "b"]).values
    return values.select("l_orderkey", "a", "b", "feature", rnd("phi", 3).alias("phi"))


@query(
    "shap_tree_classes",
    """WITH names AS (SELECT DISTINCT 'o_orderpriority=' || o_orderpriority AS feature FROM orders UNION ALL SELECT unnest(['o_totalprice', 'o_orderdate_year', 'o_orderdate_month', 'o_orderdate_day', 'o_orderdate_dayofweek']))
SELECT o_orderkey, feature, 0.0::DOUBLE AS total FROM orders, names""",
)
def shap_tree_classes(spark, sf_dir):
    """A forest's class probabilities add up to one, so what a feature gives to one class it takes from the others."""
    fitted, rows = order_rows(spark, sf_dir)
    model = make_learner("random_forest", "classification", {"n_estimators": 3, "max_depth": 4}).fit(rows, fitted.feature_names)
    values = explain_trees(model, rows, ["o_orderkey"]).values
    return values.groupBy("o_orderkey", "feature").agg(rnd(F.sum("phi")).alias("total"))


@query(
    "shap_tree_sums",
    """SELECT l_orderkey, l_returnflag, l_linestatus, round(avg(l_extendedprice) OVER (PARTITION BY l_returnflag, l_linestatus), 2) + 0.0 AS total,
round(avg(l_extendedprice) OVER (), 2) + 0.0 AS base FROM lineitem""",
)
def shap_tree_sums(spark, sf_dir):
    """A row's contributions and the base value add up to its prediction; here, the mean of its group."""
    fitted, rows = line_rows(spark, sf_dir, GROUPED, _price, "regression", "l_orderkey", "l_returnflag", "l_linestatus")
    wide = rows.withColumn("row", F.monotonically_increasing_id())
    model = make_learner("random_forest", "regression", ONE_TREE).fit(rows, fitted.feature_names)
    keep = ["row", "l_orderkey", "l_returnflag", "l_linestatus"]
    got = explain_trees(model, wide, keep)
    sums = got.values.groupBy(*keep).agg(F.sum("phi").alias("phi"))
    return sums.select(*keep[1:], rnd(F.col("phi") + got.base[0], 2).alias("total"), rnd(F.lit(got.base[0]), 2).alias("base"))


SMALLEST = "SELECT * FROM {source} ORDER BY " + sql_hash("o_orderkey") + ", CAST(o_orderkey AS VARCHAR) LIMIT {n}"
KERNEL = [feature("o_custkey", "numeric"), feature("o_orderdate", "datetime", "components")]


@query(
    "shap_sampled",
    f"""WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS b FROM orders), behind AS ({SMALLEST.format(source="orders", n=50)}),
shown AS ({SMALLEST.format(source="orders", n=100)}), m AS (SELECT avg(o_custkey) AS mx FROM behind)
SELECT o_orderkey, 'o_custkey' AS feature, round(b * (o_custkey - mx), 3) + 0.0 AS phi FROM shown, f, m""",
)
def shap_sampled(spark, sf_dir):
    """Any model's contributions from its scores alone: 100 sampled rows against 50 background rows."""
    fitted, rows = order_rows(spark, sf_dir, CUST, _total, "regression")
    model = make_learner("linear_regression").fit(rows, fitted.feature_names)
    got = explain_by_scoring(model, explanation_sample(rows, "o_orderkey"), sample_rows(rows, 50, "o_orderkey"), ["o_orderkey"])
    return got.values.select("o_orderkey", "feature", rnd("phi", 3).alias("phi"))


THREE = {"a": "CAST(o_custkey % 2 AS INT)", "b": "CAST(month(o_orderdate) > 6 AS INT)", "c": "CAST(o_orderpriority < '3' AS INT)"}


@query(
    "shap_kernel",
    f"""WITH bits AS (SELECT o_orderkey, o_totalprice AS y, {", ".join(f"{e} AS {k}" for k, e in THREE.items())} FROM orders),
m AS (SELECT a, b, c, avg(y) AS m FROM bits GROUP BY a, b, c), behind AS ({SMALLEST.format(source="bits", n=50)}), shown AS ({SMALLEST.format(source="bits", n=100)}),
mixed AS (SELECT s.o_orderkey, k, CASE WHEN k & 1 > 0 THEN s.a ELSE h.a END AS a, CASE WHEN k & 2 > 0 THEN s.b ELSE h.b END AS b, CASE WHEN k & 4 > 0 THEN s.c ELSE h.c END AS c
  FROM shown s, behind h, (SELECT unnest(range(8)) AS k)),
v AS (SELECT o_orderkey, k, avg(m) AS v FROM mixed JOIN m USING (a, b, c) GROUP BY o_orderkey, k),
pairs AS (SELECT o_orderkey, j, k, CASE bit_count((k & ~(1 << j))::INT) WHEN 1 THEN 1 / 6 ELSE 1 / 3 END * CASE WHEN k & (1 << j) > 0 THEN v ELSE -v END AS part FROM v, (SELECT unnest([0, 1, 2]) AS j))
SELECT o_orderkey, ['a', 'b', 'c'][j + 1] AS feature, round(sum(part), 3) + 0.0 AS phi, 'exact' AS method FROM pairs GROUP BY o_orderkey, j""",
)
def shap_kernel(spark, sf_dir):
    """A tree over three indicators explained by its scores alone, all coalitions of them."""
    o = table(spark, sf_dir, "orders").withColumns({k: F.expr(e) for k, e in THREE.items()})
    fitted, rows = rows_for(o, spec([feature(k, "numeric") for k in THREE], _total, "regression"), "o_orderkey")
    model = make_learner("random_forest", "regression", ONE_TREE).fit(rows, fitted.feature_names)
    got = explain_by_scoring(model, explanation_sample(rows, "o_orderkey"), sample_rows(rows, 50, "o_orderkey"), ["o_orderkey"])
    return got.values.select("o_orderkey", "feature", rnd("phi", 3).alias("phi"), F.lit(got.method).alias("method"))


@query("shap_sampled_classes")
def shap_sampled_classes(spark, sf_dir):
    """The same for a boosted model of three classes, over all coalitions of its five columns."""
    fitted, rows = order_rows(spark, sf_dir, KERNEL)
    model = make_learner("xgboost", "classification", {"n_estimators": 2, "max_depth": 2}).fit(rows, fitted.feature_names)
    got = explain_by_scoring(model, explanation_sample(rows, "o_orderkey", 20), rows, ["o_orderkey"], n_background=20)
    return got.values.select("o_orderkey", "feature", rnd("phi").alias("phi"))


# -------------------------------------------------------------------------------------- training runs


def _metric_rows(spark, metrics: dict[str, float], digits: int = 4):
    rows = [(m, float(v)) for m, v in metrics.items()]
    return spark.createDataFrame(rows, "metric string, value double").select("metric", rnd("value", digits).alias("value"))


@query("train_flagship")
def train_flagship(spark, sf_dir):
    """Raw lineitem to test metrics: contract, transforms, split, least squares, evaluation."""
    wanted = spec(
        [
            feature("l_quantity", "numeric", "scale"),
            feature("l_discount", "numeric", "minmax"),
            feature("l_returnflag", "categorical", "one-hot"),
            feature("l_shipdate", "datetime", "components"),
        ],
        _price,
        "regression",
    )
    return _metric_rows(spark, train(table(spark, sf_dir, "lineitem"), wanted, "linear_regression").metrics)


def _seeded(seeds: str) -> str:
    return f"""seeds AS (SELECT unnest([{seeds}]) AS seed),
sided AS (SELECT seed, o_custkey + 0.0::DOUBLE AS x, o_totalprice AS y, row_number() OVER (PARTITION BY seed ORDER BY {sql_hash("o_orderkey", "seed")}, CAST(o_orderkey AS VARCHAR))
  <= ceil(0.2 * count(*) OVER (PARTITION BY seed)) AS test FROM orders, seeds),
fits AS (SELECT seed, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM sided WHERE NOT test GROUP BY seed),
scores AS (SELECT seed, sqrt(avg((y - a - b * x) ** 2)) AS rmse, avg(abs(y - a - b * x)) AS mae, 1 - avg((y - a - b * x) ** 2) / var_pop(y) AS r2 FROM sided JOIN fits USING (seed) WHERE test GROUP BY seed)"""


RUN_SPEC = spec(CUST, _total, "regression")


@query(
    "train_linear",
    f"""WITH {_seeded("42")} SELECT 'rmse' AS metric, round(rmse, 4) + 0.0 AS value FROM scores UNION ALL SELECT 'mae', round(mae, 4) + 0.0 FROM scores
UNION ALL SELECT 'r2', round(r2, 4) + 0.0 FROM scores""",
)
def train_linear(spark, sf_dir):
    return _metric_rows(spark, train(table(spark, sf_dir, "orders"), RUN_SPEC, "linear_regression", key="o_orderkey").metrics)


@query(
    "train_iterations",
    f"""WITH {_seeded("42, 43, 44")} SELECT 'rmse' AS metric, round(avg(rmse), 4) + 0.0 AS mean, round(stddev_pop(rmse), 4) + 0.0 AS std, count(*) AS runs FROM scores
UNION ALL SELECT 'mae', round(avg(mae), 4) + 0.0, round(stddev_pop(mae), 4) + 0.0, count(*) FROM scores UNION ALL SELECT 'r2', round(avg(r2), 4) + 0.0, round(stddev_pop(r2), 4) + 0.0, count(*) FROM scores""",
)
def iterated(spark, sf_dir):
    _, table_of = train_iterations(table(spark, sf_dir, "orders"), RUN_SPEC, "linear_regression", 3, key="o_orderkey")
    return table_of.select("metric", rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"), "runs")


def _one_split(name: str, source: str, key: str, x: str, y: str) -> str:
    """CTEs for the test metrics of a straight line fitted on four fifths of a table."""
    return f"""sided_{name} AS (SELECT {x} + 0.0::DOUBLE AS x, {y} AS y, row_number() OVER (ORDER BY {sql_hash(key)}, CAST({key} AS VARCHAR)) <= ceil(0.2 * count(*) OVER ()) AS test FROM {source}),
fit_{name} AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM sided_{name} WHERE NOT test),
scores_{name} AS (SELECT '{name}' AS experiment, sqrt(avg((y - a - b * x) ** 2)) AS rmse, avg(abs(y - a - b * x)) AS mae, 1 - avg((y - a - b * x) ** 2) / var_pop(y) AS r2 FROM sided_{name}, fit_{name} WHERE test)"""


@query(
    "sweep",
    f"""WITH {_one_split("orders", "orders", "o_orderkey", "o_custkey", "o_totalprice")}, {_one_split("events", "events", "event_id", "user_id", "value")},
scores AS (FROM scores_orders UNION ALL FROM scores_events)
SELECT experiment, metric, 'linear_regression' AS best_model, round(CASE metric WHEN 'rmse' THEN rmse WHEN 'mae' THEN mae ELSE r2 END, 4) + 0.0 AS best_value FROM scores, (SELECT unnest(['rmse', 'mae', 'r2']) AS metric)""",
)
def swept(spark, sf_dir):
    """Two tables with the models that their tasks allow: best model by metric."""
    tables = {
        "orders": (table(spark, sf_dir, "orders"), RUN_SPEC),
        "events": (table(spark, sf_dir, "events"), spec([feature("user_id", "numeric")], ("value", "continuous"), "regression")),
    }
    got = sweep(tables, ("logistic_regression", "linear_regression"), None, {"orders": "o_orderkey", "events": "event_id"})
    return got.best.withColumn("best_value", rnd("best_value", 4))


@query("train_text")
def train_text(spark, sf_dir):
    """Document quality from term weights, language and length."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    wanted = spec(
        [feature("text", "text", "tfidf"), feature("lang", "categorical", "one-hot"), feature("n_chars", "numeric", "scale")],
        ("quality", "binary"),
        "classification",
    )
    return _metric_rows(spark, train(docs, wanted, "logistic_regression", key="doc_id").metrics)


# --------------------------------------------------------------------------------------------- scoring

EVENT = [feature("user_id", "numeric", "scale")]
SCORED = """WITH f AS (SELECT regr_intercept(value, user_id) AS a, regr_slope(value, user_id) AS b FROM events)
SELECT event_id, event_type, round(a + b * user_id, 5) + 0.0 AS prediction FROM events, f"""


def _event_model(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    fitted, rows = rows_for(ev, spec(EVENT, ("value", "continuous"), "regression"))
    return ev, make_learner("linear_regression").fit(rows, fitted.feature_names), fitted


@query("score_batch", SCORED)
def score_batch(spark, sf_dir):
    ev, model, fitted = _event_model(spark, sf_dir)
    return score(ev, model, fitted, ["event_id", "event_type"]).select("event_id", "event_type", rnd("prediction", 5).alias("prediction"))


def _stream(spark, sf_dir, name: str):
    source = spark.readStream.schema(table(spark, sf_dir, name).schema).option("pathGlobFilter", f"{name}.parquet")
    return source.parquet(sf_dir)


@query("score_stream", SCORED)
def scored_stream(spark, sf_dir):
    """The same rows, arriving as a stream and scored once each."""
    _, model, fitted = _event_model(spark, sf_dir)
    path, checkpoint = new_path(spark, "scored"), new_path(spark, "scored-checkpoint")
    q = score_stream(_stream(spark, sf_dir, "events"), model, fitted, path, checkpoint, ["event_id", "event_type"], once=True)
    q.awaitTermination()
    return spark.read.parquet(path).select("event_id", "event_type", rnd("prediction", 5).alias("prediction"))


@query(
    "score_stream_routed",
    """WITH coded AS (SELECT *, dense_rank() OVER (ORDER BY event_type) - 1.0 AS code FROM events),
m AS (SELECT covar_pop(user_id, user_id) AS aa, covar_pop(code, code) AS bb, covar_pop(user_id, code) AS ab, covar_pop(user_id, value) AS ay, covar_pop(code, value) AS b_y, avg(user_id) AS ma, avg(code) AS mb, avg(value) AS my FROM coded),
c AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS ca, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM m)
SELECT event_id, CASE WHEN event_id % 10 != 0 AND event_id % 7 != 3 THEN round(my + ca * (user_id - ma) + cb * (code - mb), 4) + 0.0 END AS prediction,
  concat_ws(',', CASE WHEN event_id % 10 = 0 THEN 'numeric:user_id' END, CASE WHEN event_id % 7 = 3 THEN 'unseen:event_type' END) AS problems FROM coded, c""",
)
def scored_stream_routed(spark, sf_dir):
    """Events with made bad numbers and labels, a third of them twice: the good ones are scored once, the bad ones go to a sink of their own."""
    ev = table(spark, sf_dir, "events")
    fitted, rows = rows_for(ev, spec([feature("user_id", "numeric"), feature("event_type", "categorical", "label")], ("value", "continuous"), "regression"))
    model = make_learner("linear_regression").fit(rows, fitted.feature_names)
    k = F.col("event_id")
    dirty = _stream(spark, sf_dir, "events").withColumns({"user_id": F.when(k % 10 == 0, "oops").otherwise(F.col("user_id").cast("string")), "event_type": F.when(k % 7 == 3, "strange").otherwise(F.col("event_type"))})
    twice = dirty.withColumn("copy", F.explode(F.when(k % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("copy")
    base = new_path(spark, "routed")
    score_stream(twice, model, fitted, f"{base}/good", f"{base}/checkpoint", ["event_id"], once=True, event_key=["event_id"], event_time="ts", late="1 hour", bad=f"{base}/bad").awaitTermination()
    good = spark.read.parquet(f"{base}/good").select("event_id", rnd("prediction", 4).alias("prediction"), F.lit("").alias("problems"))
    bad = spark.read.parquet(f"{base}/bad").select("event_id", F.lit(None).cast("double").alias("prediction"), F.array_join("problems", ",").alias("problems"))
    return good.unionByName(bad)


@query(
    "score_labels",
    """WITH best AS (SELECT o_orderpriority, o_orderstatus AS predicted FROM orders GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC, o_orderstatus) = 1)
SELECT o_orderkey, predicted FROM orders JOIN best USING (o_orderpriority)""",
)
def score_labels(spark, sf_dir):
    """Predicted classes come back under their original names."""
    o = table(spark, sf_dir, "orders")
    fitted, rows = rows_for(o, spec([feature("o_orderpriority", "categorical", "one-hot")], _status, "classification"))
    model = make_learner("random_forest", "classification", ONE_TREE).fit(rows, fitted.feature_names)
    return score(o, model, fitted, ["o_orderkey"]).select("o_orderkey", "predicted")


@query(
    "quarantine_stream",
    """SELECT event_id, CASE WHEN value >= 5 AND value <= 90 THEN 'good' ELSE 'bad' END AS side FROM events""",
)
def quarantined_stream(spark, sf_dir):
    wanted = spec([feature("value", "numeric", constraints={"min": 5, "max": 90})], ("value", "continuous"))
    base = new_path(spark, "quarantine")
    quarantine_stream(_stream(spark, sf_dir, "events"), wanted, f"{base}/good", f"{base}/bad", f"{base}/checkpoint", once=True).awaitTermination()
    sides = [spark.read.parquet(f"{base}/{s}").select("event_id", F.lit(s).alias("side")) for s in ("good", "bad")]
    return sides[0].unionByName(sides[1])

