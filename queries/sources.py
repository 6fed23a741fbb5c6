"""Reading, sampling, storing and logging."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import feature, query, rnd, spec, sql_hash, table
from tablewright.functions.storage import new_path
from tablewright.operators.models import Trained, make_learner
from tablewright.operators.transforms import FittedTable, fit_transforms
from tablewright.sources.files import read_table, sample_rows
from tablewright.sources.runs import append_runs, best_runs, list_runs, read_runs

LINE_SPEC = spec(
    [
        feature("l_quantity", "numeric", "scale"),
        feature("l_discount", "numeric", "minmax"),
        feature("l_returnflag", "categorical", "one-hot"),
        feature("l_linestatus", "categorical", "label"),
        feature("l_shipdate", "datetime", "components"),
    ],
    ("l_extendedprice", "continuous"),
    "regression",
)
ONE_FEATURE = spec([feature("l_quantity", "numeric")], ("l_extendedprice", "continuous"), "regression")


@query(
    "scan_csv",
    """SELECT doc_id, lang, CASE WHEN doc_id % 7 != 0 THEN source END AS source, n_chars, md5(text) AS text_md5 FROM documents""",
)
def scan_csv(spark, sf_dir):
    """Free text with quotes, commas and line breaks through a CSV folder and back."""
    path = new_path(spark, "csv") + ".csv"
    docs = table(spark, sf_dir, "documents")
    missing = F.when(F.col("doc_id") % 7 != 0, F.col("source")).when(F.col("doc_id") % 2 == 0, F.lit("N/A"))
    docs.withColumn("source", missing).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    back = read_table(spark, path)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "scan_json",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, round(value, 6) + 0.0 AS value, props FROM events""",
)
def scan_json(spark, sf_dir):
    path = new_path(spark, "json") + ".jsonl"
    table(spark, sf_dir, "events").write.json(path)
    back = read_table(spark, path).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", rnd("value").alias("value"), "props")
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "scan_parquet",
    "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem",
)
def scan_parquet(spark, sf_dir):
    li = read_table(spark, f"{sf_dir}/lineitem.parquet")
    return li.withColumns({"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), "l_linenumber": F.col("l_linenumber").cast("long")})


@query(
    "sample_rows",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY {sql_hash('o_orderkey')}, CAST(o_orderkey AS VARCHAR) LIMIT 100",
)
def sample(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sample_rows(o, 100, "o_orderkey", 42)


@query(
    "model_roundtrip",
    """SELECT l_orderkey, l_quantity, round(regr_intercept(l_extendedprice, l_quantity) OVER () +
  l_quantity * regr_slope(l_extendedprice, l_quantity) OVER (), 4) + 0.0 AS prediction FROM lineitem""",
)
def model_roundtrip(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = fit_transforms(li, ONE_FEATURE).transform(li, label="label").select("l_orderkey", "l_quantity", "features", "label")
    path = new_path(spark, "model")
    make_learner("linear_regression").fit(rows, ["l_quantity"]).save(spark, path)
    scored = Trained.load(spark, path).predict(rows)
    return scored.select("l_orderkey", "l_quantity", rnd("prediction", 4).alias("prediction"))


ASSEMBLED = """WITH f AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem)
SELECT l_orderkey, round((l_quantity - m) / s, 6) + 0.0 AS l_quantity, round((l_discount - lo) / (hi - lo), 6) + 0.0 AS l_discount,
  CAST(l_returnflag = 'A' AS INT) + 0.0::DOUBLE AS flag_a, CAST(l_returnflag = 'N' AS INT) + 0.0::DOUBLE AS flag_n,
  CAST(l_returnflag = 'R' AS INT) + 0.0::DOUBLE AS flag_r, CAST(l_linestatus = 'O' AS INT) + 0.0::DOUBLE AS status,
  year(l_shipdate) + 0.0::DOUBLE AS year, month(l_shipdate) + 0.0::DOUBLE AS month, day(l_shipdate) + 0.0::DOUBLE AS day,
  isodow(l_shipdate) - 1 + 0.0::DOUBLE AS dayofweek
FROM lineitem, f"""
ASSEMBLED_NAMES = ("l_quantity", "l_discount", "flag_a", "flag_n", "flag_r", "status", "year", "month", "day", "dayofweek")


def assembled(df, fitted: FittedTable):
    from pyspark.ml.functions import vector_to_array

    rows = fitted.transform(df).select("l_orderkey", vector_to_array("features").alias("v"))
    return rows.select("l_orderkey", *[rnd(F.col("v")[i]).alias(n) for i, n in enumerate(ASSEMBLED_NAMES)])


@query("preprocessor_roundtrip", ASSEMBLED)
def preprocessor_roundtrip(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    path = new_path(spark, "preprocessor")
    fit_transforms(li, LINE_SPEC).save(spark, path)
    return assembled(li, FittedTable.load(spark, path))


def logged_runs(spark, sf_dir):
    """Run rows made from the data: a month of shipping plays the part of a run, a return flag of an experiment."""
    month = F.date_format("l_shipdate", "yyyy-MM")
    by = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("experiment"), month.alias("run_id"))
    rows = by.agg(
        F.stddev_pop("l_quantity").alias("rmse"), F.avg("l_discount").alias("r2"), F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("at")
    )
    nothing = {
        "training_date": "string", "training_time": "double", "iterations": "int", "model_path": "string",
        "history": "array<struct<metrics: map<string,double>, timestamp: double, epoch: int, iteration: int>>",
        "preprocessing": "map<string,string>",
    }
    return rows.select(
        "run_id",
        "experiment",
        F.concat_ws("_", "experiment", "run_id").alias("model"),
        F.when(F.month(F.to_date("run_id", "yyyy-MM")) <= 6, "random_forest").otherwise("xgboost").alias("model_type"),
        F.lit("regression").alias("task_type"),
        F.month(F.to_date("run_id", "yyyy-MM")).alias("iteration"),
        F.col("at").cast("timestamp").alias("logged_at"),
        F.when(F.col("n") % 2 == 0, F.col("n").cast("int")).alias("epochs"),
        F.col("n").alias("n_samples_trained"),
        F.lit(10).alias("n_features"),
        F.when(F.col("n") % 3 == 0, F.create_map(F.lit("n_estimators"), F.col("n").cast("string")))
        .when(F.col("n") % 3 == 1, F.create_map(F.lit("max_depth"), F.lit("5")))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("hyperparameters"),
        F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("r2"), F.col("r2")).alias("metrics"),
        *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()],
    )


RUNS = """runs AS (SELECT l_returnflag AS experiment, strftime(l_shipdate, '%Y-%m') AS run_id, stddev_pop(l_quantity) AS rmse,
  avg(l_discount) AS r2, count(*) AS n, max(l_shipdate) AS shipped,
  CASE WHEN month(max(l_shipdate)) <= 6 THEN 'random_forest' ELSE 'xgboost' END AS model_type FROM lineitem GROUP BY 1, 2)"""


def _stored_runs(spark, sf_dir):
    path = new_path(spark, "runs")
    append_runs(logged_runs(spark, sf_dir), path)
    return read_runs(spark, path)


@query(
    "run_log",
    f"""WITH {RUNS} SELECT experiment, run_id, model_type, n AS n_samples_trained, 'rmse' AS metric, round(rmse, 6) + 0.0 AS value FROM runs
UNION ALL SELECT experiment, run_id, model_type, n, 'r2', round(r2, 6) + 0.0 FROM runs""",
)
def run_log(spark, sf_dir):
    runs = _stored_runs(spark, sf_dir)
    long = runs.select("experiment", "run_id", "model_type", "n_samples_trained", F.explode("metrics").alias("metric", "value"))
    return long.withColumn("value", rnd("value"))


@query(
    "list_runs",
    f"""WITH {RUNS} SELECT experiment, run_id, model_type, n AS n_samples_trained, round(rmse, 6) + 0.0 AS rmse FROM runs
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY shipped DESC, run_id DESC) = 1""",
)
def runs_latest(spark, sf_dir):
    newest = list_runs(_stored_runs(spark, sf_dir))
    return newest.select("experiment", "run_id", "model_type", "n_samples_trained", rnd(F.col("metrics")["rmse"]).alias("rmse"))


@query(
    "best_runs",
    f"""WITH {RUNS}, long AS (SELECT 'rmse' AS metric, experiment, run_id, rmse AS value, rmse AS o FROM runs
UNION ALL SELECT 'r2', experiment, run_id, r2, -r2 FROM runs)
SELECT metric, experiment, run_id, round(value, 6) + 0.0 AS value FROM long QUALIFY row_number() OVER (PARTITION BY metric ORDER BY o, run_id) = 1""",
)
def runs_best(spark, sf_dir):
    return best_runs(_stored_runs(spark, sf_dir)).select("metric", "experiment", "run_id", rnd("value").alias("value"))
