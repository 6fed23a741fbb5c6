"""Cross-validation, search over parameters, and comparison of models."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.foldstats import fold_scores
from tablewright.operators.metrics import CLASSIFICATION, LOWER_IS_BETTER, REGRESSION, metric_frame
from tablewright.operators.models import Learner, Trained, check_params, usable_params

# Search spaces of the models that are tuned, and the number of folds and draws.
GRIDS: dict[str, dict[str, list[Any]]] = {
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20, 30], "min_samples_split": [2, 5, 10]},
    "xgboost": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [3, 5, 7]},
}
TUNING_FOLDS, TUNING_DRAWS, TUNING_SEED = 3, 10, 42


def run_parallel(spark, jobs: Sequence[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Spark jobs side by side from driver threads; each thread only waits for the cluster."""
    if parallelism <= 1 or len(jobs) == 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def _fold_scores(learner: Learner, df: DataFrame, fold: int, metrics: Sequence[str], classes: int | None) -> dict[str, float]:
    """One fit, all metrics from its one prediction pass; the model is dropped before the next fit."""
    trained = learner.fit(df.where(F.col("fold") != fold), classes=classes)
    scored = trained.predict(df.where(F.col("fold") == fold)).select("label", "prediction")
    values = metric_frame(scored, metrics, average="weighted").first().asDict()
    return {m: -v if m in LOWER_IS_BETTER else v for m, v in values.items()}


def _least_squares(learner: Learner, df: DataFrame, candidates: Sequence[dict[str, Any]], metrics: Sequence[str]) -> list[tuple[int, int, dict[str, float]]] | None:
    """(candidate, fold, scores) of a linear regression from one pass over ``df``; None for other models and very wide tables."""
    if learner.model_type != "linear_regression":
        return None
    settings = [check_params(learner.model_type, usable_params(learner.model_type, learner.with_params(p).params)) for p in candidates]
    found = fold_scores(df.select("features", "label", "fold"), settings, metrics)
    return found and [(k, f, {m: -v if m in LOWER_IS_BETTER else v for m, v in values.items()}) for k, f, values in found]


def _usable(metrics: Sequence[str], task: str) -> list[str]:
    return [m for m in metrics if m in (CLASSIFICATION if task == "classification" else REGRESSION)]


def _n_classes(df: DataFrame, task: str) -> int | None:
    if task != "classification":
        return None
    return int(df.agg(F.max("label")).first()[0]) + 1


def cross_validate(
    learner: Learner, df: DataFrame, metrics: Sequence[str], parallelism: int = 2, per_fold: bool = False
) -> DataFrame:
    """(metric, score, std, folds) over the folds of ``df`` (columns features, label, fold).

    Higher is better throughout: class metrics are support-weighted, error metrics negated. Metrics that do not
    suit the task are left out. One fit per fold serves all metrics; least squares take one pass over all folds together.
    ``per_fold`` gives (fold, metric, score).
    """
    spark = df.sparkSession
    use = _usable(metrics, learner.task)
    if not use:
        raise ValueError(f"no metric of {list(metrics)} suits {learner.task}")
    if solved := _least_squares(learner, df, [{}], use):
        scores = spark.createDataFrame([(f, m, values[m]) for _, f, values in solved for m in use], "fold int, metric string, score double")
        return scores if per_fold else fold_summary(scores)
    table = df.select("features", "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = sorted(r.fold for r in table.select("fold").distinct().collect())
        classes = _n_classes(table, learner.task)
        jobs = [lambda f=f: _fold_scores(learner, table, f, use, classes) for f in folds]
        results = run_parallel(spark, jobs, parallelism)
    finally:
        table.unpersist()
    rows = [(f, m, float(r[m])) for f, r in zip(folds, results, strict=True) for m in use]
    scores = spark.createDataFrame(rows, "fold int, metric string, score double")
    return scores if per_fold else fold_summary(scores)


def fold_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("metric").agg(
        F.avg("score").alias("score"), F.stddev_pop("score").alias("std"), F.count(F.lit(1)).alias("folds")
    )


@dataclass
class Tuned:
    best_params: dict[str, Any]
    best_score: float
    model: Trained
    candidates: DataFrame  # (candidate, params, score, std), best first


def grid(space: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    names = sorted(space)
    return [dict(zip(names, values, strict=True)) for values in itertools.product(*(space[n] for n in names))]


def draw(space: Mapping[str, Sequence[Any]], n: int, seed: int) -> list[dict[str, Any]]:
    """n different combinations of the grid (all of them if it has fewer)."""
    whole = grid(space)
    return whole if n >= len(whole) else random.Random(seed).sample(whole, n)


def tune(
    learner: Learner,
    df: DataFrame,
    space: Mapping[str, Sequence[Any]],
    method: str = "grid",
    n_iter: int = TUNING_DRAWS,
    scoring: str | None = None,
    seed: int = TUNING_SEED,
    parallelism: int = 2,
    feature_names: list[str] | None = None,
) -> Tuned:
    """Score every candidate over the folds of ``df`` (features, label, fold) and refit the best on all rows.

    Scoring defaults to accuracy for classes and r2 for values. Ties go to the earlier candidate.
    """
    if method not in ("grid", "random"):
        raise ValueError(f"Unsupported tuning method: {method}")
    scoring = scoring or ("accuracy" if learner.task == "classification" else "r2")
    candidates = grid(space) if method == "grid" else draw(space, n_iter, seed)
    spark = df.sparkSession
    table = df.select("features", "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classes = _n_classes(table, learner.task)
        if solved := _least_squares(learner, table, candidates, [scoring]):
            scored = [(i, f, values[scoring]) for i, f, values in solved]
        else:
            folds = sorted(r.fold for r in table.select("fold").distinct().collect())
            jobs = [
                lambda p=p, f=f: _fold_scores(learner.with_params(p), table, f, [scoring], classes)[scoring]
                for p in candidates
                for f in folds
            ]
            owners = [(i, f) for i in range(len(candidates)) for f in folds]
            scored = [(i, f, float(s)) for (i, f), s in zip(owners, run_parallel(spark, jobs, parallelism), strict=True)]
        rows = [(i, {k: str(v) for k, v in candidates[i].items()}, f, s) for i, f, s in scored]
        long = spark.createDataFrame(rows, "candidate int, params map<string,string>, fold int, score double")
        table_of = (
            long.groupBy("candidate")
            .agg(F.first("params").alias("params"), F.avg("score").alias("score"), F.stddev_pop("score").alias("std"))
            .orderBy(F.desc("score"), "candidate")
        )
        best = table_of.first()
        winner = candidates[best.candidate]
        model = learner.with_params(winner).fit(table, feature_names, classes=classes)
    finally:
        table.unpersist()
    model.metadata["tuned_params"] = winner
    model.metadata["tuning_score"] = best.score
    return Tuned(winner, best.score, model, table_of)


def compare_models(results: DataFrame) -> DataFrame:
    """(model, metric, value) -> (metric, best_model, best_value, models) for the metrics every model has.
    Errors are better low, the rest high; ties go to the smaller model name."""
    n_models = results.agg(F.count_distinct("model")).first()[0]
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    rank = F.struct(F.when(lower, F.col("value")).otherwise(-F.col("value")).alias("v"), F.col("model"))
    best = results.groupBy("metric").agg(F.min(rank).alias("b"), F.count_distinct("model").alias("models"))
    common = best.where(F.col("models") == n_models)
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    value = F.when(lower, F.col("b.v")).otherwise(-F.col("b.v"))
    return common.select("metric", F.col("b.model").alias("best_model"), value.alias("best_value"), "models")


# The advice given for each weakness of a run.
ADVICE = {
    "epochs": "Consider increasing number of epochs for better convergence",
    "samples": "Consider collecting more training data",
    "forest": "Consider increasing n_estimators for Random Forest",
    "boosted": "Consider tuning max_depth parameter for XGBoost",
}


def suggest_improvements(runs: DataFrame) -> DataFrame:
    """(model, suggestions) of the runs that have any. ``runs`` holds model, model_type, epochs, n_samples_trained
    and the map hyperparameters."""
    trees = F.coalesce(F.col("hyperparameters")["n_estimators"].try_cast("double"), F.lit(0.0))
    no_depth = ~F.coalesce(F.map_contains_key("hyperparameters", F.lit("max_depth")), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(F.col("epochs") < 100, F.lit(ADVICE["epochs"])),
            F.when(F.col("n_samples_trained") < 1000, F.lit(ADVICE["samples"])),
            F.when((F.col("model_type") == "random_forest") & (trees < 100), F.lit(ADVICE["forest"])),
            F.when((F.col("model_type") == "xgboost") & no_depth, F.lit(ADVICE["boosted"])),
        )
    )
    return runs.select("model", found.alias("suggestions")).where(F.size("suggestions") > 0)


def iteration_summary(results: DataFrame) -> DataFrame:
    """(metric, value) rows of repeated runs -> (metric, mean, std, runs), population deviation."""
    return results.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("runs")
    )
