"""Training runs: one, several with different seeds, or a sweep over tables and models."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.contract import validate
from tablewright.operators.metrics import evaluate
from tablewright.operators.models import Trained, make_learner
from tablewright.operators.selection import GRIDS, TUNING_DRAWS, TUNING_FOLDS, compare_models, cross_validate, iteration_summary, run_parallel, tune
from tablewright.operators.split import assign_folds
from tablewright.operators.transforms import FittedTable
from tablewright.plans.prepare import KEY, Prepared, prepare
from tablewright.sources.runs import append_runs, run_row, runs_frame
from tablewright.spec import ITERATION_KEYS, TableSpec, check_model_fits, merged_config


@dataclass
class TrainResult:
    trained: Trained
    fitted: FittedTable
    metrics: dict[str, float]
    run: dict[str, Any]
    cv: DataFrame | None = None


def train(
    df: DataFrame,
    spec: TableSpec,
    model_type: str,
    config: dict[str, Any] | None = None,
    key: str | Sequence[str] | None = None,
    output: str | None = None,
    experiment: str = "default",
    tune_model: bool = False,
    iteration: int = 0,
    check_first: bool = True,
) -> TrainResult:
    """Check, prepare, fit (or tune), evaluate on the test rows, and with ``output`` save model, parameters and
    a run log under it. ``key`` names what identifies a row; without it the whole row does."""
    check_model_fits(model_type, spec)
    cfg = merged_config(spec, config)
    cfg["random_state"] += iteration
    prepared = prepare(df, spec, cfg, key, check_first)
    try:
        return _run(prepared, spec, model_type, cfg, output, experiment, tune_model, iteration)
    finally:
        prepared.release()


def _run(prepared: Prepared, spec, model_type, cfg, output, experiment, tune_model, iteration) -> TrainResult:
    spark = prepared.table.sparkSession
    fitted = prepared.fitted
    params = {**{k: cfg[k] for k in ITERATION_KEYS if k in cfg}, **cfg["model_params"]}
    learner = make_learner(model_type, spec.task, params, cfg["random_state"])
    side, names = prepared.side("train"), fitted.feature_names
    classes = fitted.n_classes or None
    parallelism = cfg.get("parallelism", 2)
    space = cfg.get("param_grid") or GRIDS.get(learner.model_type)
    if tune_model and space:
        folded = assign_folds(side, cfg.get("tuning_folds", TUNING_FOLDS), KEY, cfg["random_state"])
        n_iter = cfg.get("n_iter", TUNING_DRAWS)
        method = cfg.get("tuning_method", "random" if n_iter > 1 else "grid")
        trained = tune(learner, folded, space, method, n_iter, cfg.get("scoring"), parallelism=parallelism, feature_names=names).model
    else:
        if tune_model:
            warnings.warn(f"no parameter grid for {model_type}: fitted without tuning", stacklevel=3)
        trained = learner.fit(side, names, classes=classes, key=KEY)
    cv = None
    if cfg["cross_validation"]:
        cv = cross_validate(learner, assign_folds(side, cfg["cv_folds"], KEY, cfg["random_state"]), cfg["metrics"], parallelism)
    average = "binary" if spec.target_type == "binary" and (classes or 0) == 2 else "weighted"
    metrics = evaluate(trained, prepared.side("test"), cfg["metrics"], average)
    about = {
        "test_size": cfg["test_size"],
        "random_state": cfg["random_state"],
        "stratify": cfg["stratify"],
        "fit_on": cfg.get("fit_on", "all"),
        "transformers": [f"{b.name}:{b.kind}" for b in fitted.blocks],
    }
    trained.metadata["n_features"] = len(names)
    run = run_row(experiment, trained.metadata, metrics, iteration + 1, None, about)
    if output:
        run["model_path"] = f"{output}/models/{experiment}/{run['run_id']}"
        trained.save(spark, run["model_path"])
        fitted.save(spark, f"{run['model_path']}/preprocessor")
        append_runs(runs_frame(spark, [run]), f"{output}/runs")
    return TrainResult(trained, fitted, metrics, run, cv)


def load_trained(spark, path: str) -> tuple[Trained, FittedTable]:
    return Trained.load(spark, path), FittedTable.load(spark, f"{path}/preprocessor")


def train_iterations(
    df: DataFrame,
    spec: TableSpec,
    model_type: str,
    n: int,
    config: dict[str, Any] | None = None,
    key: str | Sequence[str] | None = None,
    **kwargs: Any,
) -> tuple[list[TrainResult], DataFrame]:
    """``n`` runs with seeds one apart, and (metric, mean, std, runs) over them. The table is checked, and its
    features made, once; only the split and the fit repeat. A failing first run is an error; later ones are left out with a warning."""
    check_model_fits(model_type, spec)
    validate(df, spec)
    cfg = merged_config(spec, config)
    once = cfg.get("fit_on", "all") == "all"
    results: list[TrainResult] = []
    shared: Prepared | None = None
    try:
        for i in range(n):
            seeded = {**cfg, "random_state": cfg["random_state"] + i}
            prepared = None
            try:
                prepared = shared.resplit(spec, seeded) if shared else prepare(df, spec, seeded, key, check_first=False)
                shared = prepared if once else None
                where = kwargs.get("output"), kwargs.get("experiment", "default")
                results.append(_run(prepared, spec, model_type, seeded, *where, kwargs.get("tune_model", False), i))
            except Exception as err:
                if i == 0:
                    raise
                warnings.warn(f"run {i + 1} failed and is left out: {err}", stacklevel=2)
            finally:
                if prepared and not once:
                    prepared.release()
    finally:
        if shared:
            shared.release()
    rows = [(r.run["iteration"], m, v) for r in results for m, v in r.metrics.items()]
    long = df.sparkSession.createDataFrame(rows, "iteration int, metric string, value double")
    return results, iteration_summary(long)


@dataclass
class Sweep:
    runs: DataFrame  # run rows
    best: DataFrame  # (experiment, metric, best_model, best_value)
    failures: DataFrame  # (experiment, model_type, error)


def sweep(
    tables: Mapping[str, tuple[DataFrame, TableSpec]],
    model_types: Sequence[str],
    config: dict[str, Any] | None = None,
    keys: Mapping[str, str | Sequence[str]] | None = None,
    output: str | None = None,
    parallelism: int = 2,
) -> Sweep:
    """Every table with every model its task allows; incompatible pairs are passed over, failures are listed.
    A table is prepared once for all its models."""
    spark = next(iter(tables.values()))[0].sparkSession
    done: list[dict[str, Any]] = []
    failed: list[tuple[str, str, str]] = []
    for name, (df, spec) in tables.items():
        fitting = []
        for m in model_types:
            try:
                check_model_fits(m, spec)
                fitting.append(m)
            except ValueError:
                continue
        if not fitting:
            continue
        cfg = merged_config(spec, config)
        try:
            prepared = prepare(df, spec, cfg, (keys or {}).get(name))
        except Exception as err:
            failed += [(name, m, str(err)) for m in fitting]
            continue

        def attempt(m: str, prepared=prepared, spec=spec, cfg=cfg, name=name):
            try:
                return _run(prepared, spec, m, cfg, output, name, False, 0).run
            except Exception as err:
                return (name, m, str(err))

        try:
            for outcome in run_parallel(spark, [lambda m=m: attempt(m) for m in fitting], parallelism):
                (failed if isinstance(outcome, tuple) else done).append(outcome)
        finally:
            prepared.release()
    runs = runs_frame(spark, done)
    best = None
    for name in sorted({r["experiment"] for r in done}):
        of_table = runs.where(F.col("experiment") == name).select(F.col("model_type").alias("model"), F.explode("metrics").alias("metric", "value"))
        part = compare_models(of_table).select(F.lit(name).alias("experiment"), "metric", "best_model", "best_value")
        best = part if best is None else best.unionByName(part)
    if best is None:
        best = spark.createDataFrame([], "experiment string, metric string, best_model string, best_value double")
    return Sweep(runs, best, spark.createDataFrame(failed, "experiment string, model_type string, error string"))
