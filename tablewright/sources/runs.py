"""The log of training runs: appended Parquet, read back as a table."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.metrics import LOWER_IS_BETTER

RUN_SCHEMA = """
    run_id string, experiment string, model string, model_type string, task_type string, iteration int, logged_at timestamp,
    training_date string, training_time double, epochs int, iterations int, n_samples_trained long,
    n_features int, model_path string, hyperparameters map<string,string>, metrics map<string,double>,
    history array<struct<metrics: map<string,double>, timestamp: double, epoch: int, iteration: int>>,
    preprocessing map<string,string>
"""


def run_row(
    experiment: str,
    metadata: dict[str, Any],
    metrics: dict[str, float],
    iteration: int = 1,
    model_path: str | None = None,
    preprocessing: dict[str, Any] | None = None,
) -> dict[str, Any]:
    """One log row from a model's metadata and its test metrics."""

    def as_text(values: dict[str, Any] | None) -> dict[str, str]:
        return {k: v if isinstance(v, str) else json.dumps(v) for k, v in (values or {}).items()}

    history = [
        {"metrics": h["metrics"], "timestamp": h["timestamp"], "epoch": h.get("epoch"), "iteration": h.get("iteration")}
        for h in metadata.get("performance_history", [])
    ]
    return {
        "run_id": uuid.uuid4().hex,
        "experiment": experiment,
        "model": f"{metadata['model_type']}_iter{iteration}",
        "logged_at": datetime.now(timezone.utc).replace(tzinfo=None),
        "iteration": iteration,
        "model_path": model_path,
        "hyperparameters": as_text(metadata.get("hyperparameters")),
        "metrics": {k: float(v) for k, v in metrics.items()},
        "history": history,
        "preprocessing": as_text(preprocessing),
        **{k: metadata.get(k) for k in ("model_type", "task_type", "training_date", "training_time", "epochs", "iterations", "n_samples_trained", "n_features")},
    }


def runs_frame(spark: SparkSession, rows: list[dict[str, Any]]) -> DataFrame:
    empty = spark.createDataFrame([], RUN_SCHEMA)
    return spark.createDataFrame([tuple(r[c] for c in empty.columns) for r in rows], empty.schema)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def list_runs(runs: DataFrame) -> DataFrame:
    """The latest run of every experiment."""
    newest = F.max_by(F.struct(*runs.columns), F.struct("logged_at", "run_id")).alias("r")
    return runs.groupBy("experiment").agg(newest).select("r.*")


def best_runs(runs: DataFrame) -> DataFrame:
    """(metric, experiment, run_id, model_type, value): the best run by every metric logged."""
    long = runs.select("experiment", "run_id", "model_type", F.explode("metrics").alias("metric", "value"))
    order = F.struct(F.when(F.col("metric").isin(*LOWER_IS_BETTER), F.col("value")).otherwise(-F.col("value")), "run_id")
    best = F.min_by(F.struct("experiment", "run_id", "model_type", "value"), order).alias("b")
    return long.groupBy("metric").agg(best).select("metric", "b.*")
