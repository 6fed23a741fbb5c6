"""Estimators by (model type, task), with the parameter names users of tabular libraries know."""

from __future__ import annotations

import json
import time
import warnings
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.columns import portable_hash
from tablewright.functions.storage import ensure_checkpoints
from tablewright.operators import boosting
from tablewright.operators.boosting import BoostedTrees
from tablewright.operators.condense import WEIGHT, condensed, different_rows, worth_it
from tablewright.operators.svm import EPSILON, RandomFeatures, fit_svr, scale_gamma
from tablewright.spec import ITERATION_KEYS, MODELS_BY_TASK

# Defaults of the parameters users may leave out.
FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": None}
BOOSTED_DEFAULTS = boosting.DEFAULTS
DEEPEST = 30  # the deepest tree Spark ML grows; stands for "no limit"

NOT_FOR_BOOSTED = ("batch_size", "early_stopping", "early_stopping_patience", "validation_split")


def infer_task(model_type: str) -> str:
    name = model_type.lower()
    if "classifier" in name:
        return "classification"
    return "regression" if "regressor" in name or name in ("linear_regression", "svr") else "classification"


#: Parameters by model. A name of another model is left out with a warning, so that one set can serve several models.
PARAMETERS = {
    "random_forest": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "bootstrap", "max_samples", "max_bins", "criterion"},
    "xgboost": set(BOOSTED_DEFAULTS),
    "logistic_regression": {"penalty", "C", "l1_ratio", "fit_intercept", "max_iter", "tol"},
    "linear_regression": {"fit_intercept"},
    "svm": {"C", "kernel", "gamma", "epsilon", "max_iter", "n_components"},
}
WITHOUT_EFFECT = {"n_jobs", "verbose", "verbosity", "random_state"}  # the cluster and the seed of the learner decide these
KERNELS = ("rbf", "linear")
PENALTIES = {None: 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": None}  # share of the absolute penalty; None: ``l1_ratio`` gives it


def check_params(model_type: str, params: dict[str, Any]) -> dict[str, Any]:
    """The parameters that the model knows. Names that no model knows, and values that cannot be had, are errors."""
    mine = PARAMETERS.get(model_type, set())
    known = set().union(*PARAMETERS.values(), WITHOUT_EFFECT, ITERATION_KEYS)
    if strange := sorted(set(params) - known):
        raise ValueError(f"no model has these parameters: {', '.join(strange)}")
    if unused := sorted(set(params) - mine - WITHOUT_EFFECT):
        warnings.warn(f"{model_type} has no {', '.join(unused)}", stacklevel=3)
    used = {k: v for k, v in params.items() if k in mine}
    if used.get("max_depth") is not None and int(used["max_depth"]) > DEEPEST:
        raise ValueError(f"trees are at most {DEEPEST} deep, max_depth is {used['max_depth']}")
    if used.get("kernel", "rbf") not in KERNELS:
        raise NotImplementedError(f"kernel {used['kernel']!r}; there are {', '.join(KERNELS)}")
    if used.get("penalty", "l2") not in PENALTIES:
        raise ValueError(f"penalty {used['penalty']!r}")
    return used


def usable_params(model_type: str, params: dict[str, Any] | None) -> dict[str, Any]:
    """The parameters that apply to the model; ``epochs`` of a boosted model are its trees."""
    given = dict(params or {})
    if model_type != "xgboost":
        return {k: v for k, v in given.items() if k not in ITERATION_KEYS}
    if "epochs" in given:
        given.setdefault("n_estimators", given["epochs"])
    return {k: v for k, v in given.items() if k not in NOT_FOR_BOOSTED and k != "epochs"}


def _forest_params(p: dict[str, Any], seed: int, every_feature: bool) -> dict[str, Any]:
    merged = {**FOREST_DEFAULTS, **p}
    # Spark has no minimum for splitting a node; half of it per child is the nearest bound it has.
    leaf = max(int(merged.get("min_samples_leaf", 1)), int(merged.get("min_samples_split", 2)) // 2, 1)
    return {
        "numTrees": int(merged["n_estimators"]),
        "maxDepth": DEEPEST if merged["max_depth"] is None else int(merged["max_depth"]),
        "featureSubsetStrategy": str(merged.get("max_features", "all" if every_feature else "sqrt")),
        "minInstancesPerNode": leaf,
        "bootstrap": bool(merged.get("bootstrap", True)),
        "subsamplingRate": float(merged.get("max_samples") or 1.0),
        "maxBins": int(merged.get("max_bins", 32)),
        "seed": seed,
    }


def validation(params: dict[str, Any]) -> tuple[float, int | None]:
    """With early stopping, the share of rows that a boosted model holds out to measure itself on (a tenth, if none is given), and
    after how many rounds without a better loss it stops. Without, all rows are learned from."""
    share = float(params.get("validation_split") or 0.1)
    if not 0 < share < 1:
        raise ValueError(f"validation_split is {share}; it must be between 0 and 1")
    return (share, int(params.get("early_stopping_patience") or boosting.PATIENCE)) if params.get("early_stopping") else (0.0, None)


def _held_out(df: DataFrame, share: float, key: str | None, seed: int):
    """Rows whose key's hash is among the lowest; without a key, by their place in the table."""
    if not share:
        return None
    if key:
        return portable_hash(F.col(key).cast("string"), seed) < F.lit(int(share * 2**32))
    return F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(1 << 32)) < F.lit(int(share * 2**32))


@dataclass(frozen=True)
class Learner:
    """An unfitted model: what kind, and its parameters."""

    model_type: str
    task: str
    params: dict[str, Any] = field(default_factory=dict)
    seed: int = 42

    def with_params(self, more: dict[str, Any]) -> Learner:
        return Learner(self.model_type, self.task, {**self.params, **more}, self.seed)

    def estimator(self, rows: int = 1, classes: int = 2, df: DataFrame | None = None, key: str | None = None):
        """The Spark ML estimator (None for the support vector regressor, which has its own loop)."""
        p = check_params(self.model_type, usable_params(self.model_type, self.params))
        if self.model_type == "random_forest":
            shared = _forest_params(p, self.seed, self.task == "regression")
            return RandomForestClassifier(impurity=p.get("criterion", "gini"), **shared) if self.task == "classification" else RandomForestRegressor(**shared)
        if self.model_type == "xgboost":
            share, patience = validation(self.params)
            return boosting.Boosting(self.task, classes, p, self.seed, _held_out(df, share, key, self.seed), patience)
        if self.model_type == "logistic_regression":
            return LogisticRegression(
                family="auto",
                elasticNetParam=float(p.get("l1_ratio", 0.0) or 0.0) if PENALTIES[p.get("penalty", "l2")] is None else PENALTIES[p.get("penalty", "l2")],
                regParam=0.0 if p.get("penalty", "l2") is None else 1.0 / (float(p.get("C", 1.0)) * max(rows, 1)),
                standardization=False,
                fitIntercept=bool(p.get("fit_intercept", True)),
                maxIter=int(p.get("max_iter", 100)),
                tol=float(p.get("tol", 1e-6)),
            )
        if self.model_type == "linear_regression":
            return LinearRegression(regParam=0.0, solver="auto", fitIntercept=bool(p.get("fit_intercept", True)))
        if self.task == "classification":
            one = LinearSVC(
                regParam=1.0 / (float(p.get("C", 1.0)) * max(rows, 1)), standardization=False, maxIter=int(p.get("max_iter", 100))
            )
            return one if classes <= 2 else OneVsRest(classifier=one, parallelism=min(classes, 4))
        return None

    def takes_weights(self) -> bool:
        """Whether equal rows may be fitted as one with their number: nothing is drawn or held out by the row, and no bound counts rows."""
        p = usable_params(self.model_type, self.params)
        if self.model_type == "random_forest":
            shared = _forest_params(p, self.seed, True)
            return not shared["bootstrap"] and shared["subsamplingRate"] == 1 and shared["minInstancesPerNode"] == 1
        if self.model_type == "xgboost":
            return not self.params.get("early_stopping") and float(p.get("subsample") or 1.0) >= 1
        return self.model_type == "svm" and self.task == "classification"

    def fit(self, df: DataFrame, feature_names: list[str] | None = None, rows: int | None = None, classes: int | None = None, key: str | None = None) -> Trained:
        """Fit on columns ``features`` and ``label``. A boosted model with ``validation_split`` holds rows out by the column ``key``."""
        started = time.time()
        ensure_checkpoints(df.sparkSession)
        weighted = self.takes_weights()
        if weighted or rows is None or (classes is None and self.task == "classification"):
            more = [F.count("label").alias("given"), different_rows(self.task).alias("different")] if weighted else []
            facts = df.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), *more).first()
            weighted = weighted and facts.given == facts.n and facts.top == facts.top and worth_it(facts.n, facts.different)
            rows, classes = facts.n, classes if classes is not None else int(facts.top) + 1 if facts.top is not None else 0
        if not rows:
            raise ValueError("no rows to fit on")
        front = None
        if self.model_type == "svm":
            p = check_params("svm", usable_params("svm", self.params))
            if p.get("kernel", "rbf") == "rbf":
                gamma, width = scale_gamma(df)
                given = p.get("gamma", "scale")
                front = RandomFeatures(gamma if given == "scale" else 1.0 / width if given == "auto" else float(given), width, int(p.get("n_components", 200)), self.seed)
        estimator = self.estimator(rows, classes or 2, df, key)
        if weighted:
            # a forest has no more bins than rows
            df = condensed(df, self.task, facts.different, estimator.getMaxBins() if self.model_type == "random_forest" else 1)
            estimator = replace(estimator, weight=WEIGHT) if self.model_type == "xgboost" else estimator.setWeightCol(WEIGHT)
        if front is not None:
            df = front.transform(df)
        if estimator is None:
            model = fit_svr(df, C=float(p.get("C", 1.0)), epsilon=float(p.get("epsilon", EPSILON)), max_iter=int(p.get("max_iter", 100)))
        else:
            model = estimator.fit(df)
        trained = Trained(model, self, list(feature_names or []), {}, front)
        trained.metadata = {
            "model_type": self.model_type,
            "task_type": self.task,
            "n_samples_trained": rows,
            "n_features": trained.n_features,
            "classes": classes if self.task == "classification" else None,
            "training_time": time.time() - started,
            "training_date": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
            "epochs": usable_params("xgboost", self.params).get("n_estimators", BOOSTED_DEFAULTS["n_estimators"]) if self.model_type == "xgboost" else None,
            "iterations": _iterations(model),
            "best_round": getattr(model, "best_round", None),
            "losses": getattr(model, "history", None),
            "hyperparameters": usable_params(self.model_type, self.params),
            "performance_history": [],
        }
        return trained


def _iterations(model: Model) -> int | None:
    if hasattr(model, "getNumTrees"):
        return model.getNumTrees
    if getattr(model, "hasSummary", False):
        summary = model.summary() if callable(model.summary) else model.summary
        return int(summary.totalIterations)
    return None


def make_learner(model_type: str, task: str | None = None, params: dict[str, Any] | None = None, seed: int = 42) -> Learner:
    name = model_type.lower()
    task = task or infer_task(name)
    if task not in MODELS_BY_TASK:
        raise ValueError(f"Unsupported task: {task}")
    name = {"svr": "svm"}.get(name, name.removesuffix("_classifier").removesuffix("_regressor"))
    if name not in MODELS_BY_TASK[task]:
        raise ValueError(f"Unsupported model type for {task}: {model_type}")
    return Learner(name, task, dict(params or {}), (params or {}).get("random_state", seed))


@dataclass
class Trained:
    """A fitted model with what is known about its training."""

    model: Model | BoostedTrees
    learner: Learner
    feature_names: list[str]
    metadata: dict[str, Any]
    front: RandomFeatures | None = None

    @property
    def n_features(self) -> int:
        if self.front:
            return self.front.inputs
        if hasattr(self.model, "numFeatures") and self.model.numFeatures > 0:
            return self.model.numFeatures
        return self.model.models[0].numFeatures if hasattr(self.model, "models") else len(self.feature_names)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (and, where the model has them, ``rawPrediction`` and ``probability``)."""
        if self.front is None:
            return self.model.transform(df)
        original = df.withColumn("__original", F.col("features"))
        out = self.model.transform(self.front.transform(original))
        return out.withColumn("features", F.col("__original")).drop("__original")

    def predict_proba(self, df: DataFrame, *keep: str) -> DataFrame:
        """(keep..., class, probability), one row per input row and class."""
        scored = self.predict(df)
        if "probability" not in scored.columns:
            raise NotImplementedError(f"{self.learner.model_type} does not give probabilities")
        return scored.select(*keep, F.posexplode(vector_to_array("probability")).alias("class", "probability"))

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance) in feature order; a one-vs-rest model gives the mean over its classes."""
        parts = self.model.models if hasattr(self.model, "models") else [self.model]
        if not all(hasattr(m, "featureImportances") for m in parts):
            raise NotImplementedError(f"{self.learner.model_type} has no feature importances")
        values = sum(m.featureImportances.toArray() for m in parts) / len(parts)
        names = self.feature_names or [f"f{i}" for i in range(len(values))]
        rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values, strict=True))]
        return spark.createDataFrame(rows, "position int, feature string, importance double")

    def log_metrics(self, metrics: dict[str, float], epoch: int | None = None, iteration: int | None = None) -> None:
        entry: dict[str, Any] = {"metrics": metrics, "timestamp": time.time()}
        entry.update({k: v for k, v in (("epoch", epoch), ("iteration", iteration)) if v is not None})
        self.metadata["performance_history"].append(entry)

    def save(self, spark: SparkSession, path: str) -> None:
        boosted = isinstance(self.model, BoostedTrees)
        if boosted:
            self.model.save(spark, f"{path}/model")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        about = {
            "learner": [self.learner.model_type, self.learner.task, self.learner.params, self.learner.seed],
            "feature_names": self.feature_names,
            "metadata": self.metadata,
            "boosted": boosted,
            "front": [self.front.gamma, self.front.inputs, self.front.outputs, self.front.seed] if self.front else None,
        }
        spark.createDataFrame([(json.dumps(about),)], "document string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trained:
        try:
            about = json.loads(spark.read.parquet(f"{path}/about").first().document)
            model = BoostedTrees.load(spark, f"{path}/model") if about.get("boosted") else PipelineModel.load(f"{path}/model").stages[0]
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            # a model stored without its description still scores
            model = PipelineModel.load(f"{path}/model").stages[0]
            task = "classification" if hasattr(type(model), "numClasses") else "regression"
            return cls(model, Learner(type(model).__name__, task), [], {})
        front = RandomFeatures(*about["front"]) if about["front"] else None
        return cls(model, Learner(*about["learner"]), about["feature_names"], about["metadata"], front)


