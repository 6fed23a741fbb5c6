"""What a table contains and what to predict from it: declared once, checked on the driver."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

# The closed vocabularies of a specification document.
FEATURE_TYPES = ("numeric", "categorical", "text", "datetime", "boolean")
TARGET_TYPES = ("binary", "multiclass", "continuous")
TASKS = ("classification", "regression")

# Training defaults.
TRAINING_DEFAULTS: dict[str, Any] = {
    "test_size": 0.2,
    "random_state": 42,
    "epochs": 100,
    "batch_size": 32,
    "early_stopping": False,
    "validation_split": 0.1,
    "cross_validation": False,
    "cv_folds": 5,
    "stratify": True,
}

# Fixed values: (python type, lowest, highest) of each training parameter.
TRAINING_RANGES: dict[str, tuple[type, float | None, float | None]] = {
    "test_size": (float, 0.0, 1.0),
    "random_state": (int, 0, None),
    "epochs": (int, 1, None),
    "n_samples_trained": (int, 0, None),
    "batch_size": (int, 1, None),
    "learning_rate": (float, 0.0, None),
    "early_stopping": (bool, None, None),
    "early_stopping_patience": (int, 1, None),
    "validation_split": (float, 0.0, 1.0),
    "cross_validation": (bool, None, None),
    "cv_folds": (int, 2, None),
    "stratify": (bool, None, None),
    "max_features": (int, 1, None),
    "min_df": (int, 1, None),
}

# Training parameters handed on to the model.
ITERATION_KEYS = ("epochs", "batch_size", "learning_rate", "early_stopping", "early_stopping_patience", "validation_split")

MODELS_BY_TASK = {
    "classification": ("random_forest", "logistic_regression", "svm", "xgboost"),
    "regression": ("random_forest", "linear_regression", "svm", "xgboost"),
}

DEFAULT_METRICS = {
    "classification": ("accuracy", "f1", "precision", "recall"),
    "regression": ("rmse", "mae", "r2"),
}


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(f"Invalid specification: {message}")


@dataclass(frozen=True)
class FeatureSpec:
    """One input column. ``preprocessing`` is a word (``"scale"``) or a dict
    (``{"imputation": "median", "scaling": "standard"}``)."""

    name: str
    type: str
    preprocessing: str | dict[str, str] | None = None
    nullable: bool = False
    constraints: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _need(isinstance(self.name, str) and bool(self.name), "a feature needs a name")
        _need(self.type in FEATURE_TYPES, f"feature '{self.name}' has type {self.type!r}, expected one of {FEATURE_TYPES}")
        _need(
            self.preprocessing is None or isinstance(self.preprocessing, (str, dict)),
            f"preprocessing of '{self.name}' must be a string or a dict",
        )
        _need(isinstance(self.nullable, bool), f"nullable of '{self.name}' must be true or false")
        _need(isinstance(self.constraints, dict), f"constraints of '{self.name}' must be a dict")

    def _option(self, key: str) -> str | None:
        return self.preprocessing.get(key) if isinstance(self.preprocessing, dict) else None

    @property
    def imputation(self) -> str:
        """mean / median / most_frequent / constant, as it applies to this feature's type."""
        asked = self._option("imputation")
        if self.type == "categorical":
            return asked if asked in ("most_frequent", "constant") else "most_frequent"
        if self.type != "numeric":
            return "most_frequent"
        by_word = {"impute_median": "median", "impute_mode": "most_frequent"}
        if isinstance(self.preprocessing, str):
            return by_word.get(self.preprocessing, "mean")
        return asked if asked in ("mean", "median", "most_frequent", "constant") else "mean"

    @property
    def kind(self) -> str:
        """Which block this feature becomes."""
        word = self.preprocessing if isinstance(self.preprocessing, str) else None
        if self.type == "numeric":
            scaling = self._option("scaling")
            if word == "scale" or scaling == "standard":
                return "standard"
            return "minmax" if word == "minmax" or scaling == "minmax" else "numeric"
        if self.type == "categorical":
            return "onehot" if (word or self._option("encoding")) == "one-hot" else "label"
        if self.type == "text":
            return "count" if word == "count" else "tfidf"
        if self.type == "datetime":
            return "components" if word == "components" else "epoch"
        return "boolean"


@dataclass(frozen=True)
class TableSpec:
    features: tuple[FeatureSpec, ...]
    target_name: str | None = None
    target_type: str = "continuous"
    task_type: str | None = None
    training: dict[str, Any] = field(default_factory=dict)
    metadata: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _need(len(self.features) > 0, "no features")
        names = [f.name for f in self.features]
        _need(len(set(names)) == len(names), "feature names repeat")
        _need(self.target_type in TARGET_TYPES, f"target type {self.target_type!r}, expected one of {TARGET_TYPES}")
        _need(self.task_type in (None, *TASKS), f"task_type {self.task_type!r}, expected one of {TASKS}")
        for key, value in self.training.items():
            self._check_training(key, value)

    @staticmethod
    def _check_training(key: str, value: Any) -> None:
        if key not in TRAINING_RANGES:
            warnings.warn(f"training parameter '{key}' has no effect", stacklevel=4)
            return
        kind, low, high = TRAINING_RANGES[key]
        if kind is bool:
            _need(isinstance(value, bool), f"{key} must be true or false")
            return
        number = isinstance(value, (int, float) if kind is float else int) and not isinstance(value, bool)
        _need(number, f"{key} must be {'a number' if kind is float else 'an integer'}")
        _need(low is None or value >= low, f"{key} must be at least {low}")
        _need(high is None or value <= high, f"{key} must be at most {high}")

    @classmethod
    def from_dict(cls, doc: dict[str, Any]) -> TableSpec:
        _need(isinstance(doc.get("features"), list), "'features' must be a list")
        _need(isinstance(doc.get("target"), dict), "'target' is required")
        for entry in doc["features"]:
            _need(isinstance(entry, dict) and "name" in entry and "type" in entry, "a feature needs 'name' and 'type'")
        target = doc["target"]
        _need("name" in target and "type" in target, "the target needs 'name' and 'type'")
        meta = dict(doc.get("metadata", {}))
        known = ("name", "type", "preprocessing", "nullable", "constraints")
        return cls(
            features=tuple(FeatureSpec(**{k: f[k] for k in known if k in f}) for f in doc["features"]),
            target_name=target["name"],
            target_type=target["type"],
            task_type=meta.get("task_type"),
            training=dict(doc.get("training_params", {})),
            metadata=meta,
        )

    def to_dict(self) -> dict[str, Any]:
        features = []
        for f in self.features:
            entry: dict[str, Any] = {"name": f.name, "type": f.type, "nullable": f.nullable}
            if f.preprocessing is not None:
                entry["preprocessing"] = f.preprocessing
            if f.constraints:
                entry["constraints"] = f.constraints
            features.append(entry)
        meta = dict(self.metadata)
        if self.task_type:
            meta["task_type"] = self.task_type
        return {
            "features": features,
            "target": {"name": self.target_name, "type": self.target_type},
            "metadata": meta,
            "training_params": dict(self.training),
        }

    @property
    def task(self) -> str:
        return self.task_type or ("regression" if self.target_type == "continuous" else "classification")

    @property
    def columns(self) -> list[str]:
        """Features in declared order, then the target."""
        names = [f.name for f in self.features]
        return names + ([self.target_name] if self.target_name and self.target_name not in names else [])

    def feature(self, name: str) -> FeatureSpec:
        return next(f for f in self.features if f.name == name)


def load_spec(spark: SparkSession, path: str) -> TableSpec:
    """Read a JSON specification from any file system Spark can reach."""
    rows = spark.read.text(path, wholetext=True).take(1)
    return TableSpec.from_dict(json.loads(rows[0].value))


def merged_config(spec: TableSpec, config: dict[str, Any] | None = None) -> dict[str, Any]:
    """Defaults, then the specification's training parameters, then the caller's config."""
    out: dict[str, Any] = {**TRAINING_DEFAULTS, "model_params": {}, **spec.training, **(config or {})}
    out["model_params"] = dict(out["model_params"] or {})
    out.setdefault("metrics", list(DEFAULT_METRICS[spec.task]))
    return out


def check_model_fits(model_type: str, spec: TableSpec) -> None:
    """Refuse a model that cannot learn this target, before any data is read."""
    if spec.task_type is None:
        raise ValueError("Unknown task type: the specification must say 'classification' or 'regression'")
    if model_type.lower() not in MODELS_BY_TASK[spec.task_type]:
        raise ValueError(
            f"Model type '{model_type}' is not compatible with {spec.task_type} tasks; "
            f"use one of: {', '.join(MODELS_BY_TASK[spec.task_type])}"
        )
    if (spec.task_type == "regression") != (spec.target_type == "continuous"):
        raise ValueError(f"Task '{spec.task_type}' does not go with a {spec.target_type} target")


def list_models() -> dict[str, list[str]]:
    return {task: list(names) for task, names in MODELS_BY_TASK.items()}
