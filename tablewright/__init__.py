"""Schema-driven feature and model engine on Spark DataFrames.

Declare a table's columns, types and target once (``TableSpec``); the package reads the data, profiles
it, checks it, fits and applies feature transforms, splits, trains, tunes, measures, explains and scores.
"""

from tablewright.plans.score import score
from tablewright.plans.train import TrainResult, sweep, train, train_iterations
from tablewright.sources.files import read_table, sample_rows
from tablewright.spec import FeatureSpec, TableSpec, load_spec

__all__ = [
    "FeatureSpec",
    "TableSpec",
    "TrainResult",
    "load_spec",
    "read_table",
    "sample_rows",
    "score",
    "sweep",
    "train",
    "train_iterations",
]
