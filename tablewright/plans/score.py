"""Scoring new rows with stored parameters: the same expressions for a batch and for a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablewright.operators.models import Trained
from tablewright.operators.transforms import FittedTable


def score(df: DataFrame, trained: Trained, fitted: FittedTable, keep: Sequence[str] | None = None) -> DataFrame:
    """(keep..., prediction, predicted): the predicted number and, for classes, the original label. Nothing is
    refitted and no row leaves its partition. ``keep`` defaults to all input columns."""
    columns = list(df.columns if keep is None else keep)
    out = trained.predict(fitted.transform(df))
    return fitted.original_label(out, "prediction", "predicted").select(*columns, "prediction", "predicted")
