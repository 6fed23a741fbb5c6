"""From a raw table to a checked, transformed, split feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import key_text, ref
from tablewright.operators.contract import drop_null_target, validate
from tablewright.operators.split import split
from tablewright.operators.transforms import FittedTable, fit_transforms
from tablewright.sources.files import spread
from tablewright.spec import TableSpec

KEY = "row_key"


@dataclass
class Prepared:
    table: DataFrame  # row_key, features, label, split
    fitted: FittedTable
    kept: list[DataFrame]  # what is held on the executors meanwhile

    def side(self, name: str) -> DataFrame:
        return self.table.where(F.col("split") == name)

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()

    def resplit(self, spec: TableSpec, config: dict[str, Any]) -> Prepared:
        """The same features under another seed or test share."""
        return Prepared(_split(self.table.drop("split"), "label", spec, config), self.fitted, self.kept)


def keyed(df: DataFrame, key: str | Sequence[str] | None) -> DataFrame:
    """Adds a row identity: the key's text, or a digest of the whole row."""
    return df.withColumn(KEY, key_text(df, key))


def _split(df: DataFrame, target: str, spec: TableSpec, config: dict[str, Any]) -> DataFrame:
    return split(df, target, spec.target_type, config["test_size"], config["stratify"], KEY, config["random_state"])


def prepare(
    df: DataFrame,
    spec: TableSpec,
    config: dict[str, Any],
    key: str | Sequence[str] | None = None,
    check_first: bool = True,
) -> Prepared:
    """Check, drop rows without a target, learn the transforms, apply them, and split by key.

    The feature table is kept for the split and the iterative fits that follow; a lost part is recomputed. With
    ``fit_on='train'`` the split comes first and the transforms are learned from the training rows only.
    """
    if check_first:
        validate(df, spec)
    names = [KEY, *spec.columns]
    given = keyed(drop_null_target(df, spec), key).select(*[ref(c) for c in names])
    rows = spread(given)
    kept = []
    if rows is not given:  # fewer partitions than cores: small enough to hold while it is read repeatedly
        kept.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
    if config.get("fit_on", "all") == "train":
        parts = _split(rows, spec.target_name, spec, config)
        fitted = fit_transforms(parts.where(F.col("split") == "train"), spec)
        table = fitted.transform(parts, label="label").select(KEY, "features", "label", "split")
        kept.append(table.persist(StorageLevel.MEMORY_AND_DISK))
        return Prepared(table, fitted, kept)
    fitted = fit_transforms(rows, spec)
    table = fitted.transform(rows, label="label").select(KEY, "features", "label")
    kept.append(table.persist(StorageLevel.MEMORY_AND_DISK))
    return Prepared(_split(table, "label", spec, config), fitted, kept)
