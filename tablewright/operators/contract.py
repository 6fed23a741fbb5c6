"""Checks of a table against its specification: every rule in one aggregate over the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import as_category, as_flag, as_number, as_time, present, ref
from tablewright.operators.stats import distinct_up_to
from tablewright.spec import FeatureSpec, TableSpec


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for an offending row and never NULL."""

    name: str
    column: str
    bad: Column
    error: type[Exception]
    message: str
    nullable: bool = False


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.columns if c not in df.columns]


def _feature_rules(df: DataFrame, f: FeatureSpec, lenient: bool) -> list[Rule]:
    has = present(df, f.name).isNotNull()
    rules = []
    if f.type == "numeric":
        bad = has & as_number(df, f.name).isNull()
        rules.append(Rule("numeric", f.name, bad, TypeError, f"{f.name}: values that do not read as numbers", f.nullable))
    elif f.type == "datetime":
        bad = has & as_time(df, f.name).isNull()
        text = f"{f.name}: values that do not read as points in time"
        rules.append(Rule("datetime", f.name, bad, TypeError, text, f.nullable))
    elif f.type == "boolean":
        bad = as_flag(df, f.name, lenient).isNull() & (has | F.lit(not f.nullable))
        rules.append(Rule("boolean", f.name, bad, TypeError, f"{f.name}: values other than the accepted spellings of true and false", f.nullable))
    bounds = {k: f.constraints[k] for k in ("min", "max") if k in f.constraints}
    if bounds:
        value = as_number(df, f.name)
        bad = F.lit(False)
        if "min" in bounds:
            bad = bad | (value < bounds["min"])
        if "max" in bounds:
            bad = bad | (value > bounds["max"])
        text = f"{f.name}: values beyond {bounds}"
        rules.append(Rule("constraint", f.name, F.coalesce(bad, F.lit(False)), ValueError, text, f.nullable))
    return rules


def row_rules(df: DataFrame, spec: TableSpec, lenient: bool = False) -> list[Rule]:
    rules = [rule for f in spec.features for rule in _feature_rules(df, f, lenient)]
    if spec.target_name in df.columns and spec.target_type == "continuous":
        bad = present(df, spec.target_name).isNotNull() & as_number(df, spec.target_name).isNull()
        text = f"{spec.target_name}: target values that do not read as numbers, which regression needs"
        rules.append(Rule("target", spec.target_name, bad, TypeError, text))
    return rules


def check(df: DataFrame, spec: TableSpec, strict: bool = True, lenient: bool = False) -> DataFrame:
    """(rule, column, n_bad, ok), one row per rule, from one scan.

    Nullable columns are checked on the rows that have a value; ``strict=False`` instead skips every check of
    a nullable column as soon as it holds one NULL. A binary target has at most two distinct values; it is looked at by itself, and
    n_bad is its number of values, 3 standing for more than two.
    """
    absent = missing_columns(df, spec)
    if absent:
        raise ValueError(f"Missing columns in data: {', '.join(absent)}")
    rules = row_rules(df, spec, lenient)
    aggs, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, r in enumerate(rules):
        aggs.append(F.count_if(r.bad).alias(f"b{i}"))
        n_bad = F.col(f"b{i}")
        if not strict and r.nullable:
            aggs.append(F.count_if(present(df, r.column).isNull()).alias(f"m{i}"))
            n_bad = F.when(F.col(f"m{i}") > 0, 0).otherwise(n_bad)
        lines.append((r.name, r.column, n_bad, n_bad == 0))
    if spec.target_type == "binary":
        classes = distinct_up_to(df, as_category(df, spec.target_name), 2)
        lines.append(("binary_target", spec.target_name, F.lit(classes), F.lit(classes <= 2)))
    if not lines:
        return df.sparkSession.createDataFrame([], "rule string, column string, n_bad long, ok boolean")
    rows = [
        F.struct(F.lit(a).alias("rule"), F.lit(b).alias("column"), n.cast("long").alias("n_bad"), ok.alias("ok"))
        for a, b, n, ok in lines
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def validate(df: DataFrame, spec: TableSpec, strict: bool = True, lenient: bool = False) -> bool:
    """True, or the error of the first broken rule."""
    messages = {(r.name, r.column): r for r in row_rules(df, spec, lenient)} if not missing_columns(df, spec) else {}
    for row in check(df, spec, strict, lenient).collect():
        if row.ok:
            continue
        if row.rule == "binary_target":
            classes = df.agg(F.count_distinct(as_category(df, row.column))).first()[0]
            raise ValueError(f"{row.column}: a binary target with {classes} classes")
        broken = messages[(row.rule, row.column)]
        raise broken.error(f"{broken.message} ({row.n_bad} rows)")
    return True


def flag_rows(df: DataFrame, spec: TableSpec, lenient: bool = False) -> DataFrame:
    """The table with ``broken_rules``: the names of the rules each row breaks. No shuffle; works on streams."""
    rules = row_rules(df, spec, lenient)
    marks = [F.when(r.bad, F.lit(f"{r.name}:{r.column}")) for r in rules]
    broken = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return df.withColumn("broken_rules", broken)


def quarantine(df: DataFrame, spec: TableSpec, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, offending rows with ``broken_rules``)."""
    flagged = flag_rows(df, spec, lenient)
    return flagged.where(F.size("broken_rules") == 0).drop("broken_rules"), flagged.where(F.size("broken_rules") > 0)


def drop_null_target(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Whole rows without a target go, so features and target keep the same length."""
    plain = ref(spec.target_name).isNotNull()  # reaches the Parquet reader, the NaN test does not
    return df.where(plain & present(df, spec.target_name).isNotNull())


def project(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, then the features in declared order, then the target."""
    absent = [c for c in spec.columns if c not in df.columns and c != spec.target_name]
    if absent:
        raise ValueError(f"Missing columns in data: {', '.join(absent)}")
    names = [*keep, *[c for c in spec.columns if c in df.columns and c not in keep]]
    return df.select(*[ref(c) for c in names])
