"""Metrics as aggregates: all classification ones from one confusion count, all regression ones from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.stats import distinct_up_to

FEW = 10  # fixed value: fewer distinct whole numbers than this are classes
CLASSIFICATION = ("accuracy", "precision", "recall", "f1")
REGRESSION = ("rmse", "mse", "mae", "r2")
LOWER_IS_BETTER = ("rmse", "mse", "mae")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, prediction, n): the only shuffle the classification metrics need of the data."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    average: str = "auto",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., accuracy, precision, recall, f1). ``average='auto'`` takes class 1 as positive when the labels hold
    exactly two classes and weights classes by support otherwise; 'weighted' and 'binary' force one of them."""
    c = confusion(df, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").cast("double").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"), hit.alias("tp")),
        F.struct(F.col("prediction").cast("double").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"), F.lit(0).cast("long").alias("tp")),
    )
    per_class = (
        c.select(*by, F.inline(sides))
        .groupBy(*by, "cls")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("tp").alias("tp"))
    )
    scored = per_class.withColumns(
        {
            "precision": _ratio(F.col("tp"), F.col("called")),
            "recall": _ratio(F.col("tp"), F.col("support")),
            "f1": _ratio(2 * F.col("tp"), F.col("support") + F.col("called")),
        }
    )
    total = F.sum("support")
    binary = F.count_if(F.col("support") > 0) == 2 if average == "auto" else F.lit(average == "binary")

    def averaged(m: str) -> Column:
        positive = F.max(F.when(F.col("cls") == 1, F.col(m)))
        return F.when(binary, positive).otherwise(F.sum(F.col("support") * F.col(m)) / total).alias(m)

    aggs = [(F.sum("tp") / total).alias("accuracy"), *[averaged(m) for m in ("precision", "recall", "f1")]]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(by..., rmse, mse, mae, r2) in one pass. r2 of a constant label is 1 for perfect predictions, else 0."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    mse, spread = F.avg(e * e), F.var_pop(y)
    r2 = F.when(spread > 0, 1 - mse / spread).when(mse == 0, 1.0).otherwise(0.0)
    aggs = [F.sqrt(mse).alias("rmse"), mse.alias("mse"), F.avg(F.abs(e)).alias("mae"), r2.alias("r2")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def is_classification(df: DataFrame, label: str = "label") -> bool:
    """As ``detect_task`` decides, without counting more values than it takes."""
    y = F.col(label).cast("double")
    return distinct_up_to(df, y, FEW - 1) < FEW and df.agg(F.every(y == F.floor(y)).alias("integral")).first().integral is not False


def detect_task(df: DataFrame, label: str = "label") -> DataFrame:
    """One row (distinct, integral, is_classification): fewer than ten distinct values, all whole numbers."""
    y = F.col(label).cast("double")
    facts = df.agg(F.count_distinct(y).alias("distinct"), F.every(y == F.floor(y)).alias("integral"))
    return facts.withColumn("is_classification", (F.col("distinct") < FEW) & F.coalesce("integral", F.lit(True)))


def metric_frame(df: DataFrame, metrics: Sequence[str], label: str = "label", prediction: str = "prediction", average: str = "auto", by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by``) with the asked metrics."""
    unknown = [m for m in metrics if m not in (*CLASSIFICATION, *REGRESSION)]
    if unknown:
        raise ValueError(f"Unsupported metric: {', '.join(unknown)}")
    of_class = [m for m in metrics if m in CLASSIFICATION]
    of_value = [m for m in metrics if m in REGRESSION]
    out = None
    if of_class:
        out = classification_metrics(df, label, prediction, average, by).select(*by, *of_class)
    if of_value:
        values = regression_metrics(df, label, prediction, by).select(*by, *of_value)
        if out is None:
            out = values
        else:
            key = list(by) or "__one"
            left, right = (out, values) if by else (out.withColumn("__one", F.lit(1)), values.withColumn("__one", F.lit(1)))
            out = left.join(right, key).drop("__one")
    return out.select(*by, *metrics)


def evaluate(trained, df: DataFrame, metrics: Sequence[str] = ("accuracy",), average: str = "auto") -> dict[str, float]:
    """Predict, compute the metrics, and note them in the model's history."""
    table = metric_frame(trained.predict(df).select("label", "prediction"), metrics, average=average)
    values = {m: v for m, v in table.first().asDict().items()}
    if any(v is None for v in values.values()):
        raise ValueError("metrics are undefined on these labels (no rows, or two classes without a class 1)")
    trained.log_metrics(values)
    return values
