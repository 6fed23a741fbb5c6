"""What a table holds: counts, missing values, distinct values, ranges and commonest values per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import as_category, as_number, dtype, is_numeric, present
from tablewright.operators.stats import distinct_up_to, histogram, value_text


def summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, dtype, rows, missing, missing_pct, distinct) per column, missing values not counted as distinct.

    Exact distinct counts shuffle each column's distinct values once, all columns in one job;
    ``approximate`` uses sketches, so nothing but those moves.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(present(df, c)).alias(f"n{i}"))
        if approximate:
            aggs.append(F.approx_count_distinct(present(df, c)).alias(f"d{i}"))
    wide = df.agg(*aggs)
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(dtype(df, c).simpleString()).alias("dtype"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("missing"),
            *([F.col(f"d{i}").alias("distinct")] if approximate else []),
        )
        for i, c in enumerate(df.columns)
    ]
    out = wide.select(F.inline(F.array(*lines)))
    if not approximate:
        hist = histogram(df, {c: _identity(df, c) for c in df.columns})
        counts = hist.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct"))
        out = out.join(counts, F.col("column") == F.col("feature"), "left").drop("feature")
    pct = F.when(F.col("rows") > 0, F.col("missing") / F.col("rows") * 100).alias("missing_pct")
    return out.select("position", "column", "dtype", "rows", "missing", pct, F.coalesce("distinct", F.lit(0)).alias("distinct"))


def _identity(df: DataFrame, name: str) -> Column:
    """The value, or for long texts a 256-bit digest, so that counting documents does not move them."""
    value = as_category(df, name)
    if isinstance(df.select(value.alias("v")).schema["v"].dataType, T.StringType):
        return F.when(F.length(value) > 64, F.sha2(value, 256)).otherwise(value)
    return value


def numeric_stats(df: DataFrame) -> DataFrame:
    """(column, low, high, mean, std, missing, missing_pct) for numeric columns: one pass. ``std`` is the sample one."""
    names = [c for c in df.columns if is_numeric(dtype(df, c))]
    if not names:
        raise ValueError("no numeric columns")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        col = as_number(df, c)
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.min(col).alias(f"low{i}"),
            F.max(col).alias(f"high{i}"),
            F.avg(col).alias(f"mean{i}"),
            F.stddev_samp(col).alias(f"std{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{k}{i}").alias(k) for k in ("low", "high", "mean", "std")],
            (F.col("rows") - F.col(f"n{i}")).alias("missing"),
            ((F.col("rows") - F.col(f"n{i}")) / F.col("rows") * 100).alias("missing_pct"),
        )
        for i, c in enumerate(names)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def top_values(df: DataFrame, k: int = 5, below: int = 20) -> DataFrame:
    """(column, value, n, rank, distinct) of the k commonest values of each non-numeric column with fewer than
    ``below`` distinct ones. Ties go to the smaller value.

    Sketches first tell which columns can qualify, so columns of unique texts are never counted value by value.
    """
    names = [c for c in df.columns if not is_numeric(dtype(df, c))]
    if not names:
        raise ValueError("no categorical columns")
    sketch = df.agg(*[F.approx_count_distinct(present(df, c), 0.02).alias(f"d{i}") for i, c in enumerate(names)]).first()
    # At so few values the sketch errs by far less than a factor of two; the exact count decides below.
    likely = [c for i, c in enumerate(names) if sketch[i] < 2 * below]
    if not likely:
        return df.sparkSession.createDataFrame([], "column string, value string, n long, rank int, distinct long")
    hist = histogram(df, {c: as_category(df, c) for c in likely})
    entry = F.struct((-F.col("n")).alias("m"), F.col("value"))
    per_column = hist.groupBy("feature").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    few = per_column.withColumn("distinct", F.size("entries").cast("long")).where(F.col("distinct") < below)
    ranked = few.select("feature", "distinct", F.posexplode(F.slice("entries", 1, k)).alias("pos", "e"))
    return ranked.select(
        F.col("feature").alias("column"),
        value_text("e.value").alias("value"),
        (-F.col("e.m")).alias("n"),
        (F.col("pos") + 1).alias("rank"),
        "distinct",
    )


def class_distribution(df: DataFrame, label: str = "label", split: str = "split", below: int = 20) -> DataFrame:
    """(split, label, n, pct) when the label has fewer than ``below`` classes, otherwise no rows."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    if distinct_up_to(df, F.col(label), below - 1) >= below:
        return counts.select(split, label, "n", F.lit(None).cast("double").alias("pct")).limit(0)
    total = F.sum("n").over(Window.partitionBy(split))
    return counts.select(split, label, "n", (F.col("n") / total * 100).alias("pct"))
