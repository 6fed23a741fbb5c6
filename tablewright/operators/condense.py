"""Equal rows as one row with their number, for fits that take weights and see a row many times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.storage import cut_lineage

WEIGHT = "weight"
LEAST_ROWS = 1024  # fewer rows are fitted as they are
LEAST_SHARE = 8  # rows for each different one, at the least, on average
PART = 4096  # different rows that are worth a task


def different_rows(task: str):
    """About how many rows ``condensed`` has, as an aggregate."""
    return F.approx_count_distinct(F.xxhash64(*(["features", "label"] if task == "classification" else ["features"])))


def worth_it(rows: int, different: int) -> bool:
    return rows >= LEAST_ROWS and rows >= LEAST_SHARE * different


def condensed(df: DataFrame, task: str, different: int, least: int = 1) -> DataFrame:
    """(features, label, weight), stored: rows with equal features and class are one. For values, rows of equal features are two, a deviation
    below and above their mean, which have the number, sum and sum of squares of all of them: what squared errors depend on. Weights are
    halved and the rows doubled until there are at least ``least``."""
    if task == "classification":
        out = df.groupBy("features", "label").agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    else:
        label = F.col("label").cast("double")
        sums = df.groupBy("features").agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg(label).alias("m"), F.stddev_pop(label).alias("s"))
        out = sums.select("features", F.explode(F.array(F.col("m") - F.col("s"), F.col("m") + F.col("s"))).alias("label"), (F.col("n") / 2).alias(WEIGHT))
    spark = df.sparkSession
    out = cut_lineage(out.repartition(min(spark.sparkContext.defaultParallelism, 1 + different // PART)))
    copies = 1
    if least > 1 and (rows := out.count()):
        while rows * copies < least:
            copies *= 2
    if copies == 1:
        return out
    return out.withColumn(WEIGHT, F.explode(F.array_repeat(F.col(WEIGHT) / copies, copies)))
