"""Reading files to DataFrames, and exact reproducible row samples."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.columns import NUMBER_PATTERN, key_text, portable_hash, ref

# Texts that mean "missing" in a CSV field.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FORMATS = {".csv": "csv", ".json": "json", ".jsonl": "jsonl", ".parquet": "parquet", ".pq": "parquet"}


def read_table(spark: SparkSession, path: str, format: str | None = None, **options: Any) -> DataFrame:
    """Read by file extension (or ``format``). ``path`` may be a file, a folder or a glob."""
    name = path.rstrip("/").lower()
    kind = format or next((f for ext, f in FORMATS.items() if name.endswith(ext)), None)
    if kind not in FORMATS.values():
        raise ValueError(f"Unsupported file format: {path}")
    reader = {"csv": read_csv, "json": read_json, "jsonl": read_json_lines, "parquet": read_parquet}[kind]
    try:
        return reader(spark, path, **options)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from err
        raise


def read_parquet(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def read_json_lines(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """One record per line: splittable, the form for large data."""
    return spark.read.options(**options).json(path)


def read_json(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """Arrays of records (each file read by one task), or records across lines."""
    return spark.read.options(**{"multiLine": True, **options}).json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    infer: bool = True,
    na_values: Sequence[str] = NA_TOKENS,
    multi_line: bool | None = None,
    **options: Any,
) -> DataFrame:
    """Comma-separated text with a header. Fields are read as text, missing-value tokens become NULL,
    and with ``infer`` one aggregate over the data decides each column's type.

    A file whose quoted fields hold line breaks cannot be split among tasks, one without them can.
    ``multi_line=None`` looks for such breaks first; say True or False to save that look.
    """
    merged = {"header": True, "sep": ",", "encoding": "UTF-8", "quote": '"', "escape": '"', **options}
    plain_text = str(merged["encoding"]).upper().replace("-", "") == "UTF8" and "lineSep" not in merged
    if multi_line is None:
        multi_line = not plain_text or _has_quoted_breaks(spark, path, str(merged["quote"]))
    raw = spark.read.options(**merged, multiLine=multi_line, inferSchema=False).csv(path)
    text = raw.select(*[F.when(~ref(c).isin(*na_values), ref(c)).alias(c) for c in raw.columns])
    return infer_types(text) if infer else text


def _has_quoted_breaks(spark: SparkSession, path: str, quote: str) -> bool:
    """A field that spans lines leaves an odd number of quotes on its first line."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns to BIGINT, DOUBLE or BOOLEAN where every present value reads as one.
    One pass over the data for all columns; an empty column becomes DOUBLE."""
    names = df.columns
    integral = r"^\s*[+-]?\d+\s*$"
    whole = [F.every(ref(c).isNull() | (ref(c).rlike(integral) & F.trim(ref(c)).try_cast("long").isNotNull())) for c in names]
    real = [F.every(F.coalesce(ref(c).rlike(NUMBER_PATTERN), F.lit(True))) for c in names]
    flag = [F.every(F.coalesce(ref(c).isin("True", "False", "TRUE", "FALSE", "true", "false"), F.lit(True))) for c in names]
    filled = [F.count(ref(c)) > 0 for c in names]
    facts = df.agg(*[F.array(*group).alias(k) for k, group in zip("wrfn", (whole, real, flag, filled), strict=True)]).first()

    def typed(i: int) -> Column:
        col = ref(names[i])
        if facts.n[i] and facts.w[i]:
            return F.trim(col).try_cast("long")
        if not facts.n[i] or facts.r[i]:
            return F.trim(col).try_cast("double")
        return F.lower(col).try_cast("boolean") if facts.f[i] else col

    return df.select(*[typed(i).alias(c) for i, c in enumerate(names)])


def sample_rows(df: DataFrame, n: int = 5, key: str | Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: those with the smallest hashes of their key.

    The result does not depend on partitioning. Each task keeps its own n best rows, so only those move.
    """
    text = key_text(df, key)
    return df.orderBy(portable_hash(text, seed), text).limit(n)


def spread(df: DataFrame, least_rows: int = 10_000) -> DataFrame:
    """One partition per core for a table that arrives in fewer, such as one file of one row group. A table with
    enough partitions, as any large one has, stays as it is and is not shuffled. Looks at row counts only."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    where = df.select(F.spark_partition_id().alias("p"))
    facts = where.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("p").alias("parts")).first()
    return df.repartition(cores) if facts.rows >= least_rows and facts.parts < cores else df
