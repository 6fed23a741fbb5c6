"""What the corpus operators share: words, stored intermediate tables, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablewright.functions.storage import cut_lineage, new_path

__all__ = ["WORDS", "cut_lineage", "new_path", "no_cache", "stored", "struct_array", "texts", "worker_cache"]

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


_held: dict = {}


def worker_cache(key, make: Callable):
    """What this Python worker keeps from one task to the next under ``key``. A worker serves tasks of all operators, so it keeps
    only what the operator it last ran made, and gives back what that one's allocators left unused: memory is that of one operator, not
    the sum of all."""
    if key not in _held:
        no_cache()
        _held[key] = make()
    return _held[key]


def no_cache() -> None:
    """Frees what this Python worker keeps of an operator that it ran before, and gives back what its allocators hold unused: a worker
    serves tasks of all operators, and what one leaves behind counts beside the next one's."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts(column: pa.Array) -> Iterable[str | None]:
    """One text at a time, so that a batch of long texts is not held twice."""
    return (x.as_py() for x in column)


def struct_array(rows: list[tuple], kind: pa.StructType) -> pa.StructArray:
    """Rows as an Arrow struct column; a row of None gives nulls in its fields."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * kind.num_fields
    fields = [kind.field(i) for i in range(kind.num_fields)]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: later reads survive lost executors and repeat nothing."""
    spark: SparkSession = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
