"""Feature vectors as they reach Python tasks: Arrow structs of type, size, indices and values, or lists of all entries if there are few."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

NARROW = 64  # entries of a vector that goes as a list: Spark writes it to Arrow several times faster than the struct


def entries(column: str, size: int) -> Column:
    """The column for a Python task that reads it with ``matrix``."""
    return vector_to_array(column) if size <= NARROW else F.col(column)


def matrix(column: pa.StructArray | pa.ListArray, wanted: np.ndarray) -> np.ndarray:
    """The wanted entries of every vector, one row a vector. Sparse vectors are never made dense beyond those."""
    if pa.types.is_list(column.type):
        if not len(column) or not len(wanted):
            return np.zeros((len(column), len(wanted)))
        return column.values.to_numpy(zero_copy_only=False)[column.offsets.to_numpy()[:-1, None] + wanted[None, :]]
    kind, _, indices, values = column.flatten()
    n, out = len(column), np.zeros((len(column), len(wanted)))
    if not n or not len(wanted):
        return out
    dense = kind.to_numpy(zero_copy_only=False) == 1
    starts, flat = values.offsets.to_numpy(), values.values.to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(dense)
    if len(rows):
        out[rows] = flat[starts[rows][:, None] + wanted[None, :]]
    if len(rows) < n:
        counts = np.where(dense, 0, np.diff(starts))
        owner = np.repeat(np.arange(n), counts)
        at = np.repeat(starts[:-1], counts) + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts_i, flat_i = indices.offsets.to_numpy(), indices.values.to_numpy(zero_copy_only=False)
        index = flat_i[at - np.repeat(starts[:-1], counts) + np.repeat(starts_i[:-1], counts)]
        order = np.argsort(wanted, kind="stable")
        place = np.minimum(np.searchsorted(wanted[order], index), len(wanted) - 1)
        hit = wanted[order][place] == index
        out[owner[hit], order[place[hit]]] = flat[at[hit]]
    return out


def width(column: pa.StructArray) -> int:
    """Entries of the first vector."""
    kind, size, _, values = column.flatten()
    return len(values[0]) if kind[0].as_py() == 1 else size[0].as_py()
