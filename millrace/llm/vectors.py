"""Embedding columns: which vectors are usable, and their values as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Whether an ``array<double>`` is there and holds neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def rows_of(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def list_column(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))
