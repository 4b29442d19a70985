"""Vector columns as whole numbers: which vectors take part, and a batch of them as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and every component is a finite number."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(fits, F.lit(False))


def plain(df: DataFrame, id_col: str, vector_col: str, **more: Column) -> DataFrame:
    """id, vector (doubles) and more columns of the rows whose vectors take part."""
    vector = F.col(vector_col).cast("array<double>")
    return df.where(finite(vector)).select(
        F.col(id_col).alias("id"), vector.alias("vector"),
        *(c.alias(name) for name, c in more.items()))


def widest(rows: DataFrame) -> int:
    """Components of the longest vector."""
    return rows.agg(F.max(F.size("vector"))).head()[0] or 0


def parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All components of a list column, and the row each belongs to."""
    lengths = pa.compute.list_value_length(column).to_numpy(False)
    return (column.flatten().to_numpy(False),
            np.repeat(np.arange(len(lengths)), lengths.astype(np.int64)))


def matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x); short vectors are filled up with zeros to ``width``."""
    values, row = parts(column)
    out = np.zeros((len(column), width))
    first = np.zeros(len(column) + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=len(column)), out=first[1:])
    out[row, np.arange(len(values)) - first[row]] = np.floor(scale * values)
    return out


def listed(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(rows.reshape(-1), kind))
