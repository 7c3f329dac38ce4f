"""Vector column functions: Arrow batches for arithmetic between two vectors, MLlib for the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf


def as_matrix(column: pa.Array) -> np.ndarray:
    """List column of equal lengths to a float64 matrix, one row per list."""
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return flat.reshape(len(column), -1)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length; a zero row stays zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms > 0, norms, 1.0)[:, None]


def l2_norm(vector: Column) -> Column:
    """Euclidean length of an array column."""
    wide = vector.cast("array<double>")
    return F.sqrt(F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalized(vector: Column) -> Column:
    """Unit-length array of doubles; a zero vector stays zero."""
    wide = vector.cast("array<double>")
    norm = l2_norm(vector)
    return F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide)


@arrow_udf(T.DoubleType())
def _unit_dot(unit: pa.Array, raw: pa.Array) -> pa.Array:
    known = pc.and_(unit.is_valid(), raw.is_valid())
    left, right = as_matrix(unit.filter(known)), as_matrix(raw.filter(known))
    known = known.to_numpy(zero_copy_only=False)
    out = np.zeros(len(known))
    out[known] = np.einsum("ij,ij->i", left, unit_rows(right))
    return pa.array(out, mask=~known)


def unit_dot(unit: Column, raw: Column) -> Column:
    """Dot product of a unit vector with the normalized form of a raw one; null where either is null."""
    return _unit_dot(unit, raw)


def to_ml_vector(array: Column) -> Column:
    return array_to_vector(array.cast("array<double>"))


def from_ml_vector(vector: Column) -> Column:
    return vector_to_array(vector)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
