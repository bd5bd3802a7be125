"""Vectors as exact integers, for the operators that compare them without rounding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums of squares from here on take no part: products and squared distances of smaller vectors fit into a long.
MOST_SQUARES = 2.0**60
#: Below this, sums of products are whole numbers that doubles hold exactly.
EXACT = 2**52


def scaled(vector: Column, scale: int, size: int | None = None) -> Column:
    """floor(scale * x) of each component, x as double, as array<int>.

    Null where the vector is null or empty, not of the given size, holds null or non-finite components, or its whole
    numbers' squares sum up to MOST_SQUARES or more.
    """
    vector = vector.cast("array<double>")
    finite = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    sized = F.size(vector) == size if size else F.size(vector) > 0
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.floor(F.lit(float(scale)) * x).cast("double") * F.floor(F.lit(float(scale)) * x).cast("double"))
    return F.when(vector.isNotNull() & sized & finite & (squares < MOST_SQUARES), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x).try_cast("int")))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one size as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of x with the rows of y."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)), dtype=np.int64)
    a, b = (np.einsum("ij,ij->i", z.astype(float), z.astype(float)).max() for z in (x, y))
    if a * b < float(EXACT) ** 2:
        return np.rint(x.astype(float) @ y.T.astype(float)).astype(np.int64)
    return np.stack([x @ row for row in y], axis=1)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of y."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)), dtype=np.int64)
    a, b = (np.einsum("ij,ij->i", z.astype(float), z.astype(float)) for z in (x, y))
    if max(a.max(), b.max()) < EXACT / 4:
        return np.rint(a[:, None] + b[None, :] - 2 * (x.astype(float) @ y.T.astype(float))).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1)
