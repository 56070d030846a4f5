"""Integer vectors for the embedding operators: cleaning, packing, moments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest component after scaling: inner products and squared distances of up
# to 128 such components stay below 2^63.
MOST = 1 << 27


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def scaled(vector: Column, factor: int) -> Column:
    """array<long> of floor(factor * x), x as double; raises beyond ``MOST``."""
    def one(x):
        y = F.lit(float(factor)) * x.cast("double")
        return F.when(F.abs(y) <= F.lit(float(MOST)), F.floor(y)).otherwise(F.raise_error(
            F.lit(f"a vector component is beyond {MOST} after scaling by {factor}")))
    return F.transform(vector, one)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """rows x dim of a list column without nulls whose lists have ``dim`` items."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), dim)


def packed_rows(m: np.ndarray, dtype: str) -> pa.Array:
    """Each row of a matrix as a binary value."""
    width = m.shape[1] * np.dtype(dtype).itemsize
    return pa.array([r.tobytes() for r in np.ascontiguousarray(m, dtype)], pa.binary()) \
        if width else pa.array([b""] * len(m), pa.binary())


def unpacked_rows(column: pa.Array, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim)


def moments(vectors: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, sums of products) over all rows of one array column.

    A task adds its rows up and gives one number per coordinate and pair of
    coordinates; Spark adds those of all tasks, so the driver gets
    ``dim * (dim + 3) / 2 + 1`` numbers whatever the size of the table.
    """
    upper = np.triu_indices(dim)

    def run(batches):
        n, sums, products = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            m = matrix(batch.column(0), dim).astype(np.float64)
            n += len(m)
            sums += m.sum(0)
            products += m.T @ m
        values = np.concatenate([[n], sums, products[upper]])
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

    added = vectors.mapInArrow(run, "at long, value double").groupBy("at").agg(
        F.sum("value").alias("value"))
    values = np.zeros(1 + dim + len(upper[0]))
    for row in added.collect():
        values[row["at"]] = row["value"]
    products = np.zeros((dim, dim))
    products[upper] = values[1 + dim:]
    products = products + np.triu(products, 1).T
    return int(values[0]), values[1: 1 + dim], products
