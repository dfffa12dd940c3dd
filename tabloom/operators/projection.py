"""Principal components by a randomised range finder.

A random block of ``size x width`` numbers is multiplied by the centred covariance in passes over the packed rows (a product and a
transposed product per block, sums in a tree), made orthonormal in between, and the small matrix within its range gives the
components. No ``size x size`` matrix exists anywhere: tasks and driver hold ``size x width`` numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.clustering import Block, Rows

WIDTH, PASSES, TOLERANCE = 66, 40, 1e-10


def _transposed(block: Block, right: np.ndarray) -> np.ndarray:
    """(size x width): the transposed block times a matrix of its height."""
    if block.indices is None:
        return block.data.T @ right
    out = np.zeros((block.size, right.shape[1]))
    if len(block.indices):
        order = np.argsort(block.indices, kind="stable")
        columns, first = np.unique(block.indices[order], return_index=True)
        row = np.repeat(np.arange(block.n), np.diff(block.starts))[order]
        out[columns] = np.add.reduceat(right[row] * block.data[order][:, None], first, axis=0)
    return out


def components(vectors: DataFrame, vector: str, n: int = 2, width: int = WIDTH, passes: int = PASSES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean (size) and loadings (size x n) of the leading components, the largest loading of each positive."""
    rows = Rows(vectors, vector)
    try:
        if rows.count < 2:
            raise ValueError("a projection needs at least two rows")
        size = rows.size
        mean = rows.totals(lambda block: [_transposed(block, np.ones((block.n, 1))).ravel()], 1)[0] / rows.count
        basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, min(size, max(width, n)))))[0]
        last = np.zeros((size, n))
        for _ in range(passes):
            held = basis
            product = rows.totals(lambda block, q=held: [_transposed(block, block.times(q)).ravel()], 1)[0].reshape(held.shape)
            product = product / rows.count - np.outer(mean, mean @ held)
            inner = held.T @ product
            values, turns = np.linalg.eigh((inner + inner.T) / 2)
            loadings = held @ turns[:, np.argsort(-values)[:n]]
            loadings = loadings * np.where(loadings[np.abs(loadings).argmax(axis=0), range(loadings.shape[1])] < 0, -1, 1)
            if held.shape[1] == size or np.abs(loadings - last).max() < TOLERANCE:
                break
            last, basis = loadings, np.linalg.qr(product)[0]
        return mean, np.pad(loadings, ((0, 0), (0, n - loadings.shape[1])))
    finally:
        rows.release()


def projected(mean: np.ndarray, loadings: np.ndarray, vector: Column) -> Column:
    """``array<double>``: the centred coordinates of a vector column, sparse or dense."""
    offsets, size = mean @ loadings, len(mean)

    @F.arrow_udf("array<double>")
    def place(vectors: pa.Array) -> pa.Array:
        part = dict(zip((f.name for f in vectors.type), vectors.flatten(), strict=True))
        sizes = np.diff(part["values"].offsets.to_numpy())
        row = np.repeat(np.arange(len(vectors)), sizes)
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        sparse = part["type"].to_numpy(zero_copy_only=False)[row] == 0
        at = np.arange(len(row)) - starts
        at[sparse] = part["indices"].flatten().to_numpy()
        values = part["values"].flatten().to_numpy()
        out = np.stack([np.bincount(row, values * loadings[at, i], len(vectors)) - offsets[i] for i in range(loadings.shape[1])], axis=1)
        return pa.array(list(out), pa.list_(pa.float64()))

    return place(vector)
