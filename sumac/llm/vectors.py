"""Pivots and cells for searches among vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def matrix(lists, width: int) -> np.ndarray:
    """Rows of doubles; shorter vectors count as padded with zeros."""
    lists = list(lists)
    out = np.zeros((len(lists), width))
    for k, values in enumerate(lists):
        out[k, : len(values)] = values
    return out


def pivots(vectors: DataFrame, count: int, width: int) -> np.ndarray:
    """``count`` vectors, the least by a hash; the caller bounds ``count``."""
    rows = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(count).collect()
    return np.unique(matrix([r["v"] for r in rows], width), axis=0) if rows else np.zeros((1, width))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0))


def parts_of(counts: dict[int, int], size: int, cells: int) -> np.ndarray:
    """In how many parts of at most about ``size`` rows each cell is cut."""
    return np.array([max(1, -(-counts.get(c, 0) // size)) for c in range(cells)], np.int64)
