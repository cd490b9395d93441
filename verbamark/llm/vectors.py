"""Shared by the operators on embeddings: usable rows, and lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column | str) -> Column:
    """Whether a vector is there, without null or non-finite components and not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as lists."""
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def bounded_sample(rows: DataFrame, key: str, n: int, total: int) -> pa.Table:
    """About ``n`` rows, at most ``n``, that a hash of the key picks; all of a smaller table."""
    share = min(1.0, n / max(total, 1))
    picked = rows if share == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return picked.toArrow().slice(0, n)
