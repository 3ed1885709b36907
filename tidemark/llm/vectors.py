"""What the operators on embeddings share: valid vectors as packed doubles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F


def usable(column: str, size):
    """Whether a vector has ``size`` (a number or column) finite components, not all zero."""
    one = F.col(column)
    finite = F.forall(one, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(one) == size) & finite & F.exists(one, lambda x: x != 0), F.lit(False))


def matrix(column, size: int) -> np.ndarray:
    """Rows of components (lists, arrays or an Arrow list column) as doubles."""
    if hasattr(column, "flatten"):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.array(list(column), np.float64).reshape(-1, size)


def unpack(column, size: int) -> np.ndarray:
    """Rows packed as bytes of doubles."""
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, size)


def packed(rows: np.ndarray) -> list[bytes]:
    raw, width = np.ascontiguousarray(rows, np.float64).tobytes(), rows.shape[1] * 8
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow of squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
