"""Embedding columns as exact integer matrices inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: integer components up to this size keep squared distances and inner products of 64 of them within 64 bits
LARGEST = 1 << 27


def whole_numbers(column: pa.Array, scale: int, dims: int | None = None) -> tuple[np.ndarray, list[np.ndarray] | np.ndarray]:
    """Rows whose vectors count, and floor(scale * x) of each of those vectors.

    A vector counts if it is not null, has no null, NaN or infinite component and none beyond `LARGEST` after scaling and, with
    `dims`, has that many components; then the answer is one matrix, else a list of arrays."""
    lists = column.cast(pa.large_list(pa.float64()))
    ends = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset: lists.offset + len(lists) + 1]
    flat = lists.values.slice(ends[0], ends[-1] - ends[0]) if len(ends) else lists.values
    x = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * scale)  # null becomes NaN
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(x) <= LARGEST))])
    ends = ends - ends[0]
    good = (bad[ends[1:]] == bad[ends[:-1]]) & ~np.asarray(lists.is_null())
    if dims is not None:
        good &= np.diff(ends) == dims
    rows = np.flatnonzero(good)
    if dims is not None:
        at = ends[rows][:, None] + np.arange(dims)[None, :]
        return rows, x[at].astype(np.int64)
    return rows, [x[a:b].astype(np.int64) for a, b in zip(ends[rows], ends[rows + 1])]
