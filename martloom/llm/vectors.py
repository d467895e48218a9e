"""Embeddings as whole numbers inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Beyond this a sum over components can leave 64 bits.
LARGEST = 1 << 26


def whole_vectors(column: pa.Array, scale: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and floor(scale * x) of the usable vectors of a list column.

    A vector is usable if neither it nor a component is null, all are finite, and, where
    ``size`` is given, there are that many. Shorter vectors are filled up with zeros.
    A scaled component of more than 2**26 raises, as 64 bits can't hold what is computed from it.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    rows = np.flatnonzero(lengths >= 0 if size is None else lengths == size)
    column, lengths = column.take(pa.array(rows)), lengths[rows]
    flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
    values = np.zeros((len(rows), size if size is not None else int(lengths.max(initial=0))))
    values[np.arange(values.shape[1]) < lengths[:, None]] = flat
    usable = np.isfinite(values).all(axis=1)
    values = np.floor(values[usable] * scale)
    if np.abs(values).max(initial=0) > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return rows[usable], values.astype(np.int64)
