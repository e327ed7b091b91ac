"""Embedding columns as matrices of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are usable, those rows as doubles).

    Unusable: NULL, without components, or with a NULL or non-finite component. Rows may differ in
    dimension only across calls that the caller keeps apart; within a batch the usual one is the
    first usable row's, and ``ragged`` sorts the others out.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan"))
    values = np.asarray(flat)
    bad = np.zeros(len(sizes), dtype=bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bad[owner[~np.isfinite(values)]] = True
    usable = (sizes > 0) & ~bad
    width = int(sizes.max(initial=0))
    if not usable.any():
        return usable, np.zeros((0, width))
    dims = np.unique(sizes[usable])
    if len(dims) > 1:
        raise ValueError(f"vectors of different dimensions meet: {dims.tolist()}")
    return usable, values[np.repeat(usable, sizes)].reshape(-1, int(dims[0]))
