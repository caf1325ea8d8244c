"""Arrow text columns as the operators want them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def whole(texts: pa.Array) -> pa.Array:
    """A copy without nulls (empty instead) and without an offset into a larger batch.

    String kernels read slices of re-typed columns at the wrong place, so slices
    are copied before any of them.
    """
    return pa.concat_arrays([pc.fill_null(texts, "")])


def byte_slices(batch: pa.RecordBatch, text: str, limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(start, end - start)
        start = end
