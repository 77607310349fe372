"""Arrow batches in parts of bounded size, for functions that make more of a row than it holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters, ids or pieces of one part. As Python objects they take some 10 MB.
PART_ITEMS = 1 << 18


def parts(batch: pa.Array, most: int = PART_ITEMS) -> Iterator[pa.Array]:
    """Slices of an array of texts or lists, in order; each has few items or a single row."""
    listed = pa.types.is_list(batch.type) or pa.types.is_large_list(batch.type)
    sizes = pc.list_value_length(batch) if listed else pc.binary_length(batch)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def by_parts(run: Callable[[pa.Array], pa.Array], batch: pa.Array, most: int = PART_ITEMS) -> pa.Array:
    """``run`` on every part, together again; an empty batch is a part."""
    done = [run(part) for part in parts(batch, most)]
    return pa.concat_arrays(done) if done else run(batch)
