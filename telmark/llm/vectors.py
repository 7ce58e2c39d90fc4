"""What the two vector operators share: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """True for a vector that is not null, holds only finite numbers, and is not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce(embedding.isNotNull() & ~bad & some, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long vectors as float64 rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))
