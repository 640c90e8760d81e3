"""Integer vectors for the exact vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components of integer vectors are less than this: squared distances of 64 of them fit 64 bits.
LIMIT = 1 << 27


def is_whole(vector: Column, dims: int) -> Column:
    """Whether a vector is there, with ``dims`` components, none of them null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def to_integers(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x), x as a double. Those of ``LIMIT`` and above end the job with a message."""

    def component(x: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(scaled) < LIMIT, scaled.cast("int")).otherwise(
            F.raise_error(F.lit(f"vector component too large for exact distances: limit {LIMIT}")).cast("int")
        )

    return F.transform(vector, component)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column without nulls, each list of ``dims`` numbers, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims)
