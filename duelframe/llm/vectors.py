"""Vectors as whole numbers: which rows take part, and their components as 256ths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Largest absolute value of a scaled component; beyond it products would not fit into 64 bits.
LARGEST = 1 << 26


def complete(vector: str | Column) -> Column:
    """Whether a vector is there, has components, and none of them is null, NaN or infinite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def scaled(vector: str | Column) -> Column:
    """floor(256 * x) of every component. Components of 2^18 or more are an error, as their products could overflow."""
    v = F.col(vector) if isinstance(vector, str) else vector
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    wide = F.exists(whole, lambda x: F.abs(x) > LARGEST)
    return F.when(wide, F.raise_error(F.lit("a component is too large for exact whole-number scores")).cast("array<bigint>")).otherwise(whole)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; another width is an error."""
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes != width).any():
        raise ValueError(f"vectors have {sorted(set(sizes.tolist()) | {width})} components; one table has one width")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), width)
