"""Vectors as whole numbers, for the operators that need exact sums and ties."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vec: str):
    """True where a vector is there and holds neither nulls nor non-finite numbers (an empty one does not)."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & fine, F.lit(False))


def whole_numbers(rows: DataFrame, vec: str, scale: int) -> tuple[DataFrame, int]:
    """``rows`` without unusable vectors, ``floor(scale * x)`` for each component ``x``, and their length.

    Shorter vectors get zeros at the end. So that a sum of products over a vector fits 64 bits,
    numbers beyond ``2 ** 30 / sqrt(length)`` (16 million for 4,096 components) are cut to that;
    ``scale * x`` of any usual embedding is far below.
    """
    good = rows.filter(usable(vec))
    dims = int(good.agg(F.max(F.size(vec))).first()[0] or 0)
    most = int(2**30 / math.sqrt(max(1, dims)))
    whole = F.transform(vec, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(most)), F.lit(-most)))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(vec))
    return good.withColumn(vec, F.concat(whole, zeros)), dims


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column of whole numbers, each of ``dims``."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)
