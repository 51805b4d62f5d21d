"""Integer vectors from columns of numeric lists, for the vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integer_lists(column: pa.Array, scale: float, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(usable, offsets, values)`` of an Arrow list<double> array: which rows
    are neither null nor hold a null or non-finite component, and all
    components as ``floor(scale * x)``, held to -bound..bound."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    x = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    usable = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    with np.errstate(over="ignore"):
        whole = np.floor(scale * np.where(np.isfinite(x), x, 0.0))
    return usable, offsets, np.clip(whole, -bound, bound).astype(np.int32)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float, bound: int,
                    components: int | None = None) -> DataFrame:
    """``vec_id, v`` of the rows with a usable vector (of ``components``
    components, when given); ``v`` holds little-endian 32-bit integers."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            usable, offsets, values = integer_lists(b.column(1), scale, bound)
            if components is not None:
                usable &= np.diff(offsets) == components
            at = np.flatnonzero(usable)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)),
                 pa.array([values[offsets[i]:offsets[i + 1]].tobytes() for i in at], pa.binary())], ["vec_id", "v"])

    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
            .mapInArrow(convert, "vec_id long, v binary"))
