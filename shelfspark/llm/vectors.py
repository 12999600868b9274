"""Float vectors as exact integers in bytes, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 26  # squares and products of smaller integers, summed over a vector, fit a long


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def integer_vectors(rows: DataFrame, vector_col: str, scale: int, keys: dict[str, str]) -> DataFrame:
    """``keys`` (new name -> column) and ``v``: floor(scale * x) of each component as
    little-endian 32-bit integers. Rows whose vector is NULL, empty or holds a NULL
    or non-finite component are left out; an integer of 2^26 or more raises."""
    kept = rows.select(*[F.col(c).alias(k) for k, c in keys.items()],
                       F.col(vector_col).cast("array<double>").alias("v")).where(usable(F.col("v")))

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            x = np.floor(pc.list_flatten(column).to_numpy(zero_copy_only=False) * float(scale))
            if len(x) and np.abs(x).max() >= LIMIT:
                raise ValueError(f"a vector component times {scale} is {LIMIT} or more")
            ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
            offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(offsets), pa.py_buffer(x.astype("<i4"))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=batch.schema.names)
    schema = ", ".join([*(f"`{k}` {dict(kept.dtypes)[k]}" for k in keys), "v binary"])
    return kept.mapInArrow(run, schema)


def dimension(vectors: DataFrame) -> int:
    """Components of each vector in ``v``, 0 for an empty table; vectors of different
    lengths raise."""
    low, high = vectors.agg(F.min(F.octet_length("v")), F.max(F.octet_length("v"))).first()
    if low != high:
        raise ValueError(f"vectors of {low // 4} to {high // 4} components in one table")
    return (high or 0) // 4


def matrix(column: pa.Array, kind: str = "<i4") -> np.ndarray:
    """A column of equally long bytes as rows of numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros((0, 0), kind)
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind).reshape(n, -1)


def bytes_column(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as a column of bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = (np.arange(len(rows) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
