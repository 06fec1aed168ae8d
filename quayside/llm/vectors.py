"""Columns of vectors as checked double matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector with finite components only, of which one is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, column: str) -> int:
    """The one length that all vectors of ``df`` have; 0 for an empty table."""
    found = df.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if found[0] != found[1]:
        raise ValueError(f"vectors of {found[0]} to {found[1]} components cannot be compared")
    return int(found[0] or 0)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def padded(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List column of whole numbers as a matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def summed(
    rows: DataFrame, column: str, width: int, measure: Callable[[np.ndarray], np.ndarray], kind: str
) -> list:
    """Sums over all rows of the numbers that ``measure`` takes of matrices of rows. A task sends one row per
    number, they are added up by key, and the driver gets as many as there are numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(padded(batch.column(0), width))
                total = part if total is None else total + part
        if total is None:
            return
        values = [Decimal(int(v)) for v in total] if kind.startswith("decimal") else total
        number_type = pa.decimal128(38, 0) if kind.startswith("decimal") else pa.float64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(values, number_type)], names=["i", "total"]
        )

    parts = rows.select(column).mapInArrow(run, f"i int, total {kind}")
    found = parts.groupBy("i").agg(F.sum("total").cast(kind).alias("total")).collect()
    return [r["total"] for r in sorted(found, key=lambda r: r["i"])]


def triangle(values: list, width: int, dtype) -> np.ndarray:
    """Symmetric matrix from its upper triangle by rows."""
    out = np.zeros((width, width), dtype)
    out[np.triu_indices(width)] = values
    return np.triu(out, 1).T + out
