"""Small helpers shared by the operators: words, carried columns, partition counts, grouped batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from functools import cache
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_qs_row"


def n_partitions(spark: SparkSession) -> int:
    """Partitions for explicit exchanges: the session's shuffle setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Words of a text as long; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def packed(df: DataFrame, *leave_out: str) -> Column:
    """All columns but some as one struct, so that no name can clash with an operator's own."""
    names = [c for c in df.columns if c not in leave_out]
    if not names:
        return F.struct(F.lit(1).alias("_none")).alias(ROW)
    return F.struct(*[df[c] for c in names]).alias(ROW)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text leaves ``fold`` when divided by ``folds``; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def texts_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values cut out of one buffer."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


@cache
def _trim():
    """The C library's way to return freed memory, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def give_back() -> None:
    """Return what Arrow and the C library hold in reserve: a Python worker lives on when its task is over."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def process_memory(name: str) -> dict:
    """What a Python worker keeps from one task to the next. Functions and their modules travel with the plan, so
    their own globals last no longer than a task."""
    place = sys.modules.setdefault("quayside_process_memory", ModuleType("quayside_process_memory"))
    return vars(place).setdefault(name, {})


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``: the last group of what has been read
    waits until its end has been seen."""
    held: list[pa.Table] = []
    n_held = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(pa.Table.from_batches([batch]))
        n_held += batch.num_rows
        if n_held < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        same = np.ones(table.num_rows, bool)
        for key in keys:
            values = table[key].to_numpy()
            same &= values == values[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        held, n_held = [table.slice(cut)], table.num_rows - cut
        rows = max(rows, 2 * n_held)
    if n_held:
        yield pa.concat_tables(held).combine_chunks()


def group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Start of every group, and the end, of a table sorted by ``keys``."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), n)


def pairs_within(bounds: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) inside groups given by ``bounds``, at most about ``most`` at a time."""
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    start = np.arange(bounds[0], bounds[-1])
    partners = ends - start - 1
    total = np.concatenate([[0], np.cumsum(partners)])
    at = 0
    while at < len(start):
        upto = int(np.searchsorted(total, total[at] + most, "right")) - 1
        upto = max(upto, at + 1)
        count = partners[at:upto]
        if n := int(count.sum()):
            i = np.repeat(start[at:upto], count)
            j = i + 1 + np.arange(n) - np.repeat(total[at:upto] - total[at], count)
            yield i, j
        at = upto


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder; what follows starts from there."""
    from quayside.session import shared_folder

    shared_folder(df.sparkSession)
    return df.checkpoint()




def range_cuts(ids: DataFrame, column: str, parts: int) -> np.ndarray:
    """At most ``parts`` - 1 numbers that cut the ids into ranges of about equal numbers of rows."""
    if parts < 2:
        return np.zeros(0, np.int64)
    wanted = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx(column, wanted, 20 * parts)).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def range_of(column: Column, cuts: np.ndarray) -> Column:
    """Number of the range an id falls in; a null id is in the last."""

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, ids.fillna(0).to_numpy().astype(np.int64), "left")
        return pd.Series(np.where(ids.isna(), len(cuts), at).astype(np.int32))

    return number(column)
