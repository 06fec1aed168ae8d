"""Joins in which both sides may hold many rows of one key.

A join that hands at most one row per key to the other side needs nothing of its own: Spark splits a
large partition of a sort-merge join at run time (``spark.sql.adaptive.skewJoin``) and repeats the other side's
small part. That goes by bytes, though, and says nothing about a join whose output is the product of two groups. Here
the heaviest keys of both sides are counted, and their products cut into cells. No row is dropped, nothing is
sampled, and the same happens at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import shared_folder

SLICE_ROWS = 1_000_000
# Most keys a list may hold, so that it can be broadcast: see ``heavy_keys``.
LISTED_KEYS = 65_536


def heavy_keys(
    rows: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS, listed: int = LISTED_KEYS
) -> DataFrame:
    """Keys with more rows than a slice, and the number of slots each should get.

    A slice has ``slice_rows`` rows; if more than ``listed`` keys exceed that, it grows to the
    rows of all of them divided by ``listed``. At most ``listed`` keys can exceed it then, and every key
    that does is in the list: what bounds the list is arithmetic, not a cut. The counts are
    written to the shared checkpoint folder, so all users see the same slots.
    """
    shared_folder(rows.sparkSession)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
    for key in keys:
        counted = counted.filter(F.col(key).isNotNull())
    counted = counted.checkpoint()
    n_keys, n_rows = counted.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if n_keys > listed:
        slice_rows = -(-n_rows // listed)
    return counted.filter(F.col("_n") > slice_rows).select(
        *keys, F.ceil(F.col("_n") / slice_rows).cast("int").alias("_slots")
    )


def n_tasks(spark: SparkSession) -> int:
    """Tasks for work that is far larger than its bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _slot_of(spread_by: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(spread_by), slots).cast("int")


def _repeat(df: DataFrame, slots: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), slots - 1)))


def grid_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_spread: Column,
    right_spread: Column,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join in which both sides may hold many rows of one key.

    A heavy key becomes a grid of (left slot, right slot) cells; each left row goes to one grid
    row, each right row to one grid column, and every pair meets in exactly one cell.

    Such a join costs far more than the bytes it reads, so both sides are spread over all shuffle
    partitions rather than left to be merged into a few by size.
    """
    keys = list(keys)
    tasks = n_tasks(left.sparkSession)
    heavy_left = heavy_keys(left.select(*keys), keys, slice_rows)
    heavy_right = heavy_keys(right.select(*keys), keys, slice_rows)
    cuts = F.broadcast(
        heavy_left.withColumnRenamed("_slots", "_rows").join(
            heavy_right.withColumnRenamed("_slots", "_cols"), keys, "full"
        )
    )
    n_rows = F.coalesce(F.col("_rows"), F.lit(1))
    n_cols = F.coalesce(F.col("_cols"), F.lit(1))
    a = left.join(cuts, keys, "left").withColumn("_row", _slot_of(left_spread, n_rows))
    a = _repeat(a, n_cols, "_col").drop("_rows", "_cols")
    b = right.join(cuts, keys, "left").withColumn("_col", _slot_of(right_spread, n_cols))
    b = _repeat(b, n_rows, "_row").drop("_rows", "_cols")
    cell = [*keys, "_row", "_col"]
    return (
        a.repartition(tasks, *cell).join(b.repartition(tasks, *cell), cell).drop("_row", "_col")
    )
