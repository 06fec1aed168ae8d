"""The stored ledger: one folder per batch, its files bucketed and sorted by key.

A lookup joins incoming keys with the ledger. Because the files are bucketed by key, the incoming keys go to the
buckets and the ledger is read where it lies: it is never shuffled, and of a batch's result columns only those of
keys that came are passed on. Batches are merged now and then, so a bucket does not end as many small files.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.rows import last_row
from quayside.operators.idempotency import KEY, unseen_keys
from quayside.session import shared_folder
from quayside.sources.tables import list_folder, remove_folder

# A ledger keeps the number it was begun with; choose it so that a bucket of the whole ledger suits one task.
BUCKETS = 16
BATCH = "batch"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def _root(spark: SparkSession, path: str, buckets: int) -> tuple[str, int]:
    """Folder of the files and number of buckets, which its name tells."""
    for name in list_folder(spark, path):
        if found := re.fullmatch(r"in_(\d+)_buckets", name):
            return f"{path}/{name}", int(found[1])
    return f"{path}/in_{buckets}_buckets", buckets


def _table(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> tuple[str, int]:
    """Name of the session's table over the files; what the catalog knows of it is made anew from the files."""
    root, buckets = _root(spark, path.rstrip("/"), buckets)
    columns = schema.toDDL()
    name = f"quayside_ledger_{hashlib.md5(f'{root} {columns}'.encode()).hexdigest()}"
    quoted = root.replace("\\", "\\\\").replace("'", "\\'")
    # The folders say which batches there are, not the catalog, which other sessions do not share.
    tracked = spark.conf.get(_TRACKED)
    spark.conf.set(_TRACKED, "false")
    spark.sql(
        f"create table if not exists {name} ({columns}, {BATCH} string) using parquet options (path '{quoted}') "
        f"partitioned by ({BATCH}) clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets"
    )
    spark.conf.set(_TRACKED, tracked)
    spark.catalog.refreshTable(name)
    return name, buckets


def _write(rows: DataFrame, name: str, buckets: int, batch: str) -> None:
    """The rows as the files of a batch, in place of any it had; one file per bucket."""
    label = batch.replace("\\", "\\\\").replace("'", "\\'")
    spark = rows.sparkSession
    shared_folder(spark)
    # Settled first: a table cannot be written from what reads it.
    settled = rows.checkpoint().repartition(buckets, KEY)
    spark.sql(f"insert overwrite table {name} partition ({BATCH} = '{label}') select * from {{rows}}", rows=settled)
    spark.catalog.refreshTable(name)


def open_ledger(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """The ledger as a table to look keys up in, for ``process_once`` and ``run_pipeline``; empty before the first
    batch. A key can be there twice after a merge that was cut off, which these allow for."""
    name, _ = _table(spark, path, schema, buckets)
    return spark.table(name).select(*schema.names)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """Stored results, one row per key."""
    return _one_per_key(open_ledger(spark, path, schema, buckets))


def _one_per_key(ledger: DataFrame) -> DataFrame:
    rest = [c for c in ledger.columns if c != KEY]
    if not rest:
        return ledger.distinct()
    last = ledger.groupBy(KEY).agg(last_row(rest, ledger.schema).alias("_last"))
    return last.select(*[F.col(c) if c == KEY else F.col(f"_last.`{c}`").alias(c) for c in ledger.columns])


def upsert_ledger(fresh: DataFrame, path: str, batch: int | str, buckets: int = BUCKETS) -> None:
    """Put-if-absent: store results of keys the ledger does not hold yet.

    ``fresh`` has at most one row per key, as ``process_once`` and ``run_pipeline`` return it. Running a batch
    again compares with the other batches only and replaces its own files, so a retry neither loses nor
    doubles rows, also after the batch has been merged.
    """
    spark = fresh.sparkSession
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in fresh.schema.fields])
    name, buckets = _table(spark, path, columns, buckets)
    stored = spark.table(name).filter(F.col(BATCH) != str(batch))
    _write(unseen_keys(fresh, stored), name, buckets, str(batch))


def store_batch(rows: DataFrame, path: str, batch: int | str, buckets: int = BUCKETS) -> None:
    """The rows as one batch, whatever others hold of their keys."""
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    name, buckets = _table(rows.sparkSession, path, columns, buckets)
    _write(rows, name, buckets, str(batch))


def drop_batch(spark: SparkSession, path: str, batch: int | str) -> None:
    root, _ = _root(spark, path.rstrip("/"), BUCKETS)
    remove_folder(spark, f"{root}/{BATCH}={batch}")


def compact_ledger(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS, keep: Column | None = None
) -> None:
    """Merge all batches into one, one row per key: the last by the other columns in turn. Rows for which ``keep``
    does not hold then go.

    The merged files are complete before any other goes, so no key is lost whenever it is cut off; the next merge
    takes up what was left. No batch may be written meanwhile.
    """
    name, buckets = _table(spark, path, schema, buckets)
    root, _ = _root(spark, path.rstrip("/"), buckets)
    before = [f for f in list_folder(spark, root) if f.startswith(f"{BATCH}=")]
    if len(before) < 2:
        return
    merged = _one_per_key(spark.table(name).select(*schema.names))
    merged = merged if keep is None else merged.filter(keep)
    _write(merged, name, buckets, f"merged-{uuid.uuid4().hex}")
    for folder in before:
        remove_folder(spark, f"{root}/{folder}")
    spark.catalog.refreshTable(name)
