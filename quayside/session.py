"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the library is tested under."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``, set for use by
    ``checkpoint()``.

    Only a local master, where driver and executors share one disk, may fall back to a
    temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and not current:
        spark.sparkContext.setCheckpointDir(configured)
    if configured or current:
        return configured or current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="quayside-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind. They would lie on the executors' disks until the driver
    happens to collect its garbage, beside those of all that follows."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def is_storable(kind: T.DataType) -> bool:
    """Whether ``stored`` can hold it; what cannot be written as a column are values of no type and calendar intervals."""
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(is_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return is_storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return is_storable(kind.keyType) and is_storable(kind.valueType)
    return not isinstance(kind, (T.NullType, T.CalendarIntervalType))


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to the shared folder, in columns, and read from there by all that use them.

    What is costly to compute and used several times in unlike columns would otherwise be computed each time;
    a checkpoint holds whole rows, which are larger and read whole. The shuffles it took are removed when it is written.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
