"""Reading inputs, writing rejects, and folders of any file system; see ``ledger`` for the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("company_id", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("revenue", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("broker_id", T.StringType()),
    ]
)
DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Batch input; text formats must come with a schema, nothing is inferred."""
    if fmt != "parquet" and schema is None:
        raise ValueError(f"{fmt} input needs a schema")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def read_submissions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, fmt, None if fmt == "parquet" else SUBMISSION_SCHEMA)


def read_deliveries(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, fmt, None if fmt == "parquet" else DELIVERY_SCHEMA)


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON payload per line, kept as text so that source types survive."""
    return spark.read.text(path).select(F.col("value").alias("payload"))


def read_existing(spark: SparkSession, path: str) -> DataFrame:
    """Known companies: company_id, company_name, zip_code and the order column seq."""
    return read_table(spark, path)


def read_risk(spark: SparkSession, path: str) -> DataFrame:
    """Risk data, one row per company_id."""
    return read_table(spark, path)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental input from a folder (or glob) of files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _folder(spark: SparkSession, path: str):
    """Folder and its file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ledger_exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, path)
    return fs.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.mkdirs(folder)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    folder, fs = _folder(spark, path)
    return [found.getPath().getName() for found in fs.listStatus(folder)] if fs.exists(folder) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def write_split(
    valid: DataFrame, rejected: DataFrame, valid_path: str, rejects_path: str, batch: int | str
) -> None:
    """Valid rows and rejects to their own tables; a batch that runs again replaces its own folders."""
    valid.write.mode("overwrite").parquet(f"{valid_path}/batch={batch}")
    rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch}")
