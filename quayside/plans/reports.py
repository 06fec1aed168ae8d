"""Counts and shares over results: single aggregates with a partial step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.idempotency import KEY


def status_counts(results: DataFrame, *by: str) -> DataFrame:
    """Rows per status, or per the given columns."""
    return results.groupBy(*(by or ("status",))).agg(F.count(F.lit(1)).alias("n"))


def replay_rate(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("n_deliveries"),
        F.count_if(F.col("was_replay")).alias("n_replays"),
        F.coalesce(F.avg(F.col("was_replay").cast("int")), F.lit(0.0)).alias("replay_rate"),
    )


def missing_field_counts(extractions: DataFrame) -> DataFrame:
    """How often each required field is missing."""
    return (
        extractions.select(F.explode("missing_fields").alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ledger_size(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("n_keys"))


def processing_count(records: DataFrame) -> DataFrame:
    """Distinct keys, i.e. how many times something was processed.

    Grouping first keeps a key with very many deliveries down to one row per task.
    """
    keys = records.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    return keys.agg(F.count(F.lit(1)).alias("n_processed"))
