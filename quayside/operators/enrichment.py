"""Enrichment of companies with risk data: table lookup, attempt logs and batch reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.http import attempt_error_text, classify_http, enrichment_error_text
from quayside.functions.naming import snake_case_json
from quayside.functions.rows import last_row
from quayside.functions.text import quoted
from quayside.operators.extraction import Recorded
from quayside.session import shared_folder

MAX_ATTEMPTS = 3


def one_per_company(risk: DataFrame, key: str = "company_id", order: Sequence[str] = ()) -> DataFrame:
    """One row per company: the last by ``order`` and then by the other columns in turn, nulls first."""
    rest = [*order, *(c for c in risk.columns if c != key and c not in order)]
    if not rest:
        return risk.distinct()
    last = risk.groupBy(key).agg(last_row(rest, risk.schema).alias("_last"))
    return last.select(*[F.col(c) if c == key else F.col(f"_last.`{c}`").alias(c) for c in risk.columns])


def enrich(
    submissions: DataFrame, risk: DataFrame, key: str = "company_id", order: Sequence[str] = ()
) -> DataFrame:
    """Left join to risk data: one row per submission, with the last row of its company.

    A miss is a missing key; a hit whose data are all null still counts as success.
    """
    found = one_per_company(risk, key, order).withColumn("success", F.lit(True))
    joined = submissions.join(found, key, "left")
    success = F.coalesce(F.col("success"), F.lit(False))
    warning = F.concat(F.lit("No enrichment data found for "), quoted(F.col(key)))
    return joined.withColumn("success", success).withColumn(
        "warning", F.when(~F.col("success"), warning)
    )


def resolve_api_attempts(
    attempts: DataFrame,
    key: str = "company_id",
    attempt: str = "attempt",
    status: str = "status_code",
    transport_error: str | None = None,
    data: str | None = None,
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Outcome per company of walking its attempts in order.

    The first success or client error ends the walk; otherwise the last permitted attempt does.
    One aggregate with a partial step; attempts beyond the limit are ignored. The JSON text of a
    success comes with its keys in snake case.
    """
    lost = F.col(transport_error) if transport_error else None
    classed = attempts.filter(F.col(attempt) <= max_attempts).select(
        key,
        F.struct(
            F.col(attempt).alias("attempt"),
            classify_http(F.col(status), lost).alias("outcome"),
            attempt_error_text(F.col(key).cast("string"), F.col(status), lost).alias("detail"),
            *([F.col(data).alias("data")] if data else []),
        ).alias("_try"),
    )
    ends = F.col("_try.outcome") != "retriable"
    ended = classed.groupBy(key).agg(
        F.min_by(F.when(ends, F.col("_try")), F.when(ends, F.col("_try.attempt"))).alias("_end"),
        F.max_by("_try", F.col("_try.attempt")).alias("_last"),
    )
    final = ended.select(key, F.coalesce("_end", "_last").alias("_final"))
    success = F.col("_final.outcome") == "ok"
    columns = [
        key,
        success.alias("success"),
        F.col("_final.attempt").alias("attempts_used"),
        enrichment_error_text(
            F.col("_final.outcome"), F.col("_final.detail"), max_attempts
        ).alias("error"),
    ]
    if data:
        columns.append(F.when(success, snake_case_json(F.col("_final.data"))).alias("data"))
    return final.select(*columns)


def enrichment_report(results: DataFrame) -> DataFrame:
    """Counts and success rate, 0.0 when there are no results."""
    return results.agg(
        F.count_if(F.col("success")).alias("n_succeeded"),
        F.count_if(~F.col("success")).alias("n_failed"),
        F.coalesce(F.avg(F.col("success").cast("int")), F.lit(0.0)).alias("success_rate"),
    )


Fetch = Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]] | Recorded


def fetch_attempts(
    companies: DataFrame, fetch: Fetch, key: str = "company_id", partitions: int | None = None
) -> DataFrame:
    """Attempt log produced by a user's batch fetch function.

    ``fetch`` gets pandas batches of ids and returns attempt, status_code, transport_error and
    data (JSON text) per call; it does not raise. ``partitions`` is the number of concurrent
    callers. The log is checkpointed so that no call is made twice. ``fetch`` may also be a record of earlier
    calls, of which those of the companies are taken.
    """
    shared_folder(companies.sparkSession)
    ids = companies.select(key).distinct()
    if isinstance(fetch, Recorded):
        return fetch.log.select(key, "attempt", "status_code", "transport_error", "data").join(ids, key, "left_semi")
    if partitions:
        ids = ids.repartition(partitions, key)
    schema = (
        f"{key} {companies.schema[key].dataType.simpleString()}, attempt int, status_code int, "
        "transport_error string, data string"
    )
    return ids.mapInPandas(fetch, schema).checkpoint()
