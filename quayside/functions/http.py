"""Outcome classes and messages of risk API calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_http(status_code: Column, transport_error: Column | None = None) -> Column:
    """ok / retriable / client_error for one attempt; timeouts and lost connections retry."""
    lost = F.lit(False) if transport_error is None else transport_error.isNotNull()
    return (
        F.when(lost, "retriable")
        .when(status_code == 429, "retriable")
        .when(status_code >= 500, "retriable")
        .when(status_code >= 400, "client_error")
        .otherwise("ok")
    )


def attempt_error_text(
    company_id: Column, status_code: Column, transport_error: Column | None = None
) -> Column:
    """What went wrong in one attempt, null when nothing did."""
    code = status_code.cast("string")
    text = F.when(F.lit(False), F.lit(None).cast("string"))
    if transport_error is not None:
        text = text.when(transport_error.isNotNull(), transport_error)
    return (
        text.when(
            status_code == 429,
            F.concat(F.lit("Rate-limited by Risk API (429) for "), company_id),
        )
        .when(
            status_code >= 500,
            F.concat(F.lit("Risk API server error "), code, F.lit(" for "), company_id),
        )
        .when(
            status_code >= 400,
            F.concat(F.lit("Risk API client error "), code, F.lit(" for "), company_id),
        )
    )


def enrichment_error_text(outcome: Column, detail: Column, max_attempts: int = 3) -> Column:
    """Final message of a failed enrichment."""
    return F.when(
        outcome == "retriable",
        F.concat(F.lit(f"Transient API failure after {max_attempts} retries: "), detail),
    ).when(outcome == "client_error", F.concat(F.lit("Non-retriable API error: "), detail))
