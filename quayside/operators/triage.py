"""Validation of raw submissions and rule-based triage. Row-local: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.money import (
    REVENUE_TYPE,
    is_not_finite,
    parse_revenue_strict,
)
from quayside.functions.payload import (
    Field,
    source_field,
    with_column_fields,
    with_payload_fields,
)
from quayside.functions.text import normalise_state, quoted, strip, title_case
from quayside.operators.rules import APPROVED, Rule, default_rules, first_match

SUBMISSION_FIELDS = (
    "company_id", "company_name", "revenue", "industry", "state", "zip_code", "broker_id",
)
RESULT_FIELDS = (*SUBMISSION_FIELDS, "status", "reason")

# Separates error texts while they are one string; a control character no message holds.
_SEPARATOR = "\x1f"

_REQUIRED = "Field required"
_NOT_TEXT = "Input should be a valid string"


def _text_error(name: str) -> Column:
    field = source_field(name)
    return F.when(field.is_absent, f"{name}: {_REQUIRED}").when(
        ~field.is_string, f"{name}: {_NOT_TEXT}"
    )


def _optional_text_error(name: str) -> Column:
    field = source_field(name)
    return F.when(~field.is_missing & ~field.is_string, f"{name}: {_NOT_TEXT}")


def _coerced_text_error(name: str) -> Column:
    """Fields whose own normaliser refuses anything but text."""
    field = source_field(name)
    return F.when(field.is_absent, f"{name}: {_REQUIRED}").when(
        ~field.is_string, f"{name}: Value error, {name} must be a string"
    )


def _revenue_error(parsed: Column) -> Column:
    field = source_field("revenue")
    unreadable = F.concat(
        F.lit("revenue: Value error, Cannot parse revenue from string: "), quoted(field.text)
    )
    return (
        F.when(parsed.isNotNull(), F.lit(None).cast("string"))
        .when(field.is_absent, f"revenue: {_REQUIRED}")
        .when(
            field.is_string & is_not_finite(field.text), "revenue: Input should be a finite number"
        )
        .when(field.is_string, unreadable)
        .otherwise("revenue: Decimal input should be an integer, float, string or Decimal object")
    )


def revenue_of(field: Field) -> Column:
    return F.when(field.is_string, parse_revenue_strict(field.text)).when(
        field.is_number, field.text.try_cast(REVENUE_TYPE)
    )


def submission_columns(revenue: str) -> dict[str, Column]:
    """Normalised submission fields from split source fields and the parsed revenue column."""
    return {
        "company_id": source_field("company_id").text,
        "company_name": source_field("company_name").text,
        "revenue": F.col(revenue),
        "revenue_source": source_field("revenue").text,
        "industry": title_case(source_field("industry").text),
        "state": normalise_state(source_field("state").text),
        "zip_code": source_field("zip_code").text,
        "broker_id": source_field("broker_id").text,
    }


def validate_submissions(
    raw: DataFrame, payload: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per input row: normalised fields, ``is_valid`` and ``validation_errors``.

    Source fields are own columns, or those of a JSON ``payload`` column. Errors of all fields
    are collected; a blank id is only reported when the rest is fine.
    """
    if payload is None:
        split = with_column_fields(raw, SUBMISSION_FIELDS)
    else:
        split = with_payload_fields(raw, F.col(payload), SUBMISSION_FIELDS)
    split = split.withColumn("_revenue", revenue_of(source_field("revenue")))
    errors = F.concat_ws(
        _SEPARATOR,
        _text_error("company_id"),
        _text_error("company_name"),
        _revenue_error(F.col("_revenue")),
        _coerced_text_error("industry"),
        _coerced_text_error("state"),
        _optional_text_error("zip_code"),
        _optional_text_error("broker_id"),
    )
    blank_id = strip(source_field("company_id").text) == ""
    found = F.when(F.col("_errors") != "", F.split("_errors", _SEPARATOR)).when(
        blank_id, F.array(F.lit("Value error, company_id must not be blank"))
    )
    # The same conditions without texts: where only valid rows matter, no text is built.
    valid = ~blank_id & F.col("_revenue").isNotNull()
    for name in ("company_id", "company_name", "industry", "state"):
        valid = valid & source_field(name).is_string
    for name in ("zip_code", "broker_id"):
        valid = valid & (source_field(name).is_missing | source_field(name).is_string)
    normalised = [c.alias(name) for name, c in submission_columns("_revenue").items()]
    return split.withColumn("_errors", errors).select(
        *keep,
        *normalised,
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
        found.alias("validation_errors"),
    )


def valid_only(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid").drop("is_valid", "validation_errors")


def rejects(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Invalid rows with their id and all errors, for a dead-letter table."""
    return validated.filter("not is_valid").select(*keep, "company_id", "validation_errors")


def decide(valid: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``status`` and ``reason``: first rule that fires, else approved without reason."""
    fired = first_match(default_rules() if rules is None else rules)
    return (
        valid.withColumn("_fired", fired)
        .withColumn("status", F.coalesce(F.col("_fired.status"), F.lit(APPROVED)))
        .withColumn("reason", F.col("_fired.reason"))
        .drop("_fired")
    )


def triage(
    raw: DataFrame,
    rules: Sequence[Rule] | None = None,
    payload: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Validated and decided submissions; invalid rows are left out (see ``rejects``)."""
    valid = valid_only(validate_submissions(raw, payload, keep))
    return decide(valid, rules).select(*keep, *RESULT_FIELDS)


def by_status(decided: DataFrame, status: str) -> DataFrame:
    return decided.filter(F.col("status") == status)
