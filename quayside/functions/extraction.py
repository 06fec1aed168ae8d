"""Model responses: prompts, code fences, lenient typing and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.money import REVENUE_TYPE, coerce_revenue_lenient, is_not_finite
from quayside.functions.payload import (
    IS_OBJECT,
    drop_fields,
    source_field,
    with_payload_fields,
)
from quayside.functions.text import clean_string, normalise_state, strip

EXTRACTED_FIELDS = ("company_name", "revenue", "industry", "state", "zip_code")

# The fields triage cannot do without, alphabetical.
REQUIRED_FOR_TRIAGE = ("company_name", "industry", "revenue", "state")

# Prompt wording.
PROMPT_HEAD = (
    "You are an insurance data extraction assistant.\n\n"
    "Extract the following fields from the text. If a field is not present, "
    "set its value to null. Return ONLY a raw JSON object — no markdown, "
    "no explanation, no code blocks.\n\n"
    "Fields:\n"
    "  company_name  - Name of the company being insured\n"
    "  revenue       - Annual revenue as a plain number (e.g. 5000000)\n"
    "  industry      - Business industry or sector\n"
    '  state         - US state, preferably 2-letter code (e.g. "NY")\n'
    "  zip_code      - 5-digit ZIP code if mentioned\n\n"
    "Text:\n"
)
PROMPT_REMINDER = (
    "\n\nREMINDER: Your previous response could not be parsed. Return ONLY a "
    'raw JSON object. Example: {{"company_name": "Acme", "revenue": 5000000, '
    '"industry": "Retail", "state": "NY", "zip_code": null}}'
)


def render_prompt(text: Column, attempt: Column) -> Column:
    """Prompt for one attempt; later attempts carry the formatting reminder."""
    reminder = F.when(attempt > 1, F.lit(PROMPT_REMINDER)).otherwise(F.lit(""))
    return F.concat(F.lit(PROMPT_HEAD), text, reminder)


def strip_code_fence(raw: Column) -> Column:
    """Text without one leading ```json, one leading ``` and one trailing ``` mark."""
    body = strip(raw)
    body = F.regexp_replace(body, r"\A```json", "")
    body = F.regexp_replace(body, r"\A```", "")
    return strip(F.regexp_replace(body, r"```\z", ""))


def _lenient_revenue() -> Column:
    revenue = source_field("revenue")
    return F.when(revenue.is_string, coerce_revenue_lenient(revenue.text)).when(
        revenue.is_number, revenue.text.try_cast(REVENUE_TYPE)
    )


def _lenient_text(name: str) -> Column:
    field = source_field(name)
    return F.when(field.is_string, field.text)


def _typed_extraction() -> Column:
    """Struct of the five extracted fields; values of a wrong type become null."""
    return F.struct(
        clean_string(_lenient_text("company_name")).alias("company_name"),
        _lenient_revenue().alias("revenue"),
        clean_string(_lenient_text("industry")).alias("industry"),
        normalise_state(_lenient_text("state")).alias("state"),
        _lenient_text("zip_code").alias("zip_code"),
    )


def _extraction_error() -> Column:
    """Why a response is unusable, or null when it is fine.

    The ZIP code must be text, a revenue must not be a boolean or a non-finite number.
    """
    zip_code, revenue = source_field("zip_code"), source_field("revenue")
    return (
        F.when(~F.col(IS_OBJECT), "response is not a single JSON object")
        .when(
            ~zip_code.is_missing & ~zip_code.is_string, "zip_code: Input should be a valid string"
        )
        .when(revenue.is_boolean, "revenue: Input should be a number")
        .when(
            revenue.is_string & is_not_finite(revenue.text),
            "revenue: Input should be a finite number",
        )
    )


def with_extraction(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``attempt_error`` and ``extracted`` (typed struct, null when unusable)."""
    split = with_payload_fields(responses, strip_code_fence(F.col(raw)), EXTRACTED_FIELDS)
    checked = split.withColumn("attempt_error", _extraction_error())
    typed = F.when(F.col("attempt_error").isNull(), _typed_extraction())
    return drop_fields(checked.withColumn("extracted", typed), EXTRACTED_FIELDS)


def missing_fields(extracted: Column) -> Column:
    """Sorted names of the triage fields that were not extracted."""
    return F.array_compact(
        F.array(
            *[F.when(extracted[name].isNull(), F.lit(name)) for name in REQUIRED_FOR_TRIAGE]
        )
    )


def extraction_status(valid: Column, missing: Column) -> Column:
    return F.when(~valid, "failed").when(F.size(missing) > 0, "partial").otherwise("success")
