"""Revenue parsing and money formatting. Amounts are DECIMAL(38,12), never DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import PYTHON_WHITESPACE

REVENUE_DECIMALS = 12
REVENUE_TYPE = f"decimal(38,{REVENUE_DECIMALS})"
SUFFIX_FACTORS = {"k": 1_000, "m": 1_000_000, "b": 1_000_000_000}


def clean_amount(text: Column) -> Column:
    """Drop currency signs, thousands separators, whitespace and digit-group underscores."""
    return F.translate(text, "$,_" + PYTHON_WHITESPACE, "")


def parse_revenue_strict(text: Column) -> Column:
    """Amount held in a string, or null when it is not a plain number.

    Digits beyond the twelfth decimal are not rounded away, which could carry an amount over a limit: unless
    they are all zero they count as one unit of the last decimal, away from zero.
    """
    return _exact(clean_amount(text))


def _exact(cleaned: Column) -> Column:
    beyond = rf"^([+-]?\d*\.\d{{{REVENUE_DECIMALS}}})(\d*[1-9]\d*)$"
    unit = F.when(cleaned.startswith("-"), F.lit(f"-1e-{REVENUE_DECIMALS}")).otherwise(F.lit(f"1e-{REVENUE_DECIMALS}"))
    # One digit less on the left leaves room for the carry, so that the sum keeps all decimals.
    kept = F.regexp_extract(cleaned, beyond, 1).try_cast(f"decimal(37,{REVENUE_DECIMALS})")
    cut = kept + unit.cast(f"decimal({REVENUE_DECIMALS},{REVENUE_DECIMALS})")
    return F.when(cleaned.rlike(beyond), cut.try_cast(REVENUE_TYPE)).otherwise(cleaned.try_cast(REVENUE_TYPE))


def coerce_revenue_lenient(text: Column) -> Column:
    """Like the strict parser, and accepts one k / m / b multiplier at the end."""
    cleaned = clean_amount(text)
    scaled = F.substring(cleaned, 1, F.char_length(cleaned) - 1).try_cast(REVENUE_TYPE)
    last = F.lower(F.right(cleaned, F.lit(1)))
    amount = F.when(F.lit(False), F.lit(None).cast(REVENUE_TYPE))
    for suffix, factor in SUFFIX_FACTORS.items():
        amount = amount.when(
            last == suffix, (scaled * F.lit(factor).cast("decimal(10,0)")).try_cast(REVENUE_TYPE)
        )
    return amount.otherwise(_exact(cleaned))


def is_not_finite(text: Column) -> Column:
    """Words a decimal parser accepts but no amount may be."""
    return F.coalesce(
        clean_amount(text).rlike(r"(?i)^[+-]?(s?nan\d*|inf|infinity)[kmb]?$"), F.lit(False)
    )


def _formatted(amount: Column, pattern: str) -> Column:
    return F.call_function("format_number", amount, F.lit(pattern))


def amount_text(amount: Column, source: Column | None = None) -> Column:
    """Thousands-separated amount; keeps the decimals as written when ``source`` has them."""
    plain = _formatted(amount, "#,##0." + "#" * REVENUE_DECIMALS)
    if source is None:
        return plain
    cleaned = clean_amount(source)
    sign = F.when(cleaned.startswith("-"), "-").otherwise("")
    whole = F.regexp_extract(cleaned, r"^[+-]?(\d+)\.\d+$", 1)
    decimals = F.regexp_extract(cleaned, r"^[+-]?\d+(\.\d+)$", 1)
    written = F.concat(sign, _formatted(whole.try_cast("decimal(38,0)"), "#,##0"), decimals)
    return F.when(decimals != "", written).otherwise(plain)
