"""Triage rules as data: a predicate, a status and a reason, all of them Columns.

A rule list is ordered; the first rule whose predicate holds decides. An empty list decides
nothing, so every row is approved.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.money import REVENUE_TYPE, amount_text
from quayside.functions.text import quoted

APPROVED = "approved"
DECLINED = "declined"
MANUAL_REVIEW = "manual_review"

# Default appetite, sanctioned industries and spellings of New York.
MIN_REVENUE = Decimal("10000")
MAX_REVENUE = Decimal("500000000")
SANCTIONED_INDUSTRIES = ("Gambling", "Tobacco", "Weapons Manufacturing")
NEW_YORK = ("NY", "NEW YORK", "NEW YORK STATE")


@dataclass(frozen=True)
class Rule:
    """``predicate`` and ``reason`` may use any column of the validated submission.

    Those are the normalised fields, and ``revenue_source``, the revenue as it was written.
    A reason is only computed for rows its rule decides.
    """

    name: str
    predicate: Column
    status: str
    reason: Column


def _amount(value: Decimal) -> Column:
    return F.lit(str(value)).cast(REVENUE_TYPE)


def revenue_out_of_appetite(
    min_revenue: Decimal = MIN_REVENUE, max_revenue: Decimal = MAX_REVENUE
) -> list[Rule]:
    """Decline revenue above the maximum or below the minimum; both bounds are acceptable."""
    revenue = F.col("revenue")
    shown = amount_text(revenue, F.col("revenue_source"))
    low, high = Decimal(min_revenue), Decimal(max_revenue)
    return [
        Rule(
            "revenue_above_appetite",
            revenue > _amount(high),
            DECLINED,
            F.concat(
                F.lit("Revenue $"), shown, F.lit(f" exceeds the maximum appetite of ${high:,}.")
            ),
        ),
        Rule(
            "revenue_below_appetite",
            revenue < _amount(low),
            DECLINED,
            F.concat(
                F.lit("Revenue $"), shown, F.lit(f" is below the minimum appetite of ${low:,}.")
            ),
        ),
    ]


def sanctioned_industry(industries: Iterable[str] | None = None) -> Rule:
    """Decline industries of the list; an empty list means the default one."""
    listed = sorted(set(industries or ())) or list(SANCTIONED_INDUSTRIES)
    return Rule(
        "sanctioned_industry",
        F.col("industry").isin(*listed),
        DECLINED,
        F.concat(
            F.lit("Industry "), quoted(F.col("industry")), F.lit(" is outside our appetite.")
        ),
    )


def construction_new_york() -> Rule:
    return Rule(
        "construction_new_york",
        (F.col("industry") == "Construction") & F.col("state").isin(*NEW_YORK),
        MANUAL_REVIEW,
        F.lit(
            "Construction submissions in New York require manual review "
            "due to complex local regulations (e.g., Labor Law 240/241)."
        ),
    )


def default_rules() -> list[Rule]:
    """Cheapest test first: revenue, sanctions, New York construction."""
    return [*revenue_out_of_appetite(), sanctioned_industry(), construction_new_york()]


def first_match(rules: Sequence[Rule]) -> Column:
    """Struct (status, reason) of the first rule that fires, null when none does."""
    fired = F.when(F.lit(False), F.lit(None).cast("struct<status:string,reason:string>"))
    for rule in rules:
        fired = fired.when(
            rule.predicate,
            F.struct(F.lit(rule.status).alias("status"), rule.reason.alias("reason")),
        )
    return fired
