"""The whole submission pipeline as one plan.

Each delivery becomes one context row. Stages are functions from DataFrame to DataFrame over the
context columns; a stage that ends processing of a row sets ``halted``, and later stages leave
halted rows alone. Only the first delivery of every unseen payload goes through the stages, all
others receive its context as a replay.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.payload import (
    IS_OBJECT,
    PIPELINE_REQUIRED,
    missing_required,
    source_field,
    with_payload_fields,
)
from quayside.functions.text import quoted
from quayside.operators.breaker import FAILURE_THRESHOLD, RECOVERY_SECONDS, mark_circuit_open, open_intervals
from quayside.operators.idempotency import FIRST, KEY, Processed, process_once
from quayside.operators.rules import DECLINED, Rule, default_rules, first_match
from quayside.operators.enrichment import one_per_company
from quayside.operators.triage import SUBMISSION_FIELDS, revenue_of, submission_columns

CIRCUIT_OPEN = "circuit_open"
PENDING, APPROVED, ERROR = "pending", "approved", "error"
POTENTIAL_DUPLICATE = "potential_duplicate"

Stage = Callable[[DataFrame], DataFrame]

CONTEXT_COLUMNS = (
    "payload", "status", "company_id", "triage_reason", "enrichment", "warnings", "errors",
)

_NO_TEXTS = "array<string>"


@dataclass(frozen=True)
class PipelineStage:
    """A named stage, so that callers can insert their own before or after it."""

    name: str
    apply: Stage


def running() -> Column:
    return ~F.col("halted")


def add_text(column: str, text: Column, when: Column) -> Column:
    """``column`` with ``text`` appended where ``when`` holds."""
    return F.when(when, F.concat(F.col(column), F.array(text))).otherwise(F.col(column))


def new_contexts(firsts: DataFrame, enrichment_type: T.StructType) -> DataFrame:
    """Wrap first deliveries: status pending, nothing known yet, payload fields split out."""
    return with_payload_fields(firsts, F.col("payload"), SUBMISSION_FIELDS).select(
        "*",
        F.lit(PENDING).alias("status"),
        F.lit(None).cast("string").alias("company_id"),
        F.lit(None).cast("string").alias("triage_reason"),
        F.lit(None).cast(enrichment_type).alias("enrichment"),
        F.array().cast(_NO_TEXTS).alias("warnings"),
        F.array().cast(_NO_TEXTS).alias("errors"),
        F.lit(False).alias("halted"),
    )


def validate(contexts: DataFrame) -> DataFrame:
    """Presence of the required fields; rows lacking one end as errors."""
    message = F.when(
        F.col(IS_OBJECT),
        F.concat(F.lit("Missing required fields: ["), F.col("_missing"), F.lit("]")),
    ).otherwise(F.lit("Payload is not a JSON object"))
    failed = running() & (F.col("_missing") != "")
    company_id = source_field("company_id").text
    return contexts.withColumn("_missing", missing_required(PIPELINE_REQUIRED)).withColumns(
        {
            "status": F.when(failed, ERROR).otherwise(F.col("status")),
            "company_id": F.when(running() & ~failed, company_id).otherwise(F.col("company_id")),
            "errors": add_text("errors", message, failed),
            "halted": F.col("halted") | failed,
        }
    ).drop("_missing")


def triage_with(rules: Sequence[Rule]) -> Stage:
    """First rule that fires decides; declined rows end, other decisions leave a warning.

    Rules see the normalised field values; a revenue that is no number is null to them.
    """

    def stage(contexts: DataFrame) -> DataFrame:
        normalised = submission_columns("_revenue")
        normalised.pop("company_id")
        seen = contexts.withColumn("_revenue", revenue_of(source_field("revenue"))).withColumns(
            normalised
        )
        fired = F.when(running(), first_match(rules))
        status, reason = F.col("_fired.status"), F.col("_fired.reason")
        declined = running() & F.coalesce(status == DECLINED, F.lit(False))
        warned = running() & F.col("_fired").isNotNull() & ~declined
        pending = running() & (F.coalesce(status, F.col("status")) == PENDING)
        warning = F.concat(F.lit("Manual review required: "), reason)
        return (
            seen.withColumn("_fired", fired)
            .withColumns(
                {
                    "status": F.when(pending, APPROVED)
                    .when(F.col("_fired").isNotNull(), status)
                    .otherwise(F.col("status")),
                    "triage_reason": F.coalesce(reason, F.col("triage_reason")),
                    "warnings": add_text("warnings", warning, warned),
                    "halted": F.col("halted") | declined,
                }
            )
            .drop("_fired", "_revenue", *normalised)
        )

    return stage


def company_lookup(
    existing_ids: DataFrame | None,
    risk: DataFrame | None,
) -> Stage:
    """Attach ``_known`` (id already exists) and ``_risk`` (data struct, null without data) and
    ``_risk_found`` in one join; halted rows have no key and are not looked up."""
    sides = []
    if existing_ids is not None:
        sides.append(existing_ids.select("company_id", F.lit(True).alias("_known")))
    if risk is not None:
        data = F.struct(*[c for c in risk.columns if c != "company_id"])
        sides.append(
            one_per_company(risk).select("company_id", F.lit(True).alias("_risk_found"), data.alias("_risk"))
        )

    def stage(contexts: DataFrame) -> DataFrame:
        keyed = contexts.withColumn("_lookup_id", F.when(running(), F.col("company_id")))
        if not sides:
            return keyed.drop("_lookup_id").withColumns(
                {"_known": F.lit(False), "_risk_found": F.lit(False)}
            )
        merged = sides[0]
        for side in sides[1:]:
            merged = merged.unionByName(side, allowMissingColumns=True)
        aggregates = [
            (F.first(c, ignorenulls=True) if c == "_risk" else F.bool_or(c)).alias(c)
            for c in merged.columns
            if c != "company_id"
        ]
        per_company = merged.groupBy(F.col("company_id").alias("_lookup_id")).agg(*aggregates)
        # The digits of a key take twice the bytes they stand for, and no codec of a shuffle finds that.
        if KEY in keyed.columns:
            keyed = keyed.withColumn(KEY, F.unhex(KEY))
        joined = keyed.join(per_company, "_lookup_id", "left").drop("_lookup_id")
        if KEY in keyed.columns:
            joined = joined.withColumn(KEY, F.lower(F.hex(KEY)))
        flags = {
            name: F.coalesce(F.col(name), F.lit(False)) if name in merged.columns else F.lit(False)
            for name in ("_known", "_risk_found")
        }
        return joined.withColumns(flags)

    return stage


def flag_known_companies(contexts: DataFrame) -> DataFrame:
    """A known id overrides the status and leaves a warning; the row goes on."""
    hit = running() & F.col("_known")
    warning = F.concat(
        F.lit("company_id="),
        quoted(F.col("company_id")),
        F.lit(" already exists — potential duplicate."),
    )
    return contexts.withColumns(
        {
            "status": F.when(hit, POTENTIAL_DUPLICATE).otherwise(F.col("status")),
            "warnings": add_text("warnings", warning, hit),
        }
    )


def attach_risk(contexts: DataFrame) -> DataFrame:
    """Risk data, or a failure mark and a warning; refused without a call on an open circuit."""
    refused = running() & F.col("circuit_open")
    found = running() & ~F.col("circuit_open") & F.col("_risk_found")
    missed = running() & ~F.col("circuit_open") & ~F.col("_risk_found")
    data_type = contexts.schema["enrichment"].dataType["data"].dataType
    data = F.col("_risk") if "_risk" in contexts.columns else F.lit(None).cast(data_type)

    def outcome(failed: bool, reason: str | None, value: Column) -> Column:
        return F.struct(
            F.lit(failed).alias("enrichment_failed"),
            F.lit(reason).cast("string").alias("reason"),
            value.cast(data_type).alias("data"),
        )

    nothing = F.lit(None).cast(data_type)
    skipped = F.lit(
        "Enrichment skipped: Risk API circuit breaker is OPEN. "
        "The API has been failing — enrichment will resume automatically."
    )
    unknown = F.concat(F.lit("No enrichment data found for "), quoted(F.col("company_id")))
    return contexts.withColumns(
        {
            "enrichment": F.when(refused, outcome(True, "circuit_open", nothing))
            .when(missed, outcome(True, None, nothing))
            .when(found, outcome(False, None, data))
            .otherwise(F.col("enrichment")),
            "warnings": F.when(refused, F.concat("warnings", F.array(skipped)))
            .when(missed, F.concat("warnings", F.array(unknown)))
            .otherwise(F.col("warnings")),
        }
    )


def default_stages(
    rules: Sequence[Rule] | None = None,
    existing_ids: DataFrame | None = None,
    risk: DataFrame | None = None,
) -> list[PipelineStage]:
    chosen = default_rules() if rules is None else rules
    return [
        PipelineStage("validation", validate),
        PipelineStage("triage", triage_with(chosen)),
        PipelineStage("lookup", company_lookup(existing_ids, risk)),
        PipelineStage("duplicates", flag_known_companies),
        PipelineStage("enrichment", attach_risk),
    ]


def insert_after(
    stages: Sequence[PipelineStage], after: str, stage: PipelineStage
) -> list[PipelineStage]:
    at = [s.name for s in stages].index(after) + 1
    return [*stages[:at], stage, *stages[at:]]


def enrichment_schema(risk: DataFrame | None) -> T.StructType:
    fields = [] if risk is None else [f for f in risk.schema.fields if f.name != "company_id"]
    data = T.StructType(fields or [T.StructField("none", T.StringType())])
    return T.StructType(
        [
            T.StructField("enrichment_failed", T.BooleanType()),
            T.StructField("reason", T.StringType()),
            T.StructField("data", data),
        ]
    )


def context_schema(risk: DataFrame | None) -> T.StructType:
    """Columns of the ledger: the key and the context."""
    types = {
        "enrichment": enrichment_schema(risk),
        "warnings": T.ArrayType(T.StringType()),
        "errors": T.ArrayType(T.StringType()),
    }
    return T.StructType(
        [T.StructField(c, types.get(c, T.StringType())) for c in (KEY, *CONTEXT_COLUMNS)]
    )


def chain_process(
    chain: Sequence[PipelineStage], enrichment_type: T.StructType, with_circuit: bool
) -> Callable[[DataFrame], DataFrame]:
    """The stages as a process function: first deliveries to contexts. ``with_circuit``: the
    deliveries tell whether they met an open circuit."""

    def process(firsts: DataFrame) -> DataFrame:
        contexts = new_contexts(firsts, enrichment_type)
        is_open = F.coalesce(F.col(CIRCUIT_OPEN), F.lit(False)) if with_circuit else F.lit(False)
        contexts = contexts.withColumn(CIRCUIT_OPEN, is_open)
        for stage in chain:
            contexts = stage.apply(contexts)
        return contexts.select(KEY, FIRST, *CONTEXT_COLUMNS)

    return process


def meet_circuit(
    deliveries: DataFrame,
    outcomes: DataFrame,
    dependency: Column,
    *,
    at: str = "received_at",
    seq: str = "seq",
    threshold: int = FAILURE_THRESHOLD,
    recovery_s: float = RECOVERY_SECONDS,
) -> DataFrame:
    """``deliveries`` with ``circuit_open``: whether the recorded outcomes of the delivery's ``dependency`` had
    opened its circuit at that time, as ``run_pipeline`` asks for it.

    Only the order column, the time and the dependency are put in one order with the intervals; the answers
    come back by ``seq``, which tells deliveries apart.
    """
    intervals = open_intervals(outcomes, threshold, recovery_s)
    asked = deliveries.select(F.col(seq), F.col(at), dependency.alias("_dependency"))
    marked = mark_circuit_open(asked, intervals, at, F.col("_dependency"))
    return deliveries.join(marked.select(seq, CIRCUIT_OPEN), seq)


def run_pipeline(
    deliveries: DataFrame,
    *,
    rules: Sequence[Rule] | None = None,
    existing_ids: DataFrame | None = None,
    risk: DataFrame | None = None,
    ledger: DataFrame | None = None,
    stages: Sequence[PipelineStage] | None = None,
    seq: str = "seq",
    payload: str = "payload",
) -> Processed:
    """Contexts of all deliveries, and the fresh ones to be stored in the ledger afterwards.

    ``deliveries`` has an order column and the payload text; an optional boolean column
    ``circuit_open`` says that the risk API was refused at that delivery. ``stages`` replaces the
    default chain. ``ledger`` holds idempotency_key and the context columns of earlier runs.
    """
    chain = stages or default_stages(rules, existing_ids, risk)
    carry = [CIRCUIT_OPEN] if CIRCUIT_OPEN in deliveries.columns else []
    named = deliveries.select(seq, F.col(payload).alias("payload"), *carry)
    return process_once(
        named,
        chain_process(chain, enrichment_schema(risk), bool(carry)),
        ledger,
        seq=seq,
        payload="payload",
        exclude=(),
        carry=carry,
    )
