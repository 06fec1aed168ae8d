"""Typed extraction from model responses, best attempt per text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.extraction import (
    extraction_status,
    missing_fields,
    render_prompt,
    with_extraction,
)

from quayside.session import shared_folder

DEFAULT_ATTEMPTS = 2


def extract(
    responses: DataFrame,
    max_attempts: int = DEFAULT_ATTEMPTS,
    key: str = "seq",
    attempt: str = "attempt",
    raw: str = "raw",
) -> DataFrame:
    """One row per text: the first usable attempt, else the last failure.

    A text has at most ``max_attempts`` usable rows, and the choice is an aggregate with a
    partial step, so nothing larger than one row per text and task is shuffled.
    """
    tried = F.col(attempt) <= max_attempts
    parsed = with_extraction(
        responses.select(key, attempt, F.when(tried, F.col(raw)).alias(raw)), raw
    )
    usable = tried & F.col("attempt_error").isNull()
    row = F.struct(attempt, "extracted", raw, "attempt_error")
    best = parsed.groupBy(key).agg(
        F.min(F.when(usable, row)).alias("_hit"), F.max(F.when(tried, row)).alias("_last")
    )
    chosen = F.coalesce("_hit", "_last")
    failure = F.concat(
        F.lit(f"All {max_attempts} extraction attempts failed. Last error: "),
        F.coalesce(F.col("_last.attempt_error"), F.lit("None")),
    )
    valid = F.col("_hit").isNotNull()
    missing = F.when(valid, missing_fields(F.col("_hit.extracted"))).otherwise(
        F.array().cast("array<string>")
    )
    return best.select(
        key,
        extraction_status(valid, missing).alias("status"),
        F.col("_hit.extracted").alias("extracted"),
        missing.alias("missing_fields"),
        chosen[raw].alias("raw_output"),
        F.when(~valid, failure).alias("error"),
        chosen[attempt].alias("attempt"),
    )


@dataclass(frozen=True)
class Recorded:
    """Answers of earlier calls, by key and attempt, in place of a function that makes the calls."""

    log: DataFrame


Completion = Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]] | Recorded


def complete_attempt(
    texts: DataFrame, complete: Completion, number: int, key: str = "seq", text: str = "text"
) -> DataFrame:
    """Run the user's batch completion over the prompts of one attempt.

    ``complete`` gets pandas batches with the key and ``prompt`` and returns the key and ``raw``; or it is a record
    of such answers (key, ``attempt``, ``raw``), in which a text without an answer stays without one.
    """
    if isinstance(complete, Recorded):
        answers = complete.log.filter(F.col("attempt") == number).select(key, "raw")
        return texts.select(key).join(answers, key).select(key, F.lit(number).alias("attempt"), "raw")
    prompts = texts.select(key, render_prompt(F.col(text), F.lit(number)).alias("prompt"))
    schema = f"{key} {texts.schema[key].dataType.simpleString()}, raw string"
    return prompts.mapInPandas(complete, schema).select(
        key, F.lit(number).alias("attempt"), "raw"
    )


def extract_texts(
    texts: DataFrame,
    complete: Completion,
    max_attempts: int = DEFAULT_ATTEMPTS,
    key: str = "seq",
    text: str = "text",
) -> DataFrame:
    """Ask the model attempt by attempt; later attempts only see texts still without a result.

    The responses of an attempt are checkpointed: a model call is dear, and asking again could
    give another answer. A text that gets no answer at all is a failure like any other.
    """
    shared_folder(texts.sparkSession)
    # An attempt behind the last one counts for nothing, but every text has a row by it.
    beyond = texts.select(key, F.lit(max_attempts + 1).alias("attempt"), F.lit(None).cast("string").alias("raw"))
    waiting, answered = texts.select(key, text), [beyond]
    for number in range(1, max_attempts + 1):
        responses = complete_attempt(waiting, complete, number, key, text).checkpoint()
        answered.append(responses)
        done = with_extraction(responses).filter(F.col("attempt_error").isNull()).select(key)
        waiting = waiting.join(done, key, "left_anti")
    return extract(reduce(DataFrame.unionByName, answered), max_attempts, key)
