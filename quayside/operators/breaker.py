"""Circuit breaker states from a log of call outcomes, one circuit per dependency.

Every row of the log is a recorded outcome. After a success the circuit is closed; after a
failure it is open when that failure is at least the N-th in a row since the last success, and
the recovery timer starts at that failure. So the state is known from two things: the length of
the failure run ending at a row, and how long ago the previous row was.

A busy dependency may hold a third of the log, so neither is computed over a whole dependency at
once: both look at the rows before, see ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.ordered import before_each

FAILURE_THRESHOLD = 5
RECOVERY_SECONDS = 30.0

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def failure_runs(
    outcomes: DataFrame,
    carried: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``failure_run``: failures in a row up to and including the row, 0 after a success.

    ``outcomes`` has dependency, seq, ts and ok; ``seq`` breaks ties of equal times. No row is lost: a null
    dependency is one of its own, and rows with a null time come first. The added
    ``previous_ts`` and ``previous_run`` describe the row before. ``carried`` (dependency,
    failure_run, ts) tells how an earlier part of the log ended, see ``last_runs``. ``ranges`` is the number of
    parts the log is cut into, see ``before_each``.
    """
    rows = outcomes.select("dependency", "seq", "ts", "ok", F.lit(1).alias("_failures"), F.lit(True).alias("_here"))
    if carried is not None:
        # Stands in front of the log, with all its failures in one row.
        earlier = carried.select("dependency", "ts", F.col("failure_run").alias("_failures"), F.lit(False).alias("_here"))
        rows = rows.withColumn("_failures", F.col("_failures").cast("long")).unionByName(earlier, allowMissingColumns=True)
    found = before_each(
        rows,
        F.col("dependency"),
        [F.col("_here"), F.col("ts"), F.col("seq")],
        since={"previous_run": (F.col("_failures"), F.col("ok"))},
        last={"previous_ts": F.col("ts")},
        ranges=ranges,
    ).filter("_here")
    run = F.when(F.col("ok"), F.lit(0).cast("bigint")).otherwise(F.col("previous_run") + 1)
    return found.select("dependency", "seq", "ts", "ok", run.alias("failure_run"), "previous_ts", "previous_run")


def state_at(run: Column, since: Column, now: Column, threshold: int, recovery_s: float) -> Column:
    """State seen at time ``now`` when the last outcome, at ``since``, ended a failure run."""
    waited = _seconds(now) - _seconds(since)
    return (
        F.when(F.coalesce(run, F.lit(0)) < threshold, CLOSED)
        .when(waited >= recovery_s, HALF_OPEN)
        .otherwise(OPEN)
    )


def circuit_states(
    outcomes: DataFrame,
    threshold: int = FAILURE_THRESHOLD,
    recovery_s: float = RECOVERY_SECONDS,
    carried: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """State in front of and after every outcome, and whether a request was admitted then."""
    runs = failure_runs(outcomes, carried, ranges)
    before = state_at(
        F.col("previous_run"), F.col("previous_ts"), F.col("ts"), threshold, recovery_s
    )
    after = F.when(F.col("failure_run") >= threshold, OPEN).otherwise(CLOSED)
    return runs.select(
        "dependency",
        "seq",
        "ts",
        "ok",
        "failure_run",
        before.alias("state_before"),
        (before != OPEN).alias("allowed"),
        after.alias("state_after"),
        F.when(after == OPEN, F.col("ts")).alias("opened_at"),
    )


def last_runs(states: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """How the log ended per dependency; dependencies without new rows keep what they had."""
    ends = states.groupBy("dependency").agg(
        F.max(F.struct("ts", "seq", "failure_run")).alias("_end")
    ).select("dependency", F.col("_end.failure_run").alias("failure_run"), F.col("_end.ts").alias("ts"))
    if carried is None:
        return ends
    gone_on = ends.select(F.col("dependency").alias("_of"))
    return ends.unionByName(carried.join(gone_on, F.col("dependency").eqNullSafe(F.col("_of")), "left_anti"))


def open_intervals(
    outcomes: DataFrame,
    threshold: int = FAILURE_THRESHOLD,
    recovery_s: float = RECOVERY_SECONDS,
    ranges: int | None = None,
) -> DataFrame:
    """Times at which requests are refused: from an opening to the next outcome, at most for the
    recovery time. The intervals of a dependency do not overlap."""
    runs = failure_runs(outcomes, ranges=ranges)
    wait = F.make_dt_interval(secs=F.lit(recovery_s))
    between = runs.filter(F.col("previous_run") >= threshold).select(
        "dependency",
        F.col("previous_ts").alias("open_from"),
        F.least(F.col("previous_ts") + wait, F.col("ts")).alias("open_until"),
    )
    at_the_end = (
        last_runs(runs)
        .filter(F.col("failure_run") >= threshold)
        .select("dependency", F.col("ts").alias("open_from"), (F.col("ts") + wait).alias("open_until"))
    )
    return between.unionByName(at_the_end)


def mark_circuit_open(
    rows: DataFrame, intervals: DataFrame, at: str, dependency: Column, ranges: int | None = None
) -> DataFrame:
    """Add ``circuit_open``: whether the row's time lies in an interval of the row's ``dependency``
    (a column, or a literal for a call that always goes to the same one).

    The intervals of a dependency do not overlap, so only the last one to begin at or before a row can hold it. Rows
    and intervals are put in one order and cut into ranges by their number, see ``before_each``: a dependency or
    an instant that has most of them is spread like any other. A row without a time meets no interval.
    """
    asked = rows.select(
        F.struct(*[F.col(c) for c in rows.columns]).alias("_asked"), dependency.alias("_of"), F.col(at).cast("timestamp").alias("_at"),
        F.lit(None).cast("timestamp").alias("_until"), F.lit(1).alias("_kind"),
    )
    begun = intervals.filter(F.col("open_from").isNotNull()).select(
        F.col("dependency").cast(asked.schema["_of"].dataType).alias("_of"), F.col("open_from").cast("timestamp").alias("_at"),
        F.col("open_until").cast("timestamp").alias("_until"), F.lit(0).alias("_kind"),
    )
    both = asked.unionByName(begun, allowMissingColumns=True)
    # An interval that begins at a row's time comes before it.
    found = before_each(both, F.col("_of"), [F.col("_at"), F.col("_kind")], last={"_last_until": F.col("_until")}, ranges=ranges)
    is_open = F.coalesce(F.col("_at") < F.col("_last_until"), F.lit(False))
    return found.filter("_kind = 1").select(
        *[F.col(f"_asked.`{c}`").alias(c) for c in rows.columns], is_open.alias("circuit_open")
    )
