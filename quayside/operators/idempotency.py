"""Process every distinct payload once and hand its result to all of its deliveries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.payload import DELIVERY_FIELDS, with_content_key
from quayside.functions.rows import last_row
from quayside.session import is_storable, stored

KEY = "idempotency_key"
FIRST = "first_seq"
STORED = "_stored"

Process = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Processed:
    """``records``: one row per delivery. ``fresh``: one row per newly processed key, to store."""

    records: DataFrame
    fresh: DataFrame


def with_key(
    deliveries: DataFrame, payload: str = "payload", exclude: Iterable[str] = DELIVERY_FIELDS
) -> DataFrame:
    return with_content_key(deliveries, payload, KEY, exclude)


def first_deliveries(keyed: DataFrame, seq: str = "seq", carry: Sequence[str] = ()) -> DataFrame:
    """First delivery of every key with the carried columns.

    A plain aggregate: each task sends on at most one row per key, so a key that holds most of
    the deliveries costs no more than any other.
    """
    if not carry:
        return keyed.groupBy(KEY).agg(F.min(seq).alias(FIRST))
    row = F.min_by(F.struct(*carry), F.col(seq)).alias("_row")
    return keyed.groupBy(KEY).agg(F.min(seq).alias(FIRST), row).select(KEY, FIRST, "_row.*")


def seen_keys(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Incoming keys the ledger already holds."""
    return incoming.join(ledger.select(KEY), KEY, "left_semi")


def unseen_keys(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Incoming keys the ledger does not hold (what put-if-absent would store)."""
    return incoming.join(ledger.select(KEY), KEY, "left_anti")


def _digits(key: str) -> Column:
    return F.lower(F.hex(key))


def process_once(
    deliveries: DataFrame,
    process: Process,
    ledger: DataFrame | None = None,
    *,
    seq: str = "seq",
    payload: str = "payload",
    exclude: Iterable[str] = DELIVERY_FIELDS,
    carry: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> Processed:
    """Run ``process`` on the first delivery of every unseen key; later ones are replays.

    ``process`` gets the columns idempotency_key, first_seq, the payload and ``carry`` and must
    keep the first two; a row it leaves out is not stored and its deliveries get no result, so
    the next run tries again. ``ledger`` holds idempotency_key and the result columns of earlier
    runs. ``keep`` names delivery columns wanted in the records.

    The keys, most of the work, are computed at once and stored; both the first deliveries and the records read them.
    They are stored and shuffled as the 32 bytes their 64 digits stand for, which no codec would find.
    """
    needed = dict.fromkeys([seq, KEY, payload, *carry, *keep])
    keyed = stored(with_key(deliveries, payload, exclude).select(*needed).withColumn(KEY, F.unhex(KEY)), "keyed")
    if ledger is None:
        todo = first_deliveries(keyed, seq, [payload, *carry]).withColumn(KEY, _digits(KEY))
    else:
        # Grouped by the text, as the ledger holds it, the first deliveries lie where they are looked up.
        firsts = first_deliveries(keyed.withColumn(KEY, _digits(KEY)), seq, [payload, *carry])
        todo = unseen_keys(firsts, ledger)
    done = process(todo)
    results = done.withColumn(STORED, F.lit(False))
    if ledger is not None:
        # Of the ledger only what this run asks for, one row per key.
        asked = seen_rows(firsts, ledger.select(*done.drop(FIRST).columns))
        known = asked.withColumn(FIRST, F.lit(None).cast(done.schema[FIRST].dataType))
        results = results.unionByName(known.withColumn(STORED, F.lit(True)))
    if is_storable(results.schema):
        # The shuffles that lead to the results are gone before those of the records begin.
        results = stored(results, "results")
    fresh = results.filter(~F.col(STORED)).select(*done.drop(FIRST).columns)
    records = keyed.select(seq, KEY, *keep).join(results.withColumn(KEY, F.unhex(KEY)), KEY, "left").withColumn(KEY, _digits(KEY))
    # A delivery replays a result when it is not the one that produced it, whatever the result holds.
    replay = F.coalesce(F.col(STORED) | (F.col(seq) != F.col(FIRST)), F.lit(False))
    return Processed(records.withColumn("was_replay", replay).drop(FIRST, STORED), fresh)


def seen_rows(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows of incoming keys, one per key: the last by its columns in turn."""
    asked = ledger.join(incoming.select(KEY), KEY, "left_semi")
    rest = [c for c in ledger.columns if c != KEY]
    if not rest:
        return asked.distinct()
    last = asked.groupBy(KEY).agg(last_row(rest, ledger.schema).alias("_last"))
    return last.select(*[F.col(c) if c == KEY else F.col(f"_last.`{c}`").alias(c) for c in ledger.columns])


def mark_replays(
    deliveries: DataFrame,
    ledger: DataFrame | None = None,
    *,
    seq: str = "seq",
    payload: str = "payload",
    exclude: Iterable[str] = DELIVERY_FIELDS,
) -> DataFrame:
    """Deliveries with their key and ``was_replay`` only; nothing is processed."""
    keyed = stored(with_key(deliveries, payload, exclude).drop(payload), "keyed")
    firsts = first_deliveries(keyed, seq)
    if ledger is not None:
        known = ledger.select(KEY).distinct().withColumn("_seen", F.lit(True))
        firsts = firsts.join(known, KEY, "left")
    else:
        firsts = firsts.withColumn("_seen", F.lit(False))
    marked = keyed.join(firsts, KEY)
    replay = F.coalesce(F.col("_seen"), F.lit(False)) | (F.col(seq) != F.col(FIRST))
    return marked.withColumn("was_replay", replay).drop("_seen", FIRST)
