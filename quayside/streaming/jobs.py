"""Streaming forms of the operators.

Stateless ones (triage, enrichment) are the batch code on a streaming DataFrame. Processing each key once keeps
claims and results as keyed state (``once``). The breaker runs the batch operator on every micro-batch
and keeps the last failure run of dependencies in a bucketed table. A batch that runs again replaces its own output.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.functions.payload import DELIVERY_FIELDS
from quayside.operators.breaker import (
    FAILURE_THRESHOLD,
    RECOVERY_SECONDS,
    circuit_states,
    last_runs,
)
from quayside.operators.enrichment import enrich
from quayside.operators.idempotency import FIRST, KEY, Process, seen_rows, with_key
from quayside.operators.rules import Rule
from quayside.operators.triage import triage
from quayside.plans.intake import CIRCUIT_OPEN, chain_process, default_stages, enrichment_schema
from quayside.session import shuffles_removed
from quayside.sources.ledger import compact_ledger, drop_batch, open_ledger, store_batch
from quayside.sources.tables import make_folder, read_stream, remove_folder
from quayside.streaming.once import (
    ASKED,
    FRESH,
    IS_KEY,
    MORE,
    RESULT,
    SEQS,
    STATE_BUCKETS,
    Lifetime,
    once_per_key,
    one_per_key,
    rocksdb_state,
)

KEY_LIFETIME = "24 hours"
BATCH = "batch"
# Batches of outcomes after which the states of dependencies are merged.
MERGE_EVERY = 50
_BATCH_NUMBER = "batch_number"


def triage_stream(
    submissions: DataFrame,
    rules: Sequence[Rule] | None = None,
    payload: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Valid rows with their decision as they arrive."""
    return triage(submissions, rules, payload, keep)


def enrich_stream(submissions: DataFrame, risk: DataFrame, key: str = "company_id") -> DataFrame:
    """Stream-static left join; results come in no particular order."""
    return enrich(submissions, risk, key)


def dedupe_stream(
    deliveries: DataFrame,
    event_time: str = "received_at",
    lifetime: str = KEY_LIFETIME,
    payload: str = "payload",
    exclude: Iterable[str] = DELIVERY_FIELDS,
) -> DataFrame:
    """First arrival of every key; a key is forgotten after its lifetime in event time.

    Every Arrow batch sends on one row per key, the earliest, so the state's tasks get a small part of a key that
    floods the stream. Rows without an event time are kept apart by nothing else than their key.
    """
    timed = deliveries.withColumn(event_time, F.col(event_time).cast("timestamp"))
    reduced = one_per_key(with_key(timed, payload, exclude), [KEY], event_time)
    return reduced.withWatermark(event_time, lifetime).dropDuplicatesWithinWatermark([KEY])


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    with shuffles_removed(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", "zstd").parquet(_batch_folder(path, batch_id))


def _process_batches(
    deliveries: DataFrame,
    process: Process,
    result_schema: T.StructType,
    ledger_path: str,
    records_path: str,
    checkpoint: str,
    lifetime: Lifetime,
    *,
    seq: str,
    payload: str = "payload",
    exclude: Iterable[str] = (),
    carry: Sequence[str] = (),
    given: Sequence[str] = (),
    state_tasks: int | None = None,
    state_buckets: int = STATE_BUCKETS,
) -> StreamingQuery:
    spark = deliveries.sparkSession
    results = [f.name for f in result_schema.fields if f.name != KEY]
    # Keys whose claim led to no result: written per batch, read by the stream itself.
    ended_path = f"{ledger_path.rstrip('/')}_ended"
    make_folder(spark, ended_path)
    ended = T.StructType([T.StructField(KEY, T.StringType()), deliveries.schema[seq]])
    released = read_stream(spark, ended_path, ended)
    rows = once_per_key(
        deliveries, process, result_schema, released, lifetime, seq=seq, payload=payload, exclude=exclude, carry=carry, given=given,
        buckets=state_buckets,
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Written once: a second look at the batch would run the state operators a second time.
        staged_path = f"{records_path.rstrip('/')}_staged"
        _write_batch(batch, staged_path, batch_id)
        staged = batch.sparkSession.read.schema(batch.schema).parquet(_batch_folder(staged_path, batch_id))
        keys = staged.filter(IS_KEY).select(KEY, FIRST, FRESH, RESULT, ASKED, MORE)
        has_result = F.col(RESULT).isNotNull()
        _write_batch(keys.filter(F.col(FRESH) & has_result).select(KEY, f"{RESULT}.*"), ledger_path, batch_id)
        _write_batch(keys.filter(~has_result).select(KEY, F.col(FIRST).alias(seq)), ended_path, batch_id)
        replay = has_result & (~F.col(FRESH) | (F.col(seq) != F.col(FIRST)))
        packed = F.unhex(KEY).alias(KEY)
        keys = keys.withColumn(KEY, packed)
        listed = staged.filter(~F.col(IS_KEY)).select(packed, F.coalesce(SEQS, F.array(seq)).alias(SEQS))
        every = F.explode(SEQS).alias(seq)
        if lifetime.by_events:
            # What is too late has no answer.
            records = listed.join(keys, KEY, "left").select(KEY, every, FIRST, FRESH, RESULT)
        else:
            # A key's only delivery in the batch has its answer already.
            several = listed.join(keys.filter(MORE), KEY).select(KEY, every, FIRST, FRESH, RESULT)
            records = keys.filter(~F.col(MORE)).select(KEY, F.col(ASKED).alias(seq), FIRST, FRESH, RESULT).unionByName(several)
        records = records.withColumn(KEY, F.lower(F.hex(KEY)))
        found = [F.col(f"{RESULT}.`{c}`").alias(c) for c in results]
        _write_batch(
            records.select(KEY, seq, *found, F.coalesce(replay, F.lit(False)).alias("was_replay")), records_path, batch_id
        )
        remove_folder(batch.sparkSession, _batch_folder(staged_path, batch_id))

    with rocksdb_state(spark, empty_batches=lifetime.mode != "ProcessingTime", tasks=state_tasks):
        return (
            rows.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def idempotent_stream(
    deliveries: DataFrame,
    process: Process,
    result_schema: T.StructType,
    ledger_path: str,
    records_path: str,
    checkpoint: str,
    lifetime_s: float | None = None,
    seq: str = "seq",
    exclude: Iterable[str] = DELIVERY_FIELDS,
    event_time: str | None = None,
    state_tasks: int | None = None,
    state_buckets: int = STATE_BUCKETS,
) -> StreamingQuery:
    """Every delivery with the result of its key and ``was_replay``; each key processed once.

    ``result_schema`` is that of the ledger: idempotency_key and the result columns. Results are kept as
    state of the stream; the ledger is an output, which no batch reads. ``process`` runs on the stream, see
    ``once_per_key``; a row it leaves out gives its deliveries no result, and a delivery of the key in a
    later run is a first one again.

    With ``lifetime_s`` a key is forgotten that long after its first delivery, and then processed anew: by the
    clock, or with ``event_time`` by that column. Of the deliveries of a key in one batch the one of smallest
    ``seq`` tells the time. ``state_tasks`` is the number of parts of the state, see ``rocksdb_state``, and ``state_buckets``
    that of the values in it, see ``once``. By event time a delivery more than a lifetime behind the newest has a record without a
    result, and one without a time ends no claim.
    """
    return _process_batches(
        deliveries, process, result_schema, ledger_path, records_path, checkpoint, Lifetime(lifetime_s, event_time),
        seq=seq, exclude=tuple(exclude), state_tasks=state_tasks, state_buckets=state_buckets,
    )


def intake_stream(
    deliveries: DataFrame,
    result_schema: T.StructType,
    ledger_path: str,
    records_path: str,
    checkpoint: str,
    rules: Sequence[Rule] | None = None,
    existing_ids: DataFrame | None = None,
    risk: DataFrame | None = None,
    lifetime_s: float | None = None,
    seq: str = "seq",
    event_time: str | None = None,
    state_tasks: int | None = None,
    state_buckets: int = STATE_BUCKETS,
) -> StreamingQuery:
    """The whole chain on the stream, as process function of ``idempotent_stream``."""
    carry = [CIRCUIT_OPEN] if CIRCUIT_OPEN in deliveries.columns else []
    process = chain_process(default_stages(rules, existing_ids, risk), enrichment_schema(risk), bool(carry))
    return _process_batches(
        deliveries, process, result_schema, ledger_path, records_path, checkpoint, Lifetime(lifetime_s, event_time),
        seq=seq, carry=carry, given=["payload"], state_tasks=state_tasks, state_buckets=state_buckets,
    )


def circuit_state_stream(
    outcomes: DataFrame,
    state_path: str,
    states_path: str,
    checkpoint: str,
    threshold: int = FAILURE_THRESHOLD,
    recovery_s: float = RECOVERY_SECONDS,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Circuit states of a stream of outcomes; every batch starts where the ones before ended.

    How a dependency's log ended is stored by the batches that had outcomes of it, bucketed by dependency, and looked up
    for the dependencies of a batch only. Every ``merge_every`` batches these are merged, and dependencies whose
    last outcome was a success, of which nothing needs to be known, go.
    """
    schema = T.StructType(
        [
            T.StructField(KEY, T.StringType()),
            T.StructField(_BATCH_NUMBER, T.LongType()),
            T.StructField("failure_run", T.LongType()),
            outcomes.schema["ts"],
            outcomes.schema["dependency"],
        ]
    )
    # A null dependency is one of its own, and has a key.
    key = F.to_json(F.struct("dependency")).alias(KEY)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # What an earlier attempt of this batch left must neither be read nor merged.
        drop_batch(spark, state_path, batch_id)
        if batch_id % merge_every == merge_every - 1:
            compact_ledger(spark, state_path, schema, keep=F.col("failure_run") > 0)
        stored = open_ledger(spark, state_path, schema)
        carried = seen_rows(batch.select(key).distinct(), stored).select("dependency", "failure_run", "ts")
        states = circuit_states(batch, threshold, recovery_s, carried)
        _write_batch(states, states_path, batch_id)
        stored_states = spark.read.schema(states.schema).parquet(_batch_folder(states_path, batch_id))
        ends = last_runs(stored_states).select(key, F.lit(batch_id).cast("long").alias(_BATCH_NUMBER), "failure_run", "ts", "dependency")
        store_batch(ends, state_path, batch_id)

    return (
        outcomes.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stateless stream to Parquet files, exactly once."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
