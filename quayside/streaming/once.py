"""Process-once as keyed state of a stream.

Two state operators stand in one streaming plan, with the caller's function between them. The first one holds
a claim per key: it lets through the first delivery of a key that has no claim. What the function makes of it goes
to the second one, which holds the result per key and hands it to every delivery's key. State lies in a
RocksDB state store, in small buckets of keys, so a batch reads and writes the buckets of its own keys only.
Python and the store talk in single calls, some for each value of state; a value that holds a bucket makes them a
few per bucket and batch instead of some per key.

The keys of a batch, most of the work, are computed once; one shuffle, by the buckets of the state, hands them to all
that read them. Deliveries are reduced to one row per key and Arrow batch before it, which lists the others, so that a
key that floods a batch costs a state task one row per Arrow batch of it. Keys are shuffled as the 32 bytes their digits stand for.

A claim that leads to no result has to end, or the key would never be tried again. Which ones do is known when a
batch is written; they are stored as files the first operator reads as a second input, from the next run on at
the latest.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from quayside.functions.payload import DELIVERY_FIELDS
from quayside.operators.idempotency import FIRST, KEY, Process, with_key
from quayside.session import REMOVE_SHUFFLES

RESULT, FRESH, AT, RELEASED, IS_KEY = "_result", "_fresh", "_at", "_released", "_is_key"
# The deliveries of a key in an Arrow batch; the earliest one in the whole batch, and whether there are more.
SEQS, ASKED, MORE = "_seqs", "_asked", "_more"
# The event time in milliseconds, as the state holds it and timers count.
MILLIS = "_millis"
BUCKET = "_bucket"
# Buckets the keys are hashed to. A stream keeps the number for life: with many deliveries in a batch fewer are faster,
# with few deliveries and many millions of keys more are, because a bucket is read and written whole.
STATE_BUCKETS = 1 << 16
# Event time of rows that are never late.
_NEVER_LATE = datetime(9999, 1, 1)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def rocksdb_state(spark: SparkSession, empty_batches: bool = True, tasks: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, and per batch write the files of its changes only: a log of the
    changes beside them would be a third copy of what is new.

    Operators that go by the clock ask for one more batch for ever; without ``empty_batches`` a stream that has
    read all its input ends. ``tasks`` is the number of parts of the state, which a stream keeps for life; that of the
    session's shuffle partitions if not given. The shuffles of a batch are removed at its end."""
    settings = {_PROVIDER: _ROCKSDB, _CHANGELOG: "false", _EMPTY_BATCHES: str(empty_batches).lower(), REMOVE_SHUFFLES: "true"}
    if tasks:
        settings["spark.sql.shuffle.partitions"] = str(tasks)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@dataclass(frozen=True)
class Lifetime:
    """How long a key is remembered: for ever without ``seconds``; by the clock, or, with ``event_time``,
    by the times of the deliveries themselves."""

    seconds: float | None = None
    event_time: str | None = None

    @property
    def by_events(self) -> bool:
        return self.seconds is not None and self.event_time is not None

    @property
    def milliseconds(self) -> int | None:
        return None if self.seconds is None else max(1, int(self.seconds * 1000))

    @property
    def mode(self) -> str:
        if self.seconds is None:
            return "None"
        return "EventTime" if self.by_events else "ProcessingTime"

    def watched(self, rows: DataFrame) -> DataFrame:
        """A delivery later than a lifetime behind the newest one is too late to be looked at."""
        return rows.withWatermark(AT, f"{self.milliseconds} milliseconds") if self.by_events else rows


# What has no event time is never over.
_NO_END = 1 << 62


class _Remembering(StatefulProcessor):
    """One row of state per bucket: what is known of each of its keys, which ends with the lifetime of the key."""

    def __init__(self, lifetime: Lifetime, spare_ms: int = 0):
        self.lifetime, self.spare_ms = lifetime, spare_ms
        self.by_clock = lifetime.mode == "ProcessingTime"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The whole bucket goes a lifetime after its last change; its keys end one by one, see ``remembered``.
        ttl = self.lifetime.milliseconds + self.spare_ms if self.by_clock else None
        self.state = handle.getValueState("bucket", T.StructType([T.StructField("rows", T.BinaryType())]), ttl)

    def end_of(self, at: int | None) -> int:
        return _NO_END if at is None else at + self.lifetime.milliseconds

    def is_over(self, held: tuple, at: int | None) -> bool:
        return self.lifetime.by_events and at is not None and at >= self.end_of(held[1])

    def time_of(self, row: Row, times: TimerValues) -> int | None:
        return times.getCurrentProcessingTimeInMs() if self.by_clock else row[MILLIS]

    def remembered(self, times: TimerValues) -> dict[str, tuple]:
        """Of each key (first, time, ...); ``alarm`` is the earliest time a timer is set for, if any."""
        found = self.state.get()
        self.alarm, rows = unpacked(bytes(found[0])) if found is not None else (None, {})
        if self.by_clock:
            now = times.getCurrentProcessingTimeInMs() - self.spare_ms
            rows = {key: held for key, held in rows.items() if now < self.end_of(held[1])}
        return rows

    def remember(self, rows: dict[str, tuple]) -> None:
        if not rows:
            self.state.clear()
            return
        if self.lifetime.by_events:
            end = min(self.end_of(held[1]) for held in rows.values())
            if end < (_NO_END if self.alarm is None else self.alarm):
                self.handle.registerTimer(end)
                self.alarm = end
        self.state.update((packed((self.alarm, rows)),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        rows = self.remembered(timerValues)
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self.alarm = None
        if rows:
            self.remember({k: held for k, held in rows.items() if self.end_of(held[1]) > now})
        return iter(())

    def close(self) -> None:
        pass


def packed(held: tuple) -> bytes:
    """What is held of a bucket, compressed behind its length in eight bytes."""
    plain = pickle.dumps(held, protocol=5)
    return len(plain).to_bytes(8, "big") + pa.compress(plain, codec="zstd", asbytes=True)


def unpacked(value: bytes) -> tuple:
    # A pickle begins with 0x80, as values stored before they were compressed do.
    if value[:1] != b"\x80":
        value = pa.decompress(value[8:], decompressed_size=int.from_bytes(value[:8], "big"), codec="zstd", asbytes=True)
    return pickle.loads(value)


class Claims(_Remembering):
    """Lets the first delivery of a key in a batch through if the key has no claim, or one that is over."""

    def __init__(self, seq: str, columns: Sequence[str], lifetime: Lifetime):
        super().__init__(lifetime)
        self.seq, self.columns = seq, tuple(columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        firsts: dict[str, Row] = {}
        released: dict[str, set] = {}
        for row in rows:
            name = row[KEY]
            if row[RELEASED]:
                released.setdefault(name, set()).add(row[self.seq])
            elif name not in firsts or row[self.seq] < firsts[name][self.seq]:
                firsts[name] = row
        held = self.remembered(timerValues)
        ended = [name for name, seqs in released.items() if name in held and held[name][0] in seqs]
        for name in ended:
            del held[name]
        new = [
            (name, first) for name, first in firsts.items()
            if name not in held or self.is_over(held[name], first[MILLIS])
        ]
        held.update((name, (first[self.seq], self.time_of(first, timerValues))) for name, first in new)
        if ended or new:
            self.remember(held)
        for name, first in new:
            yield Row(**{KEY: name, FIRST: first[self.seq], **{c: first[c] for c in self.columns}})


class Results(_Remembering):
    """Hands every key of a batch its result: that of this batch, which it remembers, or the one it has."""

    def __init__(self, seq: str, lifetime: Lifetime, given: Sequence[tuple[int, str]] = ()):
        # By the clock it has to outlive the claim, whose task may look at it earlier.
        super().__init__(lifetime, spare_ms=3_600_000)
        self.seq, self.given = seq, tuple(given)

    def result_of(self, row: Row, first: Row):
        """As stored, with the values that come from the first delivery itself."""
        result = _plain(row[RESULT])
        if isinstance(result, dict):
            return result | {name: first[name] for _, name in self.given}
        given = {place: first[name] for place, name in self.given}
        return tuple(given.get(place, value) for place, value in enumerate(result))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new: dict[str, Row] = {}
        asked: dict[str, Row] = {}
        several: set[str] = set()
        for row in rows:
            name = row[KEY]
            if row[RESULT] is not None:
                new[name] = row
                continue
            if name in asked or row[SEQS] is not None:
                several.add(name)
            if name not in asked or row[self.seq] < asked[name][self.seq]:
                asked[name] = row
        held = self.remembered(timerValues)
        held.update(
            (name, (row[self.seq], self.time_of(asked[name], timerValues), self.result_of(row, asked[name]))) for name, row in new.items()
        )
        if new:
            self.remember(held)
        for name, row in asked.items():
            known = held.get(name)
            of_batch = {KEY: name, ASKED: row[self.seq], MORE: name in several}
            if name in new or known is not None and not self.is_over(known, row[MILLIS]):
                yield Row(**of_batch, **{FIRST: known[0], FRESH: name in new, RESULT: known[2]})
            else:
                yield Row(**of_batch, **{FIRST: row[self.seq], FRESH: False, RESULT: None})


def _plain(value):
    """Rows as tuples, which are stored and read in a fraction of the time."""
    if isinstance(value, tuple):
        return tuple(map(_plain, value))
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def one_per_key(rows: DataFrame, keys: Sequence[str], order: str, listed: str | None = None) -> DataFrame:
    """Of every Arrow batch the row of smallest ``order`` per key: a partial step without a shuffle. ``listed``
    names a column for the ``order`` of all its rows, null if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table.sort_by([(k, "ascending") for k in (*keys, order)])
            new = np.zeros(table.num_rows, bool)
            new[0] = True
            for key in keys:
                values = table[key].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= values[1:] != values[:-1]
            kept = table.filter(pa.array(new))
            if listed:
                begins = np.append(np.flatnonzero(new), table.num_rows).astype(np.int32)
                every = pa.ListArray.from_arrays(begins, table[order].combine_chunks())
                kept = kept.append_column(listed, pc.if_else(pa.array(np.diff(begins) > 1), every, pa.scalar(None, every.type)))
            yield from kept.combine_chunks().to_batches()

    # Nullable throughout: a state's schema must not depend on which inputs of a batch are empty.
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
    if listed:
        fields.append(T.StructField(listed, T.ArrayType(rows.schema[order].dataType)))
    return rows.mapInArrow(run, T.StructType(fields))


def _only(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Some columns of a shuffle that others read whole: a plain selection would be made before it, in a shuffle of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(list(columns))

    return rows.mapInArrow(run, T.StructType([T.StructField(c, rows.schema[c].dataType) for c in columns]))


def dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows shuffled by the bucket of their key. A union of such needs no other shuffle before its state."""
    bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
    return rows.withColumn(BUCKET, bucket).withColumn(KEY, F.unhex(KEY)).repartition(BUCKET).withColumn(KEY, F.lower(F.hex(KEY)))


def once_per_key(
    deliveries: DataFrame,
    process: Process,
    result_schema: T.StructType,
    released: DataFrame | None,
    lifetime: Lifetime,
    *,
    seq: str = "seq",
    payload: str = "payload",
    exclude: Iterable[str] = DELIVERY_FIELDS,
    carry: Sequence[str] = (),
    given: Sequence[str] = (),
    buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """Rows of a batch in one stream: its deliveries (key and ``seq``, or a list of them), and, marked by ``_is_key``, one row
    per key with its first delivery, whether its result is of this batch, the result, its earliest delivery in the batch, and whether
    that has more of them.

    ``process`` is as for ``process_once`` and runs on the stream, so it may hold no aggregates; lookups in
    tables are joins of a stream with a static table. ``given`` names columns of the result that are those of the first
    delivery as it came: they are not sent through ``process`` and back. ``released`` has keys whose claim ended
    without a result.
    """
    keyed = with_key(deliveries, payload, exclude)
    at = F.col(lifetime.event_time).cast("timestamp") if lifetime.by_events else F.lit(None).cast("timestamp")
    columns = [payload, *carry]
    narrow = keyed.select(KEY, seq, at.alias(AT), F.unix_millis(at).alias(MILLIS), *columns)
    seq_type = narrow.schema[seq].dataType
    # Both states and the deliveries themselves take all its columns: else it would be made once for each.
    asked = dealt(one_per_key(narrow, [KEY], seq, SEQS), buckets)
    claiming = lifetime.watched(asked).withColumn(RELEASED, F.lit(False))
    if released is not None:
        ended = released.select(KEY, seq, F.lit(_NEVER_LATE).alias(AT), F.lit(True).alias(RELEASED))
        claiming = claiming.unionByName(dealt(ended, buckets), allowMissingColumns=True)
    kept = [narrow.schema[c] for c in columns]
    first_schema = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(FIRST, seq_type), *kept])
    firsts = claiming.groupBy(BUCKET).transformWithState(
        Claims(seq, columns, lifetime), first_schema, "Append", lifetime.mode
    )
    result = T.StructType([f for f in result_schema.fields if f.name != KEY])
    results = [(F.lit(None) if f.name in given else F.col(f.name)).cast(f.dataType).alias(f.name) for f in result.fields]
    places = [(place, f.name) for place, f in enumerate(result.fields) if f.name in given]
    done = process(firsts).select(KEY, F.col(FIRST).alias(seq), F.lit(_NEVER_LATE).alias(AT), F.struct(*results).alias(RESULT))
    wanted = lifetime.watched(asked).withColumn(RESULT, F.lit(None).cast(result))
    key_schema = T.StructType(
        [
            T.StructField(KEY, T.StringType()), T.StructField(FIRST, seq_type),
            T.StructField(FRESH, T.BooleanType()), T.StructField(RESULT, result),
            T.StructField(ASKED, seq_type), T.StructField(MORE, T.BooleanType()),
        ]
    )
    answered = wanted.unionByName(dealt(done, buckets), allowMissingColumns=True).groupBy(BUCKET).transformWithState(
        Results(seq, lifetime, places), key_schema, "Append", lifetime.mode
    )
    return _only(asked, [KEY, seq, SEQS]).withColumn(IS_KEY, F.lit(False)).unionByName(
        answered.withColumn(IS_KEY, F.lit(True)), allowMissingColumns=True
    )
