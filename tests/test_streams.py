"""Keyed state of streams: what is processed when, what is read, and what is kept."""

import pickle
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.breaker import circuit_states
from quayside.operators.idempotency import KEY
from quayside.sources.tables import read_stream
from quayside.streaming.jobs import circuit_state_stream, dedupe_stream, idempotent_stream
from quayside.streaming.once import Claims, Lifetime, dealt, one_per_key, packed, unpacked

DAY = datetime(2024, 3, 1)
LEDGER = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture
def two_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def arrive(spark, folder, rows):
    """A file of (seq, minutes after the start, payload)."""
    at = [(s, None if m is None else DAY + timedelta(minutes=m), p) for s, m, p in rows]
    df = spark.createDataFrame(at, "seq long, received_at timestamp, payload string")
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return df.schema


def run(spark, folder, schema, process, **options):
    query = idempotent_stream(
        read_stream(spark, f"{folder}/in", schema, files_per_trigger=1), process, LEDGER, f"{folder}/ledger",
        f"{folder}/records", f"{folder}/check", **options,
    )
    query.awaitTermination()
    return query


def records(spark, folder):
    return {r.seq: (r.n, r.was_replay) for r in spark.read.parquet(f"{folder}/records").collect()}


def chars(firsts):
    return firsts.select(KEY, "first_seq", F.length("payload").alias("n"))


def test_a_key_ends_by_event_time_and_its_state_goes(two_tasks, tmp_path):
    spark, folder = two_tasks, str(tmp_path)
    rows = [
        [(1, 0, '{"a":1}'), (2, 5, '{"a":1}'), (3, 0, '{"b":22}'), (4, None, '{"c":333}')],
        [(5, 59, '{"a":1}'), (6, 58, '{"d":1}')],
        [(7, 60, '{"a":1}'), (8, 61, '{"a":1}'), (9, 62, '{"c":333}')],
        [(10, 300, '{"e":1}'), (11, 119, '{"a":1}')],
        [(12, 301, '{"a":1}')],
    ]
    for part in rows:
        schema = arrive(spark, folder, part)
    query = run(spark, folder, schema, chars, lifetime_s=3600.0, event_time="received_at")
    got = records(spark, folder)
    first = {s for s, (_, replay) in got.items() if not replay}
    # 7 is an hour after 1, 11 less than an hour after 7, 12 more than one.
    assert first == {1, 3, 4, 6, 7, 10, 12} and set(got) == set(range(1, 13))
    assert [got[s][0] for s in (1, 3, 4, 9, 11, 12)] == [7, 8, 9, 9, 7, 7]
    totals = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in query.recentProgress]
    # The keys a, b, c, d; then those of the first hour are gone; c has no time and stays.
    assert max(map(sum, totals)) > sum(totals[-1]) and totals[-1][0] <= 3


def test_a_key_without_a_result_is_tried_in_the_next_run(two_tasks, tmp_path):
    spark, folder = two_tasks, str(tmp_path)
    schema = arrive(spark, folder, [(1, 0, '{"a":1}'), (2, 0, '{"b":2}'), (3, 1, '{"b":2}')])

    def only_a(firsts):
        return chars(firsts).filter(F.col("first_seq") == 1)

    run(spark, folder, schema, only_a)
    assert records(spark, folder) == {1: (7, False), 2: (None, False), 3: (None, False)}
    arrive(spark, folder, [(4, 9, '{"b":2}'), (5, 9, '{"b":2}'), (6, 9, '{"a":1}')])
    run(spark, folder, schema, chars)
    got = records(spark, folder)
    assert {s: got[s] for s in (4, 5, 6)} == {4: (7, False), 5: (7, True), 6: (7, True)}
    assert spark.read.parquet(f"{folder}/ledger").count() == 2


def test_a_batch_reads_no_more_when_many_went_before(two_tasks, tmp_path):
    """Bytes read through the file systems by batch, over twenty batches of new and known keys."""
    spark, folder = two_tasks, str(tmp_path)
    for part in range(20):
        keys = [part * 40 + i for i in range(40)] + [7 * part + i for i in range(10)]
        schema = arrive(spark, folder, [(part * 100 + i, part, f'{{"key":{k}}}') for i, k in enumerate(keys)])
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    read = []

    def total():
        kinds = statistics.iterator()
        found = 0
        while kinds.hasNext():
            found += kinds.next().getLong("bytesRead") or 0
        return found

    from quayside.streaming import jobs

    plain = jobs.remove_folder
    jobs.remove_folder = lambda *given: (plain(*given), read.append(total()))
    try:
        run(spark, folder, schema, chars)
    finally:
        jobs.remove_folder = plain
    steps = [b - a for a, b in zip(read, read[1:])]
    assert len(steps) >= 19
    early, late = sum(steps[3:8]), sum(steps[14:19])
    assert late < 1.5 * early
    got = records(spark, folder)
    assert len(got) == 1000 and sum(not replay for _, replay in got.values()) == 800


def test_a_flooding_key_is_reduced_before_the_shuffle(two_tasks, tmp_path):
    spark = two_tasks
    rows = spark.range(0, 30_000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        (30_000 - F.col("id")).alias("seq"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("other"),
    )
    reduced = one_per_key(rows, ["k"], "seq")
    hot = [r.seq for r in reduced.filter("k = 'hot'").collect()]
    assert len(hot) == 3 and min(hot) == 3 and reduced.count() == 20_003
    assert [f.nullable for f in reduced.schema] == [True] * 3
    nothing = one_per_key(rows.limit(0), ["k"], "seq")
    assert nothing.count() == 0
    null_key = one_per_key(rows.select(F.lit(None).cast("string").alias("k"), "seq"), ["k"], "seq")
    assert null_key.count() == 3
    timed = rows.select(F.concat(F.lit('{"k":"'), "k", F.lit('"}')).alias("payload"), F.lit(DAY).alias("received_at"))
    timed.write.parquet(str(tmp_path / "in"))
    stream = dedupe_stream(read_stream(spark, str(tmp_path / "in"), timed.schema))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    state = query.recentProgress[0]["stateOperators"][0]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20_001
    # Rows the state sees: those that are new, and the few repeats the batches left.
    assert state["numRowsUpdated"] == 20_001 and state["customMetrics"].get("numDroppedDuplicateRows", 0) < 20


def test_circuits_carry_on_through_merges_and_retries(two_tasks, tmp_path):
    """Nine batches, merged at every third, equal the whole log; only what a batch had outcomes of is stored by it."""
    spark, folder = two_tasks, str(tmp_path)
    log = [(dep, i, DAY + timedelta(seconds=5 * i), i % step == 0) for i in range(90) for dep, step in (("a", 7), ("b", 50), (None, 4))]
    log = [row for row in log if row[0] != "b" or not 30 <= row[1] < 60]
    df = spark.createDataFrame(log, "dependency string, seq long, ts timestamp, ok boolean")
    for part in range(9):
        df.filter(f"seq div 10 = {part}").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def stream():
        return circuit_state_stream(
            read_stream(spark, f"{folder}/in", df.schema, files_per_trigger=1), f"{folder}/state", f"{folder}/states",
            f"{folder}/check", 3, 15.0, merge_every=3,
        )

    stream().awaitTermination()
    columns = ["dependency", "seq", "failure_run", "state_before", "allowed", "state_after"]

    def streamed():
        return sorted(map(str, spark.read.parquet(f"{folder}/states").select(columns).collect()))

    whole = sorted(map(str, circuit_states(df, 3, 15.0).select(columns).collect()))
    assert streamed() == whole
    held = spark.read.parquet(f"{folder}/state/in_16_buckets")
    by_batch = {r[0]: set(r[1]) for r in held.groupBy("batch").agg(F.collect_set(F.coalesce("dependency", F.lit("none")))).collect()}
    assert by_batch["8"] == {"a", "b", "none"}
    # Of the batches up to 7, merged: circuits that ended in a failure only.
    merged = next(v for k, v in by_batch.items() if k.startswith("merged"))
    ends = {r.dependency or "none": r.failure_run for r in circuit_states(df.filter("seq < 80"), 3, 15.0).filter("seq = 79").collect()}
    assert merged == {d for d, run in ends.items() if run > 0} and len(by_batch) == 2
    # The last batch again, as after a driver that went away before its commit.
    commits = sorted(int(p.name) for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit())
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    stream().awaitTermination()
    assert streamed() == whole


def test_keys_share_values_of_state_and_are_computed_once(two_tasks, tmp_path):
    """The keys of a batch are in a few values of state, and parsed for one shuffle which the others use again."""
    spark, folder = two_tasks, str(tmp_path)
    schema = arrive(spark, folder, [(i, 0, f'{{"key":{i % 300}}}') for i in range(600)])
    arrive(spark, folder, [(600 + i, 0, f'{{"key":{i + 290}}}') for i in range(20)])
    query = run(spark, folder, schema, chars, state_buckets=4)
    got = records(spark, folder)
    assert {s for s, (_, replay) in got.items() if not replay} == {*range(300), *range(610, 620)}
    assert len(got) == 620 and got[599] == (11, True) and got[600] == (11, True)
    totals = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert totals and max(totals) == 4
    plan = query._jsq.explainInternal(False)
    assert plan.count("sha2(") == 1 and "ReusedExchange" in plan


def test_keys_of_one_bucket_end_one_by_one(two_tasks, tmp_path):
    spark, folder = two_tasks, str(tmp_path)
    rows = [
        [(1, 0, '{"a":1}'), (2, 30, '{"b":22}'), (3, None, '{"c":333}')],
        [(4, 60, '{"a":1}'), (5, 61, '{"b":22}'), (6, 62, '{"c":333}')],
        [(7, 300, '{"e":1}')],
        [(8, 301, '{"b":22}'), (9, 302, '{"c":333}'), (10, 303, '{"e":1}')],
    ]
    for part in rows:
        schema = arrive(spark, folder, part)
    run(spark, folder, schema, chars, lifetime_s=3600.0, event_time="received_at", state_buckets=1)
    got = records(spark, folder)
    assert {s for s, (_, replay) in got.items() if not replay} == {1, 2, 3, 4, 7, 8}
    assert [got[s] for s in (5, 6, 9, 10)] == [(8, True), (9, True), (9, True), (7, True)]


class Value:
    held = None

    def getValueState(self, *given):  # noqa: N802
        return self

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


def test_by_the_clock_a_key_lives_from_its_own_claim():
    claims = Claims("seq", [], Lifetime(5.0))
    claims.init(Value())

    def first(now, *keys):
        rows = [{KEY: k, "seq": now, "_millis": None, "_released": False} for k in keys]
        times = type("Times", (), {"getCurrentProcessingTimeInMs": lambda self: now})()
        return [row[KEY] for row in claims.handleInputRows((0,), iter(rows), times)]

    assert first(0, "a") == ["a"] and first(3000, "a", "b") == ["b"]
    assert first(5000, "a", "b") == ["a"] and first(8000, "b") == ["b"] and first(8001, "a") == []


def test_values_of_state_are_compressed_and_old_ones_read():
    held = (5, {f"{i:064x}": (i, None, ("payload " * 20, ["w"], None)) for i in range(40)})
    value = packed(held)
    assert unpacked(value) == held and len(value) < len(pickle.dumps(held, protocol=5)) / 4
    assert unpacked(pickle.dumps(held, protocol=5)) == held


def test_a_list_stands_where_a_key_repeats(spark):
    rows = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2), ("a", 2), ("c", None), ("c", 4)], "k string, seq long").coalesce(1)
    got = {r.k: (r.seq, r.l) for r in one_per_key(rows, ["k"], "seq", "l").collect()}
    assert got == {"a": (2, [2, 2, 3]), "b": (1, None), "c": (4, [4, None])}


def test_both_states_read_one_shuffle_of_the_deliveries(two_tasks, tmp_path):
    """Deliveries whose number comes twice, keys that come in two batches: a record for each, by the one shuffle."""
    spark, folder = two_tasks, str(tmp_path)
    schema = arrive(spark, folder, [(1, 0, '{"a":1}'), (1, 0, '{"a":1}'), (2, 0, '{"b":22}'), (3, 0, None), (4, 0, '{"b":22}')])
    arrive(spark, folder, [(5, 0, '{"a":1}'), (5, 0, '{"a":1}'), (6, 0, '{"c":333}')])
    query = run(spark, folder, schema, chars, state_buckets=4)
    got = sorted((r.seq, r.n, r.was_replay) for r in spark.read.parquet(f"{folder}/records").collect() if r.n)
    assert got == [
        (1, 7, False), (1, 7, False), (2, 8, False), (4, 8, True), (5, 7, True), (5, 7, True), (6, 9, False),
    ]
    assert spark.read.parquet(f"{folder}/records").filter("seq = 3").count() == 1
    plan = query._jsq.explainInternal(False)
    # That of the deliveries, and that of the results; no key ended.
    assert sum("Exchange hashpartitioning(" in line and "Reused" not in line for line in plan.splitlines()) == 2


def test_keys_and_buckets_come_out_of_the_shuffle_as_they_were(spark):
    keys = ["", "00ff" * 16, "a1" * 32]
    rows = dealt(spark.createDataFrame([(k,) for k in keys], f"{KEY} string"), 1 << 16)
    before = spark.createDataFrame([(k,) for k in keys], f"{KEY} string").select(KEY, F.pmod(F.xxhash64(KEY), F.lit(1 << 16)).alias("b"))
    assert {(r[KEY], r["_bucket"]) for r in rows.collect()} == {(r[KEY], r.b) for r in before.collect()}
