import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.breaker import circuit_states
from quayside.operators.idempotency import KEY, seen_rows, unseen_keys
from quayside.operators.rules import Rule
from quayside.operators.triage import triage
from quayside.plans.intake import (
    PipelineStage,
    add_text,
    context_schema,
    default_stages,
    insert_after,
    meet_circuit,
    run_pipeline,
    running,
)
from quayside.sources.ledger import BATCH, compact_ledger, open_ledger, read_ledger, upsert_ledger
from quayside.sources.tables import list_folder, read_stream, write_split
from quayside.streaming.jobs import (
    append_stream,
    circuit_state_stream,
    dedupe_stream,
    enrich_stream,
    idempotent_stream,
    intake_stream,
    triage_stream,
)

VALID = {"company_id": "C-4711", "company_name": "Fenwick Ltd", "revenue": 5_000_000,
         "industry": "Retail", "state": "CA"}


def deliveries(spark, dicts, **extra):
    rows = [(i, json.dumps(d)) for i, d in enumerate(dicts)]
    df = spark.createDataFrame(rows, "seq long, payload string")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def risk(spark, *ids):
    return spark.createDataFrame([(i, 72) for i in ids] or [("none", 0)], "company_id string, risk_score int")


def ids(spark, *known):
    return spark.createDataFrame([(k,) for k in known], "company_id string")


def run(spark, dicts, **options):
    extra = options.pop("extra", {})
    records = run_pipeline(deliveries(spark, dicts, **extra), **options).records
    return {r.seq: r for r in records.collect()}


def test_outcomes_of_the_chain(spark):
    cases = [
        VALID,
        {"company_id": "X"},
        {**VALID, "revenue": 0, "company_id": "ZERO"},
        {**VALID, "industry": "Gambling", "company_id": "G"},
        {**VALID, "industry": "construction", "state": "ny", "company_id": "C"},
        {**VALID, "company_id": "OLD"},
        dict(reversed(VALID.items())),
    ]
    got = run(spark, cases, risk=risk(spark, "C-4711", "OLD"), existing_ids=ids(spark, "OLD", "OLD"))
    assert [got[i].status for i in range(7)] == [
        "approved", "error", "declined", "declined", "manual_review", "potential_duplicate", "approved",
    ]
    assert got[0].enrichment.data.risk_score == 72 and not got[0].enrichment.enrichment_failed
    assert got[1].errors == ["Missing required fields: ['company_name', 'revenue', 'industry', 'state']"]
    assert got[1].company_id is None and got[1].enrichment is None
    assert got[3].enrichment is None and got[3].warnings == []
    assert got[4].warnings[0].startswith("Manual review required: Construction")
    assert got[4].warnings[1] == "No enrichment data found for 'C'"
    assert got[4].enrichment.enrichment_failed
    assert got[5].warnings == ["company_id='OLD' already exists — potential duplicate."]
    assert got[5].enrichment.data.risk_score == 72
    assert got[6].was_replay and not got[0].was_replay and got[6].payload == got[0].payload
    assert got[6][KEY] == got[0][KEY]


def test_received_at_counts_in_the_full_key(spark):
    got = run(spark, [{**VALID, "received_at": "1"}, {**VALID, "received_at": "2"}], rules=[])
    assert not got[1].was_replay


def test_custom_statuses_and_stages(spark):
    review = Rule("r", F.lit(True), "potential_duplicate", F.lit("Needs human review"))
    row = run(spark, [VALID], rules=[review], risk=risk(spark, "C-4711"))[0]
    assert row.status == "potential_duplicate"
    assert row.warnings == ["Manual review required: Needs human review"]
    pending = Rule("p", F.lit(True), "pending", F.lit("wait"))
    assert run(spark, [VALID], rules=[pending])[0].status == "approved"
    note = PipelineStage(
        "audit", lambda c: c.withColumn("warnings", add_text("warnings", F.lit("seen"), running()))
    )
    stages = insert_after(default_stages([], risk=risk(spark, "C-4711")), "validation", note)
    got = run(spark, [VALID, {"company_id": "X"}], stages=stages, risk=risk(spark, "C-4711"))
    assert got[0].warnings == ["seen"] and got[1].warnings == []


def test_open_circuit_skips_enrichment(spark):
    row = run(spark, [VALID], rules=[], risk=risk(spark, "C-4711"), extra={"circuit_open": True})[0]
    assert row.status == "approved"
    assert (row.enrichment.enrichment_failed, row.enrichment.reason, row.enrichment.data) == (
        True, "circuit_open", None,
    )
    assert "circuit breaker is OPEN" in row.warnings[0]


def test_outcomes_open_the_circuit_of_deliveries(spark):
    """Two failures in a row open a circuit for ten seconds or until the next outcome; others stay closed."""
    start = datetime(2024, 1, 1)
    log = [("eu", 0, False), ("eu", 4, False), ("eu", 11, False), ("eu", 40, True), ("us", 4, False), ("us", 6, True)]
    outcomes = spark.createDataFrame(
        [(d, i, start + timedelta(seconds=s), ok) for i, (d, s, ok) in enumerate(log)], "dependency string, seq long, ts timestamp, ok boolean"
    )
    asked = [(1, "eu", 3), (2, "eu", 4), (3, "us", 5), (4, "eu", 13), (5, "eu", 21), (6, None, 5), (7, "eu", None)]
    rows = [
        (i, api, None if s is None else start + timedelta(seconds=s), json.dumps({**VALID, "revenue": 20_000 + i}))
        for i, api, s in asked
    ]
    came = spark.createDataFrame(rows, "seq long, api string, received_at timestamp, payload string")
    met = meet_circuit(came, outcomes, F.col("api"), threshold=2, recovery_s=10.0)
    assert sorted(met.columns) == ["api", "circuit_open", "payload", "received_at", "seq"]
    got = {r.seq: r for r in run_pipeline(met, rules=[], risk=risk(spark, "C-4711")).records.collect()}
    refused = {i for i, r in got.items() if r.enrichment.reason == "circuit_open"}
    assert refused == {2, 4} and all(r.status == "approved" for r in got.values()) and len(got) == 7


def test_text_that_is_no_object_ends_as_error(spark):
    df = spark.createDataFrame([(0, "oops"), (1, "oops")], "seq long, payload string")
    rows = run_pipeline(df).records.orderBy("seq").collect()
    assert [r.status for r in rows] == ["error", "error"]
    assert [r.was_replay for r in rows] == [False, True]


def test_one_row_per_delivery_and_narrow_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    schema = context_schema(risk(spark, "C-4711"))
    empty = read_ledger(spark, path, schema)
    assert empty.count() == 0
    first = run_pipeline(deliveries(spark, [VALID, VALID]), rules=[], risk=risk(spark, "C-4711"), ledger=empty)
    upsert_ledger(first.fresh, path, 0)
    upsert_ledger(first.fresh, path, 1)
    upsert_ledger(first.fresh, path, 0)
    ledger = read_ledger(spark, path, schema)
    assert ledger.count() == 1
    again = run_pipeline(deliveries(spark, [VALID]), risk=risk(spark), ledger=ledger)
    row = again.records.first()
    assert row.was_replay and row.enrichment.data.risk_score == 72
    assert again.fresh.count() == 0


def _key_rows(spark, numbers, status):
    rows = [(f"k{n}", status, {"n": n}) for n in numbers]
    return spark.createDataFrame(rows, f"{KEY} string, status string, tags map<string,int>")


def test_a_ledger_is_looked_up_where_it_lies(spark, tmp_path):
    path = str(tmp_path / "it's a ledger")
    upsert_ledger(_key_rows(spark, range(500), "first"), path, 1, 4)
    upsert_ledger(_key_rows(spark, range(400, 900), "second"), path, 2, 8)
    schema = _key_rows(spark, [], "").schema
    ledger = open_ledger(spark, path, schema)
    assert ledger.count() == 900 and ledger.filter("status = 'second'").count() == 400
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = _key_rows(spark, range(880, 1000), "asked").select(KEY)
        for found, n in ((unseen_keys(asked, ledger), 100), (seen_rows(asked, ledger), 20)):
            assert found.count() == n
            plan = found._jdf.queryExecution().executedPlan().toString()
            scan = plan[: plan.index("FileScan parquet")].splitlines()
            assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
            # Above the scan no exchange before the join: the only one is that of the incoming keys.
            assert plan.count("Exchange hashpartitioning") - plan.count("REPARTITION_BY") <= 2 and scan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_merging_a_ledger_loses_no_key_and_retries_stay_safe(spark, tmp_path):
    from quayside.sources import ledger as module

    path = str(tmp_path / "ledger")
    schema = _key_rows(spark, [], "").schema
    for batch in range(3):
        upsert_ledger(_key_rows(spark, range(batch * 10, batch * 10 + 15), f"b{batch}"), path, batch, 4)
    expected = {f"k{n}": f"b{max(0, (n - 5) // 10) if n >= 15 else 0}" for n in range(35)}

    def stored():
        return {r[0]: r.status for r in read_ledger(spark, path, schema).collect()}

    assert stored() == expected
    # Cut off after the merged files are there, and one of the old folders is gone.
    plain, gone = module.remove_folder, []

    def once(spark, folder):
        if gone:
            raise RuntimeError("lost")
        gone.append(folder)
        plain(spark, folder)

    module.remove_folder = once
    try:
        with pytest.raises(RuntimeError):
            compact_ledger(spark, path, schema)
    finally:
        module.remove_folder = plain
    assert stored() == expected
    # A batch that was merged runs again, then the next merge takes up the rest.
    upsert_ledger(_key_rows(spark, range(10, 25), "b1 again"), path, 1)
    assert stored() == expected
    compact_ledger(spark, path, schema)
    folders = list_folder(spark, f"{path}/in_4_buckets")
    assert stored() == expected and len([f for f in folders if f.startswith(BATCH)]) == 1
    upsert_ledger(_key_rows(spark, range(30, 40), "b3"), path, 3)
    assert len(stored()) == 40 and stored()["k35"] == "b3"


def test_rejects_and_valid_rows_part(spark, tmp_path):
    df = deliveries(spark, [VALID, {"company_id": "B"}])
    valid = triage(df, payload="payload", keep=["seq"])
    write_split(valid, df.filter("seq = 1"), str(tmp_path / "ok"), str(tmp_path / "bad"), 1)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 1


# -- streams -----------------------------------------------------------------------------------


def write_files(df, folder, n):
    """One file per range of rows, so that a stream takes several batches."""
    for part in range(n):
        df.filter(f"seq % {n} = {part}").coalesce(1).write.mode("append").parquet(folder)


def test_intake_stream_equals_batch(spark, tmp_path):
    dicts = [{**VALID, "company_id": f"C{i % 7}", "revenue": 20_000 + (i % 7)} for i in range(30)]
    batch = deliveries(spark, dicts)
    data = risk(spark, "C1", "C2")
    write_files(batch, str(tmp_path / "in"), 3)
    stream = read_stream(spark, str(tmp_path / "in"), batch.schema, files_per_trigger=1)
    intake_stream(
        stream, context_schema(data), str(tmp_path / "ledger"), str(tmp_path / "out"),
        str(tmp_path / "check"), risk=data,
    ).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len({r.batch for r in out}) == 3
    expected = {r.seq: r.enrichment for r in run_pipeline(batch, risk=data).records.collect()}
    assert {r.seq: r.enrichment for r in out} == expected
    assert sum(not r.was_replay for r in out) == 7
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 7


def test_expired_keys_are_processed_anew(spark, tmp_path):
    """A key that came in an earlier batch is a replay within its lifetime and new after it; no delivery
    ends without a result."""
    rows = spark.createDataFrame([(0, '{"a":1}'), (1, '{"a":1}'), (2, '{"a":1}')], "seq long, payload string")
    write_files(rows, str(tmp_path / "in"), 3)
    ledger = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("n", T.IntegerType())])

    def count_chars(firsts):
        return firsts.select(KEY, "first_seq", F.length("payload").alias("n"))

    for lifetime, fresh in ((0.0, 3), (86_400.0, 1)):
        folder = tmp_path / str(lifetime)
        stream = read_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=1)
        idempotent_stream(
            stream, count_chars, ledger, str(folder / "ledger"), str(folder / "out"), str(folder / "check"), lifetime
        ).awaitTermination()
        out = spark.read.parquet(str(folder / "out")).collect()
        assert [r.n for r in out] == [7, 7, 7]
        assert sum(not r.was_replay for r in out) == fresh


def test_dedupe_triage_and_enrich_streams(spark, tmp_path):
    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(minutes=i), json.dumps({**VALID, "company_id": f"C{i % 4}", "received_at": str(i)}))
            for i in range(20)]
    df = spark.createDataFrame(rows, "seq long, received_at timestamp, payload string")
    write_files(df, str(tmp_path / "in"), 2)
    source = lambda: read_stream(spark, str(tmp_path / "in"), df.schema, files_per_trigger=1)
    for name, rows_of in {
        "dedupe": lambda: dedupe_stream(source()),
        "triage": lambda: triage_stream(source(), payload="payload", keep=["seq"]),
        "enrich": lambda: enrich_stream(
            triage_stream(source(), payload="payload", keep=["seq"]), risk(spark, "C1")
        ),
    }.items():
        append_stream(rows_of(), str(tmp_path / name), str(tmp_path / f"{name}-check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "dedupe")).count() == 4
    assert spark.read.parquet(str(tmp_path / "triage")).count() == 20
    assert spark.read.parquet(str(tmp_path / "enrich")).filter("success").count() == 5


def test_circuit_stream_carries_state_between_batches(spark, tmp_path):
    start = datetime(2024, 1, 1)
    events = [("a", i, start + timedelta(seconds=i * 7), i % 5 == 4) for i in range(40)]
    events += [("b", 100, start, False)]
    df = spark.createDataFrame(events, "dependency string, seq long, ts timestamp, ok boolean")
    for low, high in ((0, 12), (12, 13), (13, 30), (30, 101)):
        df.filter(f"seq >= {low} and seq < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), df.schema, files_per_trigger=1)
    circuit_state_stream(
        stream, str(tmp_path / "runs"), str(tmp_path / "out"), str(tmp_path / "check"), 3, 15.0
    ).awaitTermination()
    columns = ["dependency", "seq", "failure_run", "state_before", "state_after"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(columns)
    whole = circuit_states(df, 3, 15.0).select(columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, whole.collect()))
