import glob
import json
import os
import random
import time
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.breaker import (
    circuit_states,
    failure_runs,
    mark_circuit_open,
    open_intervals,
)
from quayside.operators.duplicates import block_sizes, find_duplicates
from quayside.operators.enrichment import (
    enrich,
    enrichment_report,
    fetch_attempts,
    resolve_api_attempts,
)
from quayside.operators.extraction import extract, extract_texts
from quayside.operators.idempotency import KEY, mark_replays, process_once, seen_rows, with_key
from quayside.operators.near_names import TWICE_UP_TO, best_within_two, marked_names
from quayside.operators.ordered import before_each, scan_ranges
from quayside.operators.rules import (
    Rule,
    default_rules,
    revenue_out_of_appetite,
    sanctioned_industry,
)
from quayside.operators.skew import grid_join, heavy_keys
from quayside.operators.triage import rejects, triage, validate_submissions
from quayside.plans.feeds import FEEDS, feed, load_tables
from quayside.session import shared_folder, stored

VALID = {
    "company_id": "C-4711",
    "company_name": "Fenwick Ltd",
    "revenue": 5_000_000,
    "industry": "Retail",
    "state": "CA",
    "zip_code": "90210",
}


def payloads(spark, dicts):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(dicts)]
    return spark.createDataFrame(rows, "seq long, payload string")


def triaged(spark, dicts, rules=None):
    result = triage(payloads(spark, dicts), rules, payload="payload", keep=["seq"])
    return {r.seq: r for r in result.collect()}


# -- triage ------------------------------------------------------------------------------------


def test_dirty_input(spark):
    variants = [
        {"revenue": "$5,000,000"}, {"revenue": "5000000"}, {"state": "ca"}, {"industry": "retail"},
        {"revenue": "not-a-number"}, {"company_id": "   "}, {"zip_code": 90210},
        {"company_id": 5}, {"revenue": None}, {"revenue": True}, {"broker_id": None},
    ]
    got = triaged(spark, [{**VALID, **v} for v in variants] + [{"company_id": "X1", "revenue": 1}])
    assert sorted(got) == [0, 1, 2, 3, 10]
    assert got[0].revenue == Decimal(5000000)
    assert got[2].state == "CA" and got[3].industry == "Retail"


@pytest.mark.parametrize("as_text", [False, True])
def test_revenue_boundaries(spark, as_text):
    cases = {500_000_001: "declined", 500_000_000: "approved", 5_000_000: "approved",
             10_000: "approved", 9_999: "declined"}
    got = triaged(spark, [{**VALID, "revenue": str(r) if as_text else r} for r in cases])
    assert [got[i].status for i in range(len(cases))] == list(cases.values())
    assert got[0].reason == "Revenue $500,000,001 exceeds the maximum appetite of $500,000,000."
    assert got[4].reason == "Revenue $9,999 is below the minimum appetite of $10,000."


def test_rule_matrix_and_order(spark):
    cases = [
        ("Construction", "NY", 5e6, "manual_review"), ("Construction", "new york", 5e6, "manual_review"),
        ("Construction", "CA", 5e6, "approved"), ("Retail", "NY", 5e6, "approved"),
        ("gambling", "CA", 5e6, "declined"), ("Construction", "NY", 6e8, "declined"),
    ]
    got = triaged(
        spark, [{**VALID, "industry": i, "state": s, "revenue": int(r)} for i, s, r, _ in cases]
    )
    assert [got[i].status for i in range(len(cases))] == [c[3] for c in cases]
    assert got[3].reason is None


def test_injected_rules(spark):
    strict = revenue_out_of_appetite(Decimal(100_000), Decimal(1_000_000))
    assert triaged(spark, [{**VALID, "revenue": 50_000}], strict)[0].status == "declined"
    crypto = [sanctioned_industry(["Crypto"])]
    got = triaged(spark, [{**VALID, "industry": "Crypto"}, VALID], crypto)
    assert (got[0].status, got[1].status) == ("declined", "approved")
    assert triaged(spark, [{**VALID, "industry": "Gambling"}], [sanctioned_industry([])])[0].status == "declined"
    assert triaged(spark, [{**VALID, "industry": "Gambling"}], [])[0].status == "approved"
    house = Rule("house", F.col("broker_id") == "HB-1", "approved", F.lit("Placed by a house broker"))
    fast = triaged(
        spark, [{**VALID, "industry": "Gambling", "broker_id": "HB-1"}], [house, *default_rules()]
    )[0]
    assert (fast.status, fast.reason) == ("approved", "Placed by a house broker")


def test_all_errors_are_collected(spark):
    bad = payloads(spark, [{"company_id": 1, "revenue": "x", "state": 3, "zip_code": 9}])
    errors = rejects(validate_submissions(bad, "payload")).first().validation_errors
    assert [e.split(":")[0] for e in errors] == [
        "company_id", "company_name", "revenue", "industry", "state", "zip_code",
    ]


def test_triage_plan_is_narrow_and_parses_once(spark):
    plan = triage(payloads(spark, [VALID]), payload="payload")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "Exchange" not in physical and "Python" not in physical
    assert physical.count("from_json") == 1


# -- extraction --------------------------------------------------------------------------------

FULL = json.dumps({"company_name": "Fenwick Ltd", "revenue": 5_000_000, "industry": "Retail",
                   "state": "ny", "zip_code": "10001"})


def extracted(spark, attempts, max_attempts=2):
    rows = [(0, i + 1, raw) for i, raw in enumerate(attempts)]
    df = spark.createDataFrame(rows, "seq long, attempt int, raw string")
    return extract(df, max_attempts).first()


def test_extraction_outcomes(spark):
    ok = extracted(spark, [FULL])
    assert (ok.status, ok.attempt, ok.extracted.state, ok.missing_fields) == ("success", 1, "NY", [])
    part = extracted(spark, [json.dumps({"company_name": "A", "revenue": 1, "industry": None, "state": "NY"})])
    assert part.status == "partial" and part.missing_fields == ["industry"]
    retry = extracted(spark, ["I cannot extract that.", FULL])
    assert (retry.status, retry.attempt) == ("success", 2)
    assert extracted(spark, [f"```json\n{FULL}\n```"]).status == "success"
    failed = extracted(spark, ["bad", "also bad", "still bad", FULL], 3)
    assert failed.status == "failed" and "3" in failed.error and failed.raw_output == "still bad"
    number_zip = json.loads(FULL) | {"zip_code": 10001}
    assert extracted(spark, [json.dumps(number_zip)]).status == "failed"
    assert extracted(spark, [json.dumps(json.loads(FULL) | {"revenue": True})]).status == "failed"


@pytest.mark.parametrize(
    "raw, expected",
    [(5_000_000, 5000000), ("$5,000,000", 5000000), ("4.5M", 4500000), ("500k", 500000),
     ("not-a-number", None), (None, None)],
)
def test_extracted_revenue(spark, raw, expected):
    row = extracted(spark, [json.dumps(json.loads(FULL) | {"revenue": raw})])
    assert row.extracted.revenue == (None if expected is None else Decimal(expected))


def test_model_is_asked_again_only_for_open_texts(spark):
    texts = spark.createDataFrame([(1, "good"), (2, "slow"), (3, "never")], "seq long, text string")

    def answer(batches):
        for batch in batches:
            retry = batch.prompt.str.contains("REMINDER")
            raw = [
                FULL if "good" in p.rsplit("Text:", 1)[1] or (again and "slow" in p) else "no"
                for p, again in zip(batch.prompt, retry)
            ]
            yield pd.DataFrame({"seq": batch.seq, "raw": raw})

    got = {r.seq: (r.status, r.attempt) for r in extract_texts(texts, answer).collect()}
    assert got == {1: ("success", 1), 2: ("success", 2), 3: ("failed", 2)}


# -- process once ------------------------------------------------------------------------------


def count_chars(firsts):
    return firsts.select(KEY, "first_seq", F.length("payload").alias("n"))


def test_each_payload_is_processed_once(spark):
    dicts = [{"a": 1, "received_at": str(i)} for i in range(40)] + [{"a": i} for i in range(2, 6)]
    done = process_once(payloads(spark, dicts), count_chars)
    rows = done.records.collect()
    assert len(rows) == 44 and sum(not r.was_replay for r in rows) == 5
    assert {r.seq for r in rows if not r.was_replay} == {0, 40, 41, 42, 43}
    assert len({r.n for r in rows if r.seq < 40}) == 1
    assert done.fresh.count() == 5


def test_ledger_hits_are_replays_and_not_stored_again(spark):
    ledger = with_key(payloads(spark, [{"a": 1}])).select(KEY, F.lit(99).alias("n"))
    done = process_once(payloads(spark, [{"a": 1}, {"a": 2}]), count_chars, ledger)
    got = {r.seq: (r.n, r.was_replay) for r in done.records.collect()}
    assert got == {0: (99, True), 1: (8, False)}
    assert done.fresh.count() == 1
    marked = {r.seq: r.was_replay for r in mark_replays(payloads(spark, [{"a": 1}, {"a": 2}]), ledger).collect()}
    assert marked == {0: True, 1: False}


def test_stored_null_results_are_replays_and_repeated_ledger_rows_count_once(spark):
    one = with_key(payloads(spark, [{"a": 1}])).select(KEY, F.lit(None).cast("int").alias("n"))
    done = process_once(payloads(spark, [{"a": 1}, {"a": 1}]), count_chars, one.unionByName(one))
    assert [(r.n, r.was_replay) for r in done.records.collect()] == [(None, True)] * 2
    assert done.fresh.count() == 0


def test_failed_rows_are_not_stored(spark):
    done = process_once(payloads(spark, [{"a": 1}, {"a": 1}]), lambda f: count_chars(f).filter("false"))
    assert done.fresh.count() == 0
    assert [r.was_replay for r in done.records.collect()] == [False, False]


# -- skew --------------------------------------------------------------------------------------


def test_grid_join_equals_plain_join(spark):
    rng = random.Random(3)
    left = spark.createDataFrame(
        [(i, rng.choice([1, 1, 1, 2, 3, None, i])) for i in range(600)], "i long, k long"
    )
    other = left.filter("k is not null").withColumnRenamed("i", "j")
    plain = left.join(other, ["k"]).select("i", "j", "k")
    grid = grid_join(left, other, ["k"], F.col("i"), F.col("j"), 20).select("i", "j", "k")
    assert plain.exceptAll(grid).count() == 0 and grid.exceptAll(plain).count() == 0


def test_every_key_above_the_slice_is_split(spark):
    rows = spark.range(20_000).select((F.col("id") % 5000).alias("k"))
    slots = heavy_keys(rows, ["k"], 1).collect()
    assert len(slots) == 5000 and {r["_slots"] for r in slots} == {4}
    # A list that may hold fewer keys has a larger slice, and then still every key above it.
    skewed = rows.unionByName(spark.range(3000).select((F.col("id") % 3).alias("k")))
    slots = {r["k"]: r["_slots"] for r in heavy_keys(skewed, ["k"], 1, listed=100).collect()}
    assert slots == {k: -(-1004 // 230) for k in range(3)}


# -- duplicates --------------------------------------------------------------------------------

EXISTING = [
    (1, "K1", "Tidewater Rope & Sail GmbH", "20457-11"), (2, "K2", "Ostwind Segel AG", "20457"),
    (3, "K3", "Ostwind Segel Nord", "20457"), (4, "K4", "Brasswell Instruments", "55116"),
    (5, "K5", "Brasswell Instrument", "55116"), (6, "K6", "Q", "55116"), (7, "K7", "Lantern Yard plc", ""),
]
SCHEMA = "seq long, company_id string, company_name string, zip_code string"


def duplicates(spark, candidates, existing=EXISTING, **options):
    found = find_duplicates(
        spark.createDataFrame(candidates, SCHEMA), spark.createDataFrame(existing, SCHEMA), **options
    )
    return {r.seq: r for r in found.collect()}


def test_what_counts_as_a_duplicate(spark):
    """Expected score: 100 less the indel distance as a share of both lengths, or none below 90."""
    cases = [
        # name, ZIP code, match, characters in common, both lengths
        ("tidewater ROPE and sail", "20457", "K1", 19, 42),
        ("tidewater rope chandlery", "20457", None, 0, 1),
        ("Tidewater Rope Sails", "20457-99", "K1", 19, 39),
        ("Sail, Rope: Tidewater", "20457", "K1", 1, 2),
        ("Segel Ostwind International", "20457 ", "K2", 1, 2),
        ("Ostwind Segel Nor", "20457", "K3", 17, 35),
        ("Ostwind Segel", "55116", None, 0, 1),
        ("Brasswell Instruments Holdings", "55116", "K4", 1, 2),
        ("Brasswel Instrument", "55116", "K5", 19, 39),
        ("Q Co", "55116", None, 0, 1),
        ("lantern yard", None, "K7", 1, 2),
        ("lantern yards", None, "K7", 12, 25),
        ("group of companies", "", None, 0, 1),
    ]
    got = duplicates(spark, [(i, f"N{i}", name, code) for i, (name, code, *_) in enumerate(cases)])
    for i, (name, _, match, common, lengths) in enumerate(cases):
        row = got[i]
        assert (row.candidate_id, row.matched_id) == (f"N{i}", match), name
        assert row.is_potential_duplicate is (match is not None)
        expected = 200 * common / lengths if match else 0.0
        assert abs(row.similarity_score - expected) < 1e-9, (name, row.similarity_score)


def test_null_zips_share_a_block_and_last_record_is_reported(spark):
    existing = [(1, "A", "Blue Harbor", None), (2, "B", "Blue Harbor Inc", ""), (3, "C", "Harbor Blue", None)]
    row = duplicates(spark, [(1, "N", "blue harbor llc", None)], existing)[1]
    assert (row.matched_id, row.matched_name) == ("B", "Blue Harbor Inc")


def dynamic_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [90.0, 75.0, 60.0])
def test_one_big_block_finds_the_same_as_brute_force(spark, threshold):
    rng = random.Random(int(threshold))

    def name():
        base = rng.choice(["north shore metal works", "green valley farms", "abcabcabcabc", "tiny",
                           "ab cd", "quartz mining and exploration partners of the western range"])
        chars = list(base)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(chars))
            chars[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "z", " "])
            chars = chars or ["q"]
        return "".join(chars)

    existing = [(i, f"E{i}", name(), "") for i in range(120)]
    candidates = [(i, f"C{i}", name(), None) for i in range(120)]
    got = duplicates(spark, candidates, existing, threshold=threshold, slice_rows=10)

    def key(text):
        return " ".join(sorted(t for t in text.lower().split() if len(t) > 1 and t != "co"))

    for seq, _, text, _ in candidates:
        best = 0.0
        a = key(text)
        for _, _, other, _ in existing:
            b = key(other)
            if a and b:
                score = 200.0 * dynamic_lcs(a, b) / (len(a) + len(b))
                best = max(best, score if score >= threshold else 0.0)
        assert got[seq].similarity_score == pytest.approx(best), (text, a)


def test_names_two_characters_apart(spark):
    """Against all pairs: the best partner at distance 1 or 2 (1 only for long names), and which are settled."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abé0") for _ in range(rng.choice([1, 2, 5, 9, 20, 21, 24]))) for _ in range(60)]
    for word in words[:40]:
        at = rng.randrange(len(word))
        words.append(word[:at] + rng.choice(["", "b", "zz"]) + word[at + rng.randint(0, 1) :])
    names = sorted({w for w in words if w})
    known = [(rng.choice("XY"), n, i) for i, n in enumerate(names) if i % 2]
    wanted = [(b, n) for i, n in enumerate(names) for b in "XY" if not i % 2]
    for threshold in (60.0, 90.0):
        found = best_within_two(
            spark.createDataFrame(wanted, "block string, sorted_name string"),
            spark.createDataFrame(known, "block string, sorted_name string, position long"), threshold,
        )
        got = {(r.block, r.sorted_name): (r.score, r.known_name) for r in found.collect()}
        expected = {}
        for block, name in wanted:
            best = []
            for other_block, other, place in known:
                distance = len(name) + len(other) - 2 * dynamic_lcs(name, other)
                if block == other_block and distance <= (2 if len(name) <= TWICE_UP_TO else 1):
                    score = 100 * (1 - distance / (len(name) + len(other)))
                    if score >= threshold - 1e-9:
                        best.append((-score, place, other))
            if best:
                score, _, other = min((round(s, 9), p, o) for s, p, o in best)
                expected[block, name] = (-score, other)
        assert {k: (round(s, 9), o) for k, (s, o) in got.items()} == expected and len(expected) > 3


def test_work_per_name_does_not_grow_with_alike_names(spark):
    """Pairs that meet when one digit in front is changed, for ten times as many names."""

    def meetings(n):
        known = spark.range(n).select(
            F.lit("").alias("block"), F.concat(F.lit("customer "), F.lpad("id", 9, "0")).alias("sorted_name"), F.col("id").alias("position")
        )
        wanted = known.select("block", F.overlay("sorted_name", F.lit("7"), 10).alias("sorted_name"))
        best = best_within_two(wanted, known, 90.0)
        assert best.count() == n and best.filter(~F.col("settled")).count() == 0
        a, b = marked_names(wanted, True), marked_names(known, False).withColumnRenamed("sorted_name", "known_name")
        return a.join(b, ["block", "tag", "text"]).count() / n

    few, many = meetings(300), meetings(3000)
    assert many < 1.6 * few < 60


def test_block_sizes(spark):
    codes = ["55116", "55116-7", " 55116", "2", None, "", "  "]
    rows = [(i, None, "any", code) for i, code in enumerate(codes)]
    sizes = block_sizes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.block: r.n_records for r in sizes} == {"55116": 3, "2": 1, "": 3}


def test_duplicates_plan_has_no_cross_join(spark):
    df = spark.createDataFrame(EXISTING, SCHEMA)
    plan = find_duplicates(df, df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# -- enrichment --------------------------------------------------------------------------------


def test_attempts_are_walked_in_order(spark):
    logs = {"A": [503, 503, 200], "B": [500, 500, 500], "C": [404, 200], "D": [None], "E": [429, 404],
            "F": [500, 500, 500, 200]}
    rows = [(c, i + 1, s, None if s else "timed out") for c, ss in logs.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "company_id string, attempt int, status_code int, lost string")
    got = {r.company_id: r for r in resolve_api_attempts(df, transport_error="lost").collect()}
    assert {k: (r.success, r.attempts_used) for k, r in got.items()} == {
        "A": (True, 3), "B": (False, 3), "C": (False, 1), "D": (False, 1), "E": (False, 2), "F": (False, 3),
    }
    assert got["B"].error == "Transient API failure after 3 retries: Risk API server error 500 for B"
    assert got["C"].error == "Non-retriable API error: Risk API client error 404 for C"
    assert "retries" in got["D"].error and got["A"].error is None


def test_report(spark):
    rows = spark.createDataFrame([("A", True), ("BAD", False), ("C", True)], "company_id string, success boolean")
    assert enrichment_report(rows).first() == (2, 1, pytest.approx(2 / 3))
    assert enrichment_report(rows.filter("false")).first() == (0, 0, 0.0)


def test_empty_data_is_success_and_missing_key_is_not(spark):
    subs = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "seq long, company_id string")
    risk = spark.createDataFrame([("A", None)], "company_id string, risk_score int")
    got = {r.seq: (r.success, r.warning) for r in enrich(subs, risk).collect()}
    assert got == {1: (True, None), 2: (False, "No enrichment data found for 'B'"), 3: (False, None)}


def test_repeated_risk_rows_do_not_multiply_submissions(spark):
    subs = spark.createDataFrame([(1, "O'x"), (2, "B")], "seq long, company_id string")
    risk = spark.createDataFrame([("B", 5, 1), ("B", 3, 2), ("B", None, 3)], "company_id string, risk_score int, version int")
    got = {r.seq: (r.risk_score, r.warning) for r in enrich(subs, risk, order=["version"]).collect()}
    assert got == {1: (None, 'No enrichment data found for "O\'x"'), 2: (None, None)}


def test_repeated_rows_of_maps_and_variants(spark):
    """Columns without an order do not stop the choice of the last row, in risk data and in a ledger."""
    risk = spark.sql("""
        select * from values ('A', 1, map('k', 1), parse_json('{"v":1}')), ('A', 2, map('k', 0), parse_json('[2]')),
          ('A', 2, map('k', 5), parse_json('[1]')), ('B', null, null, null) as t(company_id, score, tags, doc)""")
    asked = spark.createDataFrame([("A",), ("B",), ("C",)], "company_id string")
    got = {r.company_id: (r.score, r.tags, r.success) for r in enrich(asked, risk).drop("doc").collect()}
    assert got == {"A": (2, {"k": 5}, True), "B": (None, None, True), "C": (None, None, False)}
    ledger = risk.select(F.col("company_id").alias(KEY), "tags", F.array("doc").alias("docs"))
    keys = spark.createDataFrame([("A",), ("Z",)], f"{KEY} string")
    rows = seen_rows(keys, ledger).select(KEY, "tags").collect()
    assert [(r[0], r.tags) for r in rows] == [("A", {"k": 5})]
    only_ids = spark.createDataFrame([("A",), ("A",)], "company_id string")
    assert enrich(asked, only_ids).filter("success").count() == 1


def test_fetch_hook(spark):
    ids = spark.createDataFrame([("A",), ("A",), ("B",)], "company_id string")

    def fetch(batches):
        for batch in batches:
            for company in batch.company_id:
                code = 200 if company == "A" else 404
                yield pd.DataFrame({"company_id": [company], "attempt": [1], "status_code": [code],
                                    "transport_error": [None], "data": ['{"riskScore":1}']})

    log = fetch_attempts(ids, fetch, partitions=2)
    got = {r.company_id: (r.success, r.data) for r in resolve_api_attempts(log, data="data").collect()}
    assert got == {"A": (True, '{"risk_score":1}'), "B": (False, None)}


# -- breaker -----------------------------------------------------------------------------------

START = datetime(2024, 1, 1)


def outcomes(spark, events):
    rows = [(d, i, START + timedelta(seconds=s), ok) for i, (d, s, ok) in enumerate(events)]
    return spark.createDataFrame(rows, "dependency string, seq long, ts timestamp, ok boolean")


def test_breaker_transitions(spark):
    events = [("x", 0, False), ("x", 1, False), ("x", 2, False), ("x", 3, False), ("x", 40, False),
              ("x", 75, True), ("x", 76, False)]
    got = circuit_states(outcomes(spark, events), 3, 30.0).orderBy("seq").collect()
    assert [r.state_before for r in got] == ["closed", "closed", "closed", "open", "half_open", "half_open", "closed"]
    assert [r.state_after for r in got] == ["closed", "closed", "open", "open", "open", "closed", "closed"]
    assert [r.allowed for r in got] == [True, True, True, False, True, True, True]


def test_ranges_do_not_change_the_result(spark):
    rng = random.Random(5)
    events = [(rng.choice("aab"), rng.randint(0, 5000), rng.random() > 0.6) for _ in range(800)]
    events += [("c", rng.randint(0, 5000), False) for _ in range(500)]
    df = outcomes(spark, events)
    whole = sorted(map(str, circuit_states(df, 3, 30.0, ranges=1).collect()))
    for ranges in (None, 3, 40):
        assert sorted(map(str, circuit_states(df, 3, 30.0, ranges=ranges).collect())) == whole

    run = {"a": 0, "b": 0, "c": 0}
    ordered = sorted(enumerate(events), key=lambda e: (e[1][1], e[0]))
    expected, before = {}, {}
    for seq, (dep, _, ok) in ordered:
        before[seq] = run[dep]
        run[dep] = 0 if ok else run[dep] + 1
        expected[seq] = run[dep]
    got = failure_runs(df, ranges=16).collect()
    assert {r.seq: r.failure_run for r in got} == expected
    assert {r.seq: r.previous_run for r in got} == before
    carried = spark.createDataFrame([("a", 7, START), ("z", 4, START)], "dependency string, failure_run long, ts timestamp")
    told = {r.seq: (r.previous_run, r.previous_ts) for r in failure_runs(df, carried, 16).collect()}
    first_a = next(seq for seq, (dep, _, _) in ordered if dep == "a")
    assert told[first_a] == (7, START) and len(told) == len(events)


def test_one_busy_dependency_is_spread_over_all_tasks(spark):
    """All rows of one dependency in one hour, few of another."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 100 == 0, "quiet").otherwise("busy").alias("dependency"), F.col("id").alias("seq"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 60_000).alias("ts"), (F.col("id") % 7 == 3).alias("ok"),
    )
    order = [F.col("ts"), F.col("seq")]
    scanned = scan_ranges(rows, F.col("dependency"), order, {}, {"t": F.col("ts")}, 8)
    sizes = [r["count"] for r in scanned.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_by" in plan and "hashpartitioning" not in plan
    runs = failure_runs(rows, ranges=8).groupBy("dependency").agg(F.max("failure_run").alias("n")).collect()
    assert {r.dependency: r.n for r in runs} == {"busy": 12, "quiet": 6}


def brute_before(rows):
    """(key, at, count, flag, value) in order: sum since the flag and last value before each row."""
    state, out = {}, []
    for key, at, count, flag, value in rows:
        total, last = state.get(key, (0, None))
        out.append((total, last))
        state[key] = (0 if flag else total + count, last if value is None else value)
    return out


@pytest.mark.parametrize("ranges", [1, 4, 30])
def test_values_before_each_row(spark, ranges):
    rng = random.Random(ranges)
    rows = [
        (rng.choice(["x", "x", "x", "y", None]), i, rng.randint(0, 3), rng.random() < 0.02, rng.choice([None] * 30 + ["v", "w"]))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "k string, at long, c int, f boolean, v string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = before_each(
            df, F.col("k"), [F.col("at")], {"s": (F.col("c"), F.col("f"))}, {"l": F.col("v")}, ranges
        ).orderBy("at").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [(r.s, r.l) for r in got] == brute_before(rows)
    empty = before_each(df.limit(0), F.col("k"), [F.col("at")], {"s": (F.col("c"), F.col("f"))}, {"l": F.col("v")}, ranges)
    assert empty.columns == ["k", "at", "c", "f", "v", "s", "l"] and empty.count() == 0


def test_no_outcome_is_lost(spark):
    rows = [(None, 1, START, False), ("x", 2, None, False), ("x", 3, START, False)]
    df = spark.createDataFrame(rows, "dependency string, seq long, ts timestamp, ok boolean")
    assert {r.seq: r.failure_run for r in failure_runs(df).collect()} == {1: 1, 2: 1, 3: 2}


def test_open_intervals_mark_rows(spark):
    events = [("risk", 0, False), ("risk", 10, False), ("risk", 70, True), ("risk", 80, False)]
    intervals = open_intervals(outcomes(spark, events), 2, 30.0)
    rows = spark.createDataFrame(
        [(s, START + timedelta(seconds=s)) for s in (5, 10, 39, 40, 75)], "s int, at timestamp"
    )
    other = intervals.withColumn("dependency", F.lit("other"))
    marked = mark_circuit_open(rows, intervals.unionByName(other), "at", F.lit("risk"))
    assert marked.count() == 5
    assert {r.s: r.circuit_open for r in marked.collect()} == {
        5: False, 10: True, 39: True, 40: False, 75: False,
    }


def test_texts_of_names_are_not_broadcast(spark):
    """Two names look small; their hundreds of texts each are what would go through the driver."""
    known = spark.createDataFrame([("b", "acme 0001", 1), ("b", "acme 0002", 2)], "block string, sorted_name string, position int")
    found = best_within_two(spark.createDataFrame([("b", "acme 0091")], "block string, sorted_name string"), known, 80.0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.known_name for r in found.collect()] == ["acme 0001"]


def test_tasks_that_parse_follow_the_shuffle_partitions(spark, tmp_path):
    spark.createDataFrame([(1, "A", "RETAIL", 3, 5.0)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(7, 1, START)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, 1), (7, 2)], "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rows = feed(spark, str(tmp_path), "deliveries")
        assert rows.rdd.getNumPartitions() == 60 and rows.count() == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keys_are_computed_once_and_stored(spark):
    rows = spark.createDataFrame([(2, '{"a":1}'), (1, '{"a": 1}'), (3, "{}")], "seq long, payload string")
    done = process_once(rows, lambda firsts: firsts.select(KEY, "first_seq", "payload"))
    marked = mark_replays(rows)
    for found in (done.records, done.fresh, marked):
        assert "from_json" not in found._jdf.queryExecution().analyzed().toString()
    assert sorted((r.seq, r.payload, r.was_replay) for r in done.records.collect()) == [
        (1, '{"a": 1}', False), (2, '{"a": 1}', True), (3, "{}", False),
    ]
    assert sorted((r.seq, r.was_replay) for r in marked.collect()) == [(1, False), (2, True), (3, False)]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/**/shuffle_*", recursive=True)}


def test_what_is_stored_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    counted = spark.range(300_000).groupBy((F.col("id") % 70_000).alias("k")).count()
    assert stored(counted, "counted").count() == 70_000
    for _ in range(50):
        if not (left := {f for f in shuffle_files(spark) - before if os.path.getsize(f) > 2000}):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_keys_are_stored_as_bytes_and_results_once(spark):
    folder = shared_folder(spark).removeprefix("file:")
    seen = set(glob.glob(f"{folder}/*"))
    rows = spark.createDataFrame([(2, '{"a":1}'), (1, '{"a": 1}'), (3, None), (4, "{}")], "seq long, payload string")
    ledger = with_key(rows).filter("seq = 4").select(KEY, F.lit("old").alias("payload"))
    done = process_once(rows, lambda firsts: firsts.select(KEY, "first_seq", "payload"), ledger)
    new = {f.rsplit("/", 1)[1].split("-")[0]: f for f in set(glob.glob(f"{folder}/*")) - seen}
    assert spark.read.parquet(new["keyed"]).schema[KEY].dataType == T.BinaryType()
    assert "results" in new and "Exchange" not in done.fresh._jdf.queryExecution().executedPlan().toString()
    keys = {r.seq: r[KEY] for r in with_key(rows).collect()}
    got = {r.seq: (r[KEY], r.payload, r.was_replay) for r in done.records.collect()}
    assert got == {
        1: (keys[1], '{"a": 1}', False), 2: (keys[1], '{"a": 1}', True), 3: ("", None, False), 4: (keys[4], "old", True),
    }
    assert done.records.columns == [KEY, "seq", "payload", "was_replay"]
    assert sorted(r[KEY] for r in done.fresh.collect()) == sorted([keys[1], ""])


def test_results_that_no_file_can_hold(spark):
    rows = spark.createDataFrame([(1, "{}"), (2, "{}")], "seq long, payload string")
    done = process_once(rows, lambda firsts: firsts.select(KEY, "first_seq", F.expr("make_interval(0, 0, 0, 1) as wait")))
    assert {(r.seq, r.days, r.was_replay) for r in done.records.selectExpr("seq", "cast(wait as string) as days", "was_replay").collect()} == {
        (1, "1 days", False), (2, "1 days", True),
    }


def test_order_lines_are_dealt_once(spark, tmp_path):
    """Lines that come twice or have no order, orders that come twice: the rows of the feeds' SQL, with one shuffle of the lines."""
    spark.createDataFrame(
        [(k, "A", "RETAIL", (k or 0) % 3, 5.0) for k in (1, 2, 3, 3, None)],
        "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double",
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(
        [(k, c, at, "F", "1") for k, c, at in ((7, 1, START), (8, 2, START), (8, 2, START), (9, 3, None), (None, 1, START), (10, None, START))],
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string, o_orderpriority string",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(7, 1, "R"), (7, 1, "A"), (7, 2, None), (8, 1, "N"), (9, None, "N"), (None, 1, "N"), (10, 1, "R"), (11, 1, "R")],
        "l_orderkey long, l_linenumber int, l_returnflag string",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(n, "N", n % 2) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    load_tables(spark, str(tmp_path), ("customer", "orders", "lineitem", "nation"))
    needed = ("submissions", "order_deliveries", "deliveries", "api_outcomes")
    for name, n in (("deliveries", 6), ("api_outcomes", 6)):
        parts = ", ".join(f"{f} as ({FEEDS[f]})" for f in needed)
        plain = spark.sql(f"with {parts} select * from {name}")
        rows = feed(spark, str(tmp_path), name)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and plan.count("REPARTITION_BY_NUM") == 1
        assert rows.columns == plain.columns and rows.count() == n
        assert Counter(map(str, rows.collect())) == Counter(map(str, plain.collect()))


def test_ranges_are_stored_in_columns(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.expr("parse_json('[1]')").alias("v"))
    found = before_each(rows, F.col("k"), [F.col("id")], last={"before": F.col("id")})
    assert "LogicalRDD" not in found._jdf.queryExecution().analyzed().toString()
    assert {r.id: r.before for r in found.collect()} == {i: i - 3 if i > 2 else None for i in range(100)}
