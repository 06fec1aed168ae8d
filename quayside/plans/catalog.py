"""Every query of the library over the feeds, by name, and the SQL it is checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.extraction import render_prompt
from quayside.functions.http import attempt_error_text, classify_http
from quayside.functions.naming import camel_to_snake, snake_case_json, snake_case_schema
from quayside.functions.text import quoted
from quayside.operators.breaker import circuit_states, failure_runs, mark_circuit_open, open_intervals
from quayside.operators.duplicates import block_sizes, find_duplicates, with_block
from quayside.operators.enrichment import enrich, enrichment_report, fetch_attempts, resolve_api_attempts
from quayside.operators.extraction import Recorded, extract, extract_texts
from quayside.operators.idempotency import (
    FIRST,
    KEY,
    first_deliveries,
    mark_replays,
    process_once,
    seen_keys,
    unseen_keys,
    with_key,
)
from quayside.operators.rules import APPROVED, MANUAL_REVIEW, Rule, default_rules
from quayside.operators.triage import (
    RESULT_FIELDS,
    by_status,
    decide,
    rejects,
    triage,
    valid_only,
    validate_submissions,
)
from quayside.plans import oracles
from quayside.plans.feeds import feed, load_tables, streamed_feed
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
from quayside.plans.reports import (
    ledger_size,
    missing_field_counts,
    processing_count,
    replay_rate,
    status_counts,
)
from quayside.session import shared_folder, stored
from quayside.sources.ledger import compact_ledger, open_ledger, read_ledger, upsert_ledger
from quayside.sources.tables import (
    read_existing,
    read_risk,
    read_stream,
    read_submissions,
    write_split,
)
from quayside.streaming.jobs import (
    append_stream,
    circuit_state_stream,
    dedupe_stream,
    enrich_stream,
    idempotent_stream,
    intake_stream,
    triage_stream,
)

# Settings of the example queries; the SQL in ``oracles`` uses the same numbers.
BREAKER_THRESHOLD = 2
BREAKER_RECOVERY_S = 43_200.0
SHARED_THRESHOLD = 3
LARGE_SHOP = 2_000_000
PERIOD_ENDS = ("1994-01-01", "1996-01-01")
KEY_LIFETIME_S = 730 * 86_400.0


def _joined(column: str) -> Column:
    return F.array_join(column, "; ").alias(column)


# -- triage ------------------------------------------------------------------------------------


def triage_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage(feed(spark, sf_dir, "submissions"), keep=["seq"])


def triage_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage of JSON payloads, where the type of a value matters."""
    deliveries = feed(spark, sf_dir, "deliveries")
    return triage(deliveries, payload="payload", keep=["seq"]).drop("zip_code", "broker_id")


def triage_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_status(triage_decisions(spark, sf_dir), APPROVED).select("seq", "company_id")


def triage_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(triage_decisions(spark, sf_dir), "status", "reason")


def triage_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate_submissions(feed(spark, sf_dir, "submissions"), keep=["seq"])
    return rejects(checked, keep=["seq"]).withColumn(
        "validation_errors", _joined("validation_errors")
    )


def custom_rules() -> list[Rule]:
    """Clients of a house broker pass in front of all rules; large shops are looked at behind them."""
    house = Rule("house_broker", F.col("broker_id").startswith("HB-"), APPROVED, F.lit("Placed by a house broker"))
    shops = Rule(
        "large_retail",
        (F.col("industry") == "Retail") & (F.col("revenue") > LARGE_SHOP),
        MANUAL_REVIEW,
        F.concat(F.lit("Retail above "), F.lit(str(LARGE_SHOP)), F.lit(" goes to an underwriter")),
    )
    return [house, *default_rules(), shops]


def triage_custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = triage(feed(spark, sf_dir, "submissions"), custom_rules(), keep=["seq"])
    return decided.select("seq", "company_id", "status", "reason")


# -- extraction --------------------------------------------------------------------------------


def extract_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = extract(feed(spark, sf_dir, "responses"))
    return results.select(
        "seq",
        "status",
        "attempt",
        "extracted.company_name",
        "extracted.revenue",
        "extracted.industry",
        "extracted.state",
        "extracted.zip_code",
        _joined("missing_fields"),
    )


def extract_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders asked attempt by attempt, with the recorded responses as the model's answers."""
    load_tables(spark, sf_dir, ("orders",))
    texts = spark.table("orders").select(F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("text"))
    results = extract_texts(texts, Recorded(feed(spark, sf_dir, "responses")))
    return results.select("seq", "status", "attempt", "extracted.company_name", "extracted.revenue", _joined("missing_fields"))


def extract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(extract(feed(spark, sf_dir, "responses")))


def extract_missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_field_counts(extract(feed(spark, sf_dir, "responses")))


def extract_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = by_status(extract(feed(spark, sf_dir, "responses")), "failed")
    return failed.select("seq", "raw_output", "error")


def extract_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of the first two attempts for every conversation turn, whole text."""
    load_tables(spark, sf_dir, ("conversations",))
    turns = spark.table("conversations").select(
        "conv_id", "turn", "text", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("attempt")
    )
    prompt = render_prompt(F.col("text"), F.col("attempt"))
    return turns.select(
        "conv_id",
        "turn",
        "attempt",
        F.char_length(prompt).alias("prompt_chars"),
        F.sha2(prompt, 256).alias("prompt_hash"),
    )


# -- process once ------------------------------------------------------------------------------


def _triage_firsts(firsts: DataFrame) -> DataFrame:
    valid = valid_only(validate_submissions(firsts, payload="payload", keep=[KEY, FIRST]))
    return decide(valid).select(KEY, FIRST, "status", "reason")


def _stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an earlier run, over the deliveries received before 1996."""
    earlier = feed(spark, sf_dir, "deliveries").filter(
        F.col("received_at") < F.lit("1996-01-01").cast("timestamp")
    )
    keys = first_deliveries(with_key(earlier)).select(KEY)
    return keys.select(KEY, F.lit("stored").alias("status"), F.lit("earlier run").alias("reason"))


def idem_first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_once(feed(spark, sf_dir, "deliveries"), _triage_firsts).records


def idem_with_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _stored_results(spark, sf_dir)
    return process_once(feed(spark, sf_dir, "deliveries"), _triage_firsts, ledger).records


def idem_stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``idem_with_ledger``, but the results are stored, in two batches of which one runs twice, and merged."""
    path = f"{_scratch(spark, 'stored')}/ledger"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (KEY, "status", "reason")])
    results = stored(_stored_results(spark, sf_dir), "results")
    for rows, batch in ((results.filter(F.col(KEY) < "8"), 1), (results, 2), (results, 2)):
        upsert_ledger(rows, path, batch)
    compact_ledger(spark, path, schema)
    return process_once(feed(spark, sf_dir, "deliveries"), _triage_firsts, open_ledger(spark, path, schema)).records


def idem_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the run would add to the ledger."""
    ledger = _stored_results(spark, sf_dir)
    return process_once(feed(spark, sf_dir, "deliveries"), _triage_firsts, ledger).fresh


def idem_replay_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_rate(mark_replays(feed(spark, sf_dir, "deliveries")))


def idem_processing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing_count(with_key(feed(spark, sf_dir, "deliveries")))


def idem_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = first_deliveries(with_key(feed(spark, sf_dir, "deliveries")))
    return unseen_keys(incoming, _stored_results(spark, sf_dir))


def idem_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = first_deliveries(with_key(feed(spark, sf_dir, "deliveries")))
    return seen_keys(incoming, _stored_results(spark, sf_dir))


def idem_ledger_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_size(_stored_results(spark, sf_dir))


# -- duplicates --------------------------------------------------------------------------------


def dedup_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_block(feed(spark, sf_dir, "names")).select(
        "seq", "block", "normalised_name", "sorted_name"
    )


def dedup_block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_sizes(feed(spark, sf_dir, "names").filter("is_existing"))


def _duplicates(names: DataFrame) -> DataFrame:
    found = find_duplicates(names.filter("not is_existing"), names.filter("is_existing"))
    return found.withColumn("similarity_score", F.round("similarity_score", 6))


def dedup_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _duplicates(feed(spark, sf_dir, "names"))


def dedup_one_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No ZIP codes at all: every name is in the one shared block."""
    names = feed(spark, sf_dir, "names").withColumn("zip_code", F.lit(None).cast("string"))
    return _duplicates(names)


def dedup_numbered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with one of the first two digits of every customer's number changed, looked up among all customers:
    none of them exists, and all names are alike."""
    load_tables(spark, sf_dir, ("customer",))
    no_zip = F.lit(None).cast("string").alias("zip_code")
    known = spark.table("customer").select(
        F.col("c_custkey").alias("seq"), F.col("c_custkey").cast("string").alias("company_id"),
        F.col("c_name").alias("company_name"), no_zip,
    )
    at = F.locate("#", F.col("company_name")) + 1 + (F.col("seq") % 2).cast("int")
    digit = (1 + F.col("seq") % 9).cast("string")
    changed = F.overlay("company_name", digit, at).alias("company_name")
    return find_duplicates(known.select("seq", F.concat(F.lit("new-"), "company_id").alias("company_id"), changed, no_zip), known)


# -- enrichment --------------------------------------------------------------------------------


def enrich_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded attempts of all orders through the fetch hook, resolved, with data in snake case."""
    load_tables(spark, sf_dir, ("orders",))
    companies = spark.table("orders").select(F.concat(F.lit("R-"), F.col("o_orderkey").cast("string")).alias("company_id"))
    document = F.concat(
        F.lit('{"riskScore":'), F.substring("company_id", 3, 20).cast("long") % 100, F.lit(',"lastSeen":{"byAPI":"A\\"bC"}}')
    )
    log = feed(spark, sf_dir, "api_attempts").select(
        "company_id", "attempt", "status_code", F.when(F.col("status_code") == 503, "timed out").alias("transport_error"),
        F.when(F.col("status_code") == 200, document).alias("data"),
    )
    resolved = resolve_api_attempts(fetch_attempts(companies, Recorded(log)), transport_error="transport_error", data="data")
    return resolved.select("company_id", "success", "attempts_used", "data")


def enrich_snake_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_tables(spark, sf_dir, ("part",))
    document = F.concat(
        F.lit('{"partKey":'), F.col("p_partkey"), F.lit(',"brandInfo":[{"brandName":"aKey: \\"bKey\\": '),
        F.col("p_brand"), F.lit('","sizeCM" :'), F.col("p_size"), F.lit("}]}"),
    )
    return spark.table("part").select("p_partkey", snake_case_json(document).alias("document"))


def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    submissions = feed(spark, sf_dir, "submissions").select("seq", "company_id")
    return enrich(submissions, feed(spark, sf_dir, "risk"))


def enrich_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second lookup with partial cover: labels of documents."""
    load_tables(spark, sf_dir, ("documents", "labels"))
    documents = spark.table("documents").select(F.col("doc_id").alias("company_id"))
    labels = spark.table("labels").withColumnRenamed("doc_id", "company_id")
    return enrich(documents, labels)


def enrich_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_api_attempts(feed(spark, sf_dir, "api_attempts"))


def enrich_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment_report(resolve_api_attempts(feed(spark, sf_dir, "api_attempts")))


def enrich_http_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = feed(spark, sf_dir, "api_attempts")
    return attempts.select(
        "company_id",
        "attempt",
        classify_http(F.col("status_code")).alias("outcome"),
        attempt_error_text(F.col("company_id"), F.col("status_code")).alias("detail"),
    )


def enrich_snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_tables(spark, sf_dir, ("part",))
    camel = F.concat(
        F.col("p_type"),
        F.regexp_replace(F.initcap("p_name"), " ", ""),
        F.regexp_replace("p_brand", "#", "N"),
    )
    return spark.table("part").select("p_partkey", camel_to_snake(camel).alias("snake_name"))


def breaker_open_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a request one second after each outcome would meet an open circuit."""
    log = feed(spark, sf_dir, "outcomes")
    intervals = open_intervals(log, BREAKER_THRESHOLD, BREAKER_RECOVERY_S)
    later = log.select("seq", "dependency", (F.col("ts") + F.make_dt_interval(secs=F.lit(1))).alias("at"))
    marked = mark_circuit_open(later, intervals, "at", F.col("dependency"))
    return marked.select("seq", "dependency", "circuit_open")


def idem_big_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders told apart by the last digits of a number of 48."""
    load_tables(spark, sf_dir, ("lineitem",))
    number = F.concat(F.lit("12345678901234567890123456789012345678"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"))
    rows = spark.table("lineitem").select("l_orderkey", "l_linenumber").distinct().select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat(F.lit('{"number":'), number, F.lit("}")).alias("payload"),
    )
    return mark_replays(rows).select("seq", "was_replay")


def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches put if absent, the second one twice, as after a retry; then the ledger is read."""
    load_tables(spark, sf_dir, ("orders",))
    path = f"{_scratch(spark, 'ledger')}/rows"
    key = F.sha2(F.col("o_orderkey").cast("string"), 256).alias(KEY)
    orders = spark.table("orders")
    first = orders.filter("o_orderstatus = 'F'").select(key, F.lit("first").alias("status"))
    every = orders.select(key, F.lit("second").alias("status"))
    for rows, batch in ((first, 1), (every, 2), (every, 2)):
        upsert_ledger(rows, path, batch)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (KEY, "status")])
    return read_ledger(spark, path, schema)


def sources_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions as JSON lines, existing companies and risk data as Parquet, through their readers."""
    folder = _scratch(spark, "sources")
    feed(spark, sf_dir, "submissions").write.json(f"{folder}/submissions")
    feed(spark, sf_dir, "risk").write.parquet(f"{folder}/risk")
    feed(spark, sf_dir, "names").filter("is_existing").write.parquet(f"{folder}/existing")
    submissions = read_submissions(spark, f"{folder}/submissions", "json")
    risk = read_risk(spark, f"{folder}/risk").select("company_id", "region")
    known = read_existing(spark, f"{folder}/existing").select("seq", F.col("company_name").alias("part_company"))
    return (
        submissions.select("seq", "company_id", "revenue", "zip_code")
        .join(risk, "company_id", "left").join(known, "seq", "left")
    )


def rejects_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows and rejects, written twice as one batch, and read again."""
    folder = _scratch(spark, "split")
    rows = feed(spark, sf_dir, "submissions")
    for _ in range(2):
        write_split(triage(rows, keep=["seq"]), rejects(validate_submissions(rows, keep=["seq"]), keep=["seq"]), f"{folder}/valid", f"{folder}/rejects", 7)
    kept = spark.read.parquet(f"{folder}/valid").select("seq", F.lit(True).alias("is_valid"))
    gone = spark.read.parquet(f"{folder}/rejects").select("seq", F.lit(False).alias("is_valid"))
    return kept.unionByName(gone)


def enrich_snake_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """camelCase risk documents, nested, to snake_case columns."""
    load_tables(spark, sf_dir, ("customer",))
    camel = spark.table("customer").select(
        F.col("c_custkey").alias("companyId"),
        F.struct(
            F.col("c_acctbal").alias("accountBalance"),
            F.array(F.struct(F.col("c_nationkey").alias("HTTPSCode"))).alias("claimsHistory"),
        ).alias("riskData"),
    )
    snake = snake_case_schema(camel)
    return snake.select(
        "company_id",
        "risk_data.account_balance",
        F.col("risk_data.claims_history")[0]["https_code"].alias("https_code"),
    )


# -- breaker -----------------------------------------------------------------------------------


def breaker_failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = failure_runs(feed(spark, sf_dir, "outcomes"))
    return runs.select(
        "dependency",
        "seq",
        "failure_run",
        (F.col("failure_run") >= BREAKER_THRESHOLD).alias("threshold_reached"),
    )


def breaker_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = circuit_states(
        feed(spark, sf_dir, "outcomes"), BREAKER_THRESHOLD, BREAKER_RECOVERY_S
    )
    return states.select("dependency", "seq", "state_before", "allowed", "state_after")


# -- the whole chain ---------------------------------------------------------------------------


def _earlier_contexts(spark: SparkSession, sf_dir: str, risk: DataFrame) -> DataFrame:
    """Ledger of an earlier run without rules or known companies."""
    earlier = feed(spark, sf_dir, "deliveries").filter(
        F.col("received_at") < F.lit("1996-01-01").cast("timestamp")
    )
    return run_pipeline(earlier, rules=[], risk=risk).fresh


def _contexts(records: DataFrame) -> DataFrame:
    return records.select(
        "seq",
        KEY,
        "was_replay",
        "status",
        "company_id",
        "triage_reason",
        "enrichment.enrichment_failed",
        F.col("enrichment.reason").alias("enrichment_reason"),
        "enrichment.data.risk_score",
        "enrichment.data.region",
        _joined("warnings"),
        _joined("errors"),
    )


def _run_all(spark: SparkSession, sf_dir: str, with_ledger: bool = False) -> DataFrame:
    risk = feed(spark, sf_dir, "risk")
    known = feed(spark, sf_dir, "known_companies")
    ledger = _earlier_contexts(spark, sf_dir, risk) if with_ledger else None
    deliveries = feed(spark, sf_dir, "deliveries")
    return run_pipeline(deliveries, existing_ids=known, risk=risk, ledger=ledger).records


def intake_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contexts(_run_all(spark, sf_dir))


def intake_with_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contexts(_run_all(spark, sf_dir, with_ledger=True))


def intake_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(_run_all(spark, sf_dir), "status", "was_replay")


def _intake_with_circuits(spark: SparkSession, sf_dir: str, deliveries: DataFrame, log: DataFrame, threshold: int) -> DataFrame:
    met = meet_circuit(deliveries, log, F.col("api"), threshold=threshold, recovery_s=BREAKER_RECOVERY_S)
    known = feed(spark, sf_dir, "known_companies")
    return _contexts(run_pipeline(met, existing_ids=known, risk=feed(spark, sf_dir, "risk")).records)


def intake_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of each region's API open its circuit; deliveries that met it open are not enriched."""
    load_tables(spark, sf_dir, ("customer", "nation"))
    apis = spark.sql(
        "select c_custkey as submission_seq, concat('risk-', n_regionkey) as api from customer join nation on n_nationkey = c_nationkey"
    )
    deliveries = feed(spark, sf_dir, "deliveries").join(apis, "submission_seq")
    return _intake_with_circuits(spark, sf_dir, deliveries, feed(spark, sf_dir, "api_outcomes"), BREAKER_THRESHOLD)


def intake_circuit_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One circuit for the calls of all regions."""
    log = feed(spark, sf_dir, "api_outcomes").withColumn("dependency", F.lit("risk"))
    deliveries = feed(spark, sf_dir, "deliveries").withColumn("api", F.lit("risk"))
    return _intake_with_circuits(spark, sf_dir, deliveries, log, SHARED_THRESHOLD)


def intake_custom_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user stage after validation: an audit note on every row still running."""
    risk = feed(spark, sf_dir, "risk")

    def audit(contexts: DataFrame) -> DataFrame:
        note = F.concat(F.lit("audited "), quoted(F.col("company_id")))
        return contexts.withColumn("warnings", add_text("warnings", note, running()))

    stages = insert_after(
        default_stages(risk=risk), "validation", PipelineStage("audit", audit)
    )
    deliveries = feed(spark, sf_dir, "deliveries")
    return _contexts(run_pipeline(deliveries, risk=risk, stages=stages).records)


# -- streams -----------------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """New folder for one run in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _appended(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    folder = _scratch(spark, name)
    append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def stream_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = streamed_feed(spark, sf_dir, "submissions", "customer")
    return _appended(spark, triage_stream(arriving, keep=["seq"]), "triage")


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = streamed_feed(spark, sf_dir, "submissions", "customer").select("seq", "company_id")
    return _appended(spark, enrich_stream(arriving, feed(spark, sf_dir, "risk")), "enrich")


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a stream of deliveries; which delivery of a key arrives first is left open."""
    arriving = streamed_feed(spark, sf_dir, "order_deliveries", "orders")
    unique = dedupe_stream(arriving, lifetime="7300 days").select(KEY)
    return _appended(spark, unique, "dedupe")


def stream_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark, "idempotent")
    arriving = streamed_feed(spark, sf_dir, "order_deliveries", "orders")
    ledger = T.StructType([T.StructField(c, T.StringType()) for c in (KEY, "status", "reason")])
    idempotent_stream(
        arriving,
        _triage_firsts,
        ledger,
        f"{folder}/ledger",
        f"{folder}/records",
        f"{folder}/checkpoint",
        state_tasks=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/records").drop("batch")


def stream_key_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the deliveries of three periods; a key lives two years from its first delivery."""
    folder = _scratch(spark, "expiry")
    rows = feed(spark, sf_dir, "order_deliveries").withColumn("received_at", F.col("received_at").cast("timestamp"))
    ledger = T.StructType([T.StructField(c, T.StringType()) for c in (KEY, "status", "reason")])
    begins = [F.lit(day).cast("timestamp") for day in ("0001-01-01", *PERIOD_ENDS, "9999-01-01")]
    for low, high in zip(begins, begins[1:]):
        period = rows.filter((F.col("received_at") >= low) & (F.col("received_at") < high))
        period.write.mode("append").parquet(f"{folder}/in")
        idempotent_stream(
            read_stream(spark, f"{folder}/in", rows.schema),
            _triage_firsts,
            ledger,
            f"{folder}/ledger",
            f"{folder}/records",
            f"{folder}/checkpoint",
            KEY_LIFETIME_S,
            event_time="received_at",
            state_tasks=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/records").drop("batch")


def stream_circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark, "circuit")
    circuit_state_stream(
        streamed_feed(spark, sf_dir, "outcomes", "events"),
        f"{folder}/runs",
        f"{folder}/states",
        f"{folder}/checkpoint",
        BREAKER_THRESHOLD,
        BREAKER_RECOVERY_S,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/states").select(
        "dependency", "seq", "state_before", "allowed", "state_after"
    )


def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark, "intake")
    risk = feed(spark, sf_dir, "risk")
    intake_stream(
        streamed_feed(spark, sf_dir, "order_deliveries", "orders"),
        context_schema(risk),
        f"{folder}/ledger",
        f"{folder}/records",
        f"{folder}/checkpoint",
        existing_ids=feed(spark, sf_dir, "known_companies"),
        risk=risk,
        state_tasks=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return _contexts(spark.read.parquet(f"{folder}/records"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        triage_decisions,
        triage_payloads,
        triage_approved,
        triage_status_counts,
        triage_rejects,
        triage_custom_rule,
        extract_results,
        extract_completed,
        extract_status,
        extract_missing_counts,
        extract_failures,
        extract_prompts,
        idem_first_delivery,
        idem_with_ledger,
        idem_stored_ledger,
        idem_fresh,
        idem_replay_rate,
        idem_processing_count,
        idem_unseen,
        idem_seen,
        idem_ledger_size,
        dedup_normalise,
        dedup_block_sizes,
        dedup_fuzzy_match,
        dedup_one_block,
        dedup_numbered_names,
        enrich_lookup,
        enrich_documents,
        enrich_attempts,
        enrich_report,
        enrich_http_classes,
        enrich_snake_names,
        enrich_snake_schema,
        enrich_snake_json,
        enrich_fetched,
        breaker_open_marks,
        idem_big_numbers,
        ledger_round_trip,
        sources_read_back,
        rejects_split,
        breaker_failure_runs,
        breaker_states,
        intake_results,
        intake_with_ledger,
        intake_status_counts,
        intake_breaker,
        intake_circuit_open,
        intake_custom_stage,
        stream_triage,
        stream_enrich,
        stream_dedupe,
        stream_idempotent,
        stream_key_expiry,
        stream_circuit,
        stream_intake,
    )
}

ORACLES: dict[str, str] = oracles.build()
