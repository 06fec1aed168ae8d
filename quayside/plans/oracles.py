"""SQL each query is checked against, written for DuckDB and independent of the Spark plans.

The SQL takes the plain route everywhere: windows over whole keys, all pairs of a block, one
joined table per feed.
"""

from __future__ import annotations

from quayside.functions.extraction import PROMPT_HEAD, PROMPT_REMINDER
from quayside.functions.text import ENTITY_SUFFIXES
from quayside.plans.feeds import with_feeds

_NEW_YORK = (
    "Construction submissions in New York require manual review "
    "due to complex local regulations (e.g., Labor Law 240/241)."
)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Submissions with parsed amount, shown amount, title-cased industry, upper-cased state.
_CHECKED = r"""
checked as (
  select s.*, cleaned, revenue_value,
    case when revenue_value is null then null
         when cleaned like '%.00' then format('{:,}', cast(revenue_value as bigint)) || '.00'
         else format('{:,}', cast(revenue_value as bigint)) end as revenue_text,
    array_to_string(list_transform(regexp_extract_all(trim(industry), '([a-zA-Z]+|[^a-zA-Z]+)'),
      lambda w: upper(w[1]) || lower(w[2:])), '') as industry_name,
    upper(trim(state)) as state_name
  from (select *, regexp_replace(revenue, '[$,_\s]', '', 'g') as cleaned,
          try_cast(regexp_replace(revenue, '[$,_\s]', '', 'g') as decimal(38,6)) as revenue_value
        from submissions) s
),
decided as (
  select *,
    case when revenue_value > 500000000 then 'declined'
         when revenue_value < 10000 then 'declined'
         when industry_name in ('Gambling', 'Tobacco', 'Weapons Manufacturing') then 'declined'
         when industry_name = 'Construction'
           and state_name in ('NY', 'NEW YORK', 'NEW YORK STATE') then 'manual_review'
    end as fired,
    case when revenue_value > 500000000 then 'Revenue $' || revenue_text
           || ' exceeds the maximum appetite of $500,000,000.'
         when revenue_value < 10000 then 'Revenue $' || revenue_text
           || ' is below the minimum appetite of $10,000.'
         when industry_name in ('Gambling', 'Tobacco', 'Weapons Manufacturing')
           then 'Industry ''' || industry_name || ''' is outside our appetite.'
         when industry_name = 'Construction'
           and state_name in ('NY', 'NEW YORK', 'NEW YORK STATE') then NEW_YORK_TEXT
    end as fired_reason
  from checked
)""".replace("NEW_YORK_TEXT", _literal(_NEW_YORK))

_VALID = "company_name is not null and revenue_value is not null and trim(company_id) <> ''"

_TRIAGED = f"""
triaged as (
  select seq, company_id, company_name, revenue_value as revenue, industry_name as industry,
    state_name as state, zip_code, broker_id, coalesce(fired, 'approved') as status,
    fired_reason as reason
  from decided where {_VALID}
)"""

# Amounts in payloads: numbers keep no trailing zeros, quoted ones do.
_KEYED = r"""
keyed as (
  select d.seq, d.order_seq, d.submission_seq, d.received_at,
    sha256(replace(concat('{"company_id":"', s.company_id, '",',
      case when s.company_name is null then ''
           else concat('"company_name":"', s.company_name, '",') end,
      '"industry":"', s.industry, '",', REC '"revenue":',
      case when s.seq % 4 in (0, 3) and s.seq % 29 <> 0 then s.revenue
           else concat('"', s.revenue, '"') end,
      ',"state":"', s.state, '"}'), '@', '')) as idempotency_key
  from deliveries d join submissions s on s.seq = d.submission_seq
)"""
_CONTENT_KEYED = _KEYED.replace("REC", "'@',")
_FULL_KEYED = _KEYED.replace(
    "REC", """'"received_at":"', cast(d.received_at as varchar), '",',"""
)

_BY_ORDER = "(select seq, seq as order_seq, submission_seq, received_at from order_deliveries) d"


def _per_order(sql: str) -> str:
    """The same check over one delivery per order."""
    return sql.replace("from deliveries d join submissions", f"from {_BY_ORDER} join submissions")


_FIRSTS = """
firsts as (
  select *, min(seq) over (partition by idempotency_key) as first_seq from keyed
)"""

_STORED = """
stored as (
  select distinct idempotency_key from keyed where received_at < timestamp '1996-01-01'
)"""

_BODIES = r"""
bodies as (
  select *, case when json_valid(body) then cast(body as json) end as doc from (
    select seq, attempt, raw,
      trim(regexp_replace(regexp_replace(regexp_replace(trim(raw), '^```json', ''),
        '^```', ''), '```$', ''), chr(10) || ' ') as body
    from responses where attempt <= 2) b
),
attempts as (
  select *,
    case when doc is null or json_type(doc) <> 'OBJECT'
           then 'response is not a single JSON object'
         when coalesce(json_type(doc, '$.zip_code'), 'NULL') not in ('NULL', 'VARCHAR')
           then 'zip_code: Input should be a valid string' end as problem,
    nullif(trim(json_extract_string(doc, '$.company_name')), '') as company_name,
    regexp_replace(json_extract_string(doc, '$.revenue'), '[$,_\s]', '', 'g') as amount,
    nullif(trim(json_extract_string(doc, '$.industry')), '') as industry,
    upper(trim(json_extract_string(doc, '$.state'))) as state,
    json_extract_string(doc, '$.zip_code') as zip_code
  from bodies
),
typed as (
  select *, cast(case when amount like '%M'
      then try_cast(amount[:-2] as decimal(38,6)) * 1000000
      else try_cast(amount as decimal(38,6)) end as decimal(38,6)) as revenue
  from attempts
),
hits as (
  select *, row_number() over (partition by seq order by attempt) as n
  from typed where problem is null
),
fails as (
  select *, row_number() over (partition by seq order by attempt desc) as n from typed
),
extracted as (
  select t.seq,
    case when h.seq is null then 'failed'
         when h.company_name is null or h.industry is null or h.revenue is null
           or h.state is null then 'partial' else 'success' end as status,
    coalesce(h.attempt, f.attempt) as attempt,
    h.company_name, h.revenue, h.industry, h.state, h.zip_code,
    case when h.seq is null then [] else list_filter([
      case when h.company_name is null then 'company_name' end,
      case when h.industry is null then 'industry' end,
      case when h.revenue is null then 'revenue' end,
      case when h.state is null then 'state' end], lambda x: x is not null) end as missing,
    case when h.seq is null then f.raw end as failed_raw,
    case when h.seq is null then 'All 2 extraction attempts failed. Last error: '
      || coalesce(f.problem, 'None') end as error
  from (select distinct seq from responses) t
  left join hits h on h.seq = t.seq and h.n = 1
  left join fails f on f.seq = t.seq and f.n = 1
)"""

_SUFFIXES = ", ".join(_literal(s) for s in ENTITY_SUFFIXES)
_NAMED = rf"""
named as (
  select *, array_to_string(list_sort(words), ' ') as sorted_name,
    array_to_string(words, ' ') as normalised_name
  from (select seq, company_id, company_name, is_existing,
          ZIP as block,
          list_filter(regexp_split_to_array(lower(company_name), '[^\p{{L}}\p{{N}}_]+'),
            lambda w: length(w) > 1 and w not in ({_SUFFIXES})) as words
        from names) n
),
collapsed as (
  select block, normalised_name, sorted_name, min(seq) as position,
    max_by(company_id, seq) as matched_id, max_by(company_name, seq) as matched_name
  from named where is_existing and normalised_name <> '' group by all
),
pairs as (
  select block, a, b, length(a) as la, length(b) as lb from (
    select distinct c.block, c.sorted_name as a, e.sorted_name as b
    from named c join collapsed e on e.block = c.block
    where not c.is_existing and c.normalised_name <> '') p
  where levenshtein(a, b) * 10 <= length(a) + length(b)
),
scored as (
  select *, lb - bit_count(list_reduce(list_transform(string_split(a, ''), lambda c:
      cast(list_sum(list_transform(range(1, lb + 1), lambda i:
        case when b[i] = c then cast(1 as bigint) << (i - 1) else 0 end)) as bigint)),
      lambda s, m: ((s + (s & m)) | (s - (s & m))) & ((cast(1 as bigint) << lb) - 1),
      (cast(1 as bigint) << lb) - 1)) as lcs
  from pairs
),
close as (
  select *, cast(200.0 as double) * lcs / (la + lb) as score from scored
  where (la + lb - 2 * lcs) * 10 <= la + lb
),
ranked as (
  select c.block, c.a, e.matched_id, e.matched_name, c.score,
    row_number() over (partition by c.block, c.a order by c.score desc, e.position) as n
  from close c join collapsed e on e.block = c.block and e.sorted_name = c.b
)"""
_ZIP_BLOCK = "substring(trim(coalesce(zip_code, '')), 1, 5)"
_DUPLICATES = """
select n.seq, n.company_id as candidate_id, r.score is not null as is_potential_duplicate,
  r.matched_id, round(coalesce(r.score, 0.0), 6) as similarity_score, r.matched_name
from named n left join ranked r on r.block = n.block and r.a = n.sorted_name and r.n = 1
where not n.is_existing"""

_RESOLVED = """
classed as (
  select *, case when status_code = 429 or status_code >= 500 then 'retriable'
                 when status_code >= 400 then 'client_error' else 'ok' end as outcome,
    case when status_code = 429 then 'Rate-limited by Risk API (429) for ' || company_id
         when status_code >= 500 then 'Risk API server error ' || status_code || ' for '
           || company_id
         when status_code >= 400 then 'Risk API client error ' || status_code || ' for '
           || company_id end as detail
  from api_attempts
),
resolved as (
  select company_id, outcome = 'ok' as success, attempt as attempts_used,
    case outcome when 'retriable' then 'Transient API failure after 3 retries: ' || detail
         when 'client_error' then 'Non-retriable API error: ' || detail end as error
  from (select *, row_number() over (partition by company_id order by
          case when outcome <> 'retriable' then 0 else 1 end,
          case when outcome <> 'retriable' then attempt else -attempt end) as n
        from classed where attempt <= 3) c
  where n = 1
)"""

_RUNS = """
islands as (
  select *, sum(cast(ok as int)) over (partition by dependency order by ts, seq) as island
  from outcomes
),
runs as (
  select *, cast(sum(case when ok then 0 else 1 end)
      over (partition by dependency, island order by ts, seq) as bigint) as failure_run
  from islands
),
states as (
  select *, lag(failure_run, 1, 0) over w as before_run, lag(ts) over w as before_ts
  from runs window w as (partition by dependency order by ts, seq)
)"""

# Intervals of open circuits of the API, and the deliveries' places in them.
_API_OPENED = (
    _RUNS.replace("from outcomes", "from (select * replace (DEPENDENCY as dependency) from api_outcomes) a")
    .replace("islands", "api_islands").replace("runs as", "api_runs as").replace("from runs", "from api_runs")
    .replace("states as", "api_states as")
    + """,
opened as (
  select dependency, ts, least(ts + interval 43200 second,
      coalesce(lead(ts) over (partition by dependency order by ts, seq), timestamp '9999-01-01')) as until
  from api_runs qualify failure_run >= THRESHOLD
),
last_opened as (
  select d.seq, d.received_at < p.until as refused
  from (select d.seq, d.received_at, API as api from deliveries d
        join customer c on c.c_custkey = d.submission_seq join nation n on n.n_nationkey = c.c_nationkey) d
  asof join opened p on p.dependency = d.api and d.received_at >= p.ts
)"""
)


def _met_circuit(dependency: str, api: str, threshold: int) -> str:
    opened = _API_OPENED.replace("DEPENDENCY", dependency).replace("API as", f"{api} as").replace("THRESHOLD", str(threshold))
    refused = "coalesce((select any_value(x.refused) from last_opened x where x.seq = f.seq), false)"
    plain = _contexts(refused=refused)
    return plain.replace("contexts as (\n  select f.seq", opened.strip() + ",\ncontexts as (\n  select f.seq", 1)


_CONTEXTS = """
contexts as (
  select f.seq, f.idempotency_key, REPLAY as was_replay,
    case when s.company_name is null then 'error'
         when EARLIER then 'approved'
         when s.fired = 'declined' then 'declined'
         when k.company_id is not null then 'potential_duplicate'
         else coalesce(s.fired, 'approved') end as status,
    case when s.company_name is not null then s.company_id end as company_id,
    case when s.company_name is not null and not (EARLIER) then s.fired_reason end
      as triage_reason,
    s.company_name is not null and (EARLIER or coalesce(s.fired, '') <> 'declined') as alive,
    s.fired, s.fired_reason, EARLIER as earlier, OPEN as refused,
    r.company_id as risk_id, r.risk_score, r.region,
    k.company_id as known_id, s.company_id as raw_id, s.company_name is null as nameless
  from firsts f
  join decided s on s.seq = f.submission_seq
  left join known_companies k on k.company_id = s.company_id
  left join risk r on r.company_id = s.company_id
  left join stored t on t.idempotency_key = f.idempotency_key
)
select seq, idempotency_key, was_replay, status, company_id, triage_reason,
  case when alive then refused or risk_id is null end as enrichment_failed,
  case when alive and refused then 'circuit_open' end as enrichment_reason,
  case when alive and not refused then risk_score end as risk_score,
  case when alive and not refused then region end as region,
  case when not alive then DEAD else array_to_string(list_filter([
    AUDIT
    case when not earlier and fired = 'manual_review'
      then 'Manual review required: ' || fired_reason end,
    case when not earlier and known_id is not null
      then 'company_id=''' || raw_id || ''' already exists — potential duplicate.' end,
    case when refused then 'Enrichment skipped: Risk API circuit breaker is OPEN. The API has been failing — enrichment will resume automatically.'
         when risk_id is null then 'No enrichment data found for ''' || raw_id || '''' end
    ], lambda x: x is not null), '; ') end as warnings,
  case when nameless then 'Missing required fields: [''company_name'']' else '' end as errors
from contexts"""


def _contexts(
    replay: str = "f.seq <> f.first_seq",
    earlier: str = "false",
    refused: str = "false",
    audit: str = "",
    dead: str = "''",
    known: bool = True,
) -> str:
    sql = (
        _CONTEXTS.replace("REPLAY", replay)
        .replace("EARLIER", earlier)
        .replace("OPEN as refused", f"({refused}) as refused")
        .replace("DEAD", dead)
        .replace("AUDIT", audit)
    )
    if not known:
        sql = sql.replace("left join known_companies k on k.company_id = s.company_id",
                          "left join known_companies k on k.company_id is null")
    parts = ",".join([_CHECKED, _FULL_KEYED, _FIRSTS, _STORED, sql.strip()])
    return with_feeds("").rstrip() + "," + parts


def _sql(query: str, *parts: str) -> str:
    return with_feeds("").rstrip() + "".join("," + p for p in parts) + "\n" + query.strip()


# A key in three periods: the claim in force in each is the period's own first delivery, unless an earlier claim is
# less than two years old then.
_CLAIMS = """
in_period as (
  select *, case when received_at < timestamp '1994-01-01' then 1
    when received_at < timestamp '1996-01-01' then 2 else 3 end as period from keyed
),
period_firsts as (
  select idempotency_key, period, {'seq': min(seq), 'at': arg_min(cast(received_at as timestamp), seq)} as f
  from in_period group by all
),
by_key as (
  select idempotency_key, any_value(f) filter (period = 1) as f1, any_value(f) filter (period = 2) as f2,
    any_value(f) filter (period = 3) as f3
  from period_firsts group by all
),
two as (
  select *, case when f1 is null or f2.at >= f1.at + interval 730 day then f2 else f1 end as c2 from by_key
),
claims as (
  select *, case when c2 is null or f3.at >= c2.at + interval 730 day then f3 else c2 end as c3 from two
)"""
_KEY_EXPIRY = f"""
select p.seq, p.idempotency_key,
  ({_VALID}) and p.seq <> case period when 1 then f1.seq when 2 then c2.seq else c3.seq end as was_replay,
  case when {_VALID} then coalesce(fired, 'approved') end as status,
  case when {_VALID} then fired_reason end as reason
from in_period p join claims c on c.idempotency_key = p.idempotency_key join decided s on s.seq = p.submission_seq"""


_ERRORS = """
select seq, company_id, array_to_string(list_filter([
    case when company_name is null then 'company_name: Field required' end,
    case when revenue_value is null
      then 'revenue: Value error, Cannot parse revenue from string: ''' || revenue || '''' end,
    case when company_name is not null and revenue_value is not null and trim(company_id) = ''
      then 'Value error, company_id must not be blank' end
  ], lambda x: x is not null), '; ') as validation_errors
from checked
where company_name is null or revenue_value is null or trim(company_id) = ''"""


def build() -> dict[str, str]:
    prompt = f"{_literal(PROMPT_HEAD)} || text"
    full_prompt = f"{prompt} || case when attempt > 1 then {_literal(PROMPT_REMINDER)} else '' end"
    dedup = _NAMED.replace("ZIP as", f"{_ZIP_BLOCK} as")
    one_block = _NAMED.replace("ZIP as", "'' as")
    idem = f"""
select f.seq, f.idempotency_key, f.seq <> f.first_seq and ({_VALID}) as was_replay,
  case when {_VALID} then coalesce(fired, 'approved') end as status,
  case when {_VALID} then fired_reason end as reason
from firsts f join decided s on s.seq = f.submission_seq"""
    idem_ledger = f"""
select f.seq, f.idempotency_key,
  t.idempotency_key is not null or (f.seq <> f.first_seq and ({_VALID})) as was_replay,
  case when t.idempotency_key is not null then 'stored'
       when {_VALID} then coalesce(fired, 'approved') end as status,
  case when t.idempotency_key is not null then 'earlier run'
       when {_VALID} then fired_reason end as reason
from firsts f join decided s on s.seq = f.submission_seq
left join stored t on t.idempotency_key = f.idempotency_key"""
    states = """
select dependency, seq,
  case when before_run < 2 then 'closed'
       when ts - before_ts >= interval 12 hours then 'half_open' else 'open' end as state_before,
  not (before_run >= 2 and ts - before_ts < interval 12 hours) as allowed,
  case when failure_run >= 2 then 'open' else 'closed' end as state_after
from states"""
    whole_chain = _contexts()
    audited = "'audited ''' || raw_id || ''''"
    triaged = (_CHECKED, _TRIAGED)
    content = (_CHECKED, _CONTENT_KEYED, _FIRSTS, _STORED)
    checks = {
        "triage_decisions": _sql("select * from triaged", *triaged),
        "triage_payloads": _sql(
            """
select d.seq, t.company_id, t.company_name, t.revenue, t.industry, t.state, t.status, t.reason
from deliveries d join triaged t on t.seq = d.submission_seq""",
            *triaged,
        ),
        "triage_approved": _sql(
            "select seq, company_id from triaged where status = 'approved'", *triaged
        ),
        "triage_status_counts": _sql(
            "select status, reason, count(*) as n from triaged group by all", *triaged
        ),
        "triage_rejects": _sql(_ERRORS, _CHECKED),
        "triage_custom_rule": _sql(
            f"""
select seq, company_id,
  case when broker_id like 'HB-%' then 'approved'
       when fired is not null then fired
       when industry_name = 'Retail' and revenue_value > 2000000 then 'manual_review'
       else 'approved' end as status,
  case when broker_id like 'HB-%' then 'Placed by a house broker'
       when fired is not null then fired_reason
       when industry_name = 'Retail' and revenue_value > 2000000 then 'Retail above 2000000 goes to an underwriter'
  end as reason
from decided where {_VALID}""",
            _CHECKED,
        ),
        "extract_results": _sql(
            """
select seq, status, attempt, company_name, revenue, industry, state, zip_code,
  array_to_string(missing, '; ') as missing_fields from extracted""",
            _BODIES,
        ),
        "extract_completed": _sql(
            """
select o_orderkey as seq, coalesce(status, 'failed') as status, attempt, company_name, revenue,
  coalesce(array_to_string(missing, '; '), '') as missing_fields
from orders left join extracted on seq = o_orderkey""",
            _BODIES,
        ),
        "extract_status": _sql(
            "select status, count(*) as n from extracted group by all", _BODIES
        ),
        "extract_missing_counts": _sql(
            """
select field, count(*) as n
from (select unnest(missing) as field from extracted) group by all""",
            _BODIES,
        ),
        "extract_failures": _sql(
            "select seq, failed_raw as raw_output, error from extracted where status = 'failed'",
            _BODIES,
        ),
        "extract_prompts": f"""
select conv_id, turn, attempt, length(prompt) as prompt_chars, sha256(prompt) as prompt_hash
from (select conv_id, turn, attempt, {full_prompt} as prompt
      from (select conv_id, turn, text, unnest([1, 2]) as attempt from conversations) c) p""",
        "idem_first_delivery": _sql(idem, *content),
        "idem_with_ledger": _sql(idem_ledger, *content),
        "idem_fresh": _sql(
            f"""
select f.idempotency_key, coalesce(fired, 'approved') as status, fired_reason as reason
from firsts f join decided s on s.seq = f.submission_seq
where f.seq = f.first_seq and {_VALID}
  and f.idempotency_key not in (select idempotency_key from stored)""",
            *content,
        ),
        "idem_replay_rate": _sql(
            """
select count(*) as n_deliveries, count(*) filter (seq <> first_seq) as n_replays,
  avg(cast(seq <> first_seq as int)) as replay_rate from firsts""",
            *content,
        ),
        "idem_processing_count": _sql(
            "select count(distinct idempotency_key) as n_processed from keyed", *content
        ),
        "idem_unseen": _sql(
            """
select idempotency_key, min(seq) as first_seq from keyed
where idempotency_key not in (select idempotency_key from stored) group by all""",
            *content,
        ),
        "idem_seen": _sql(
            """
select idempotency_key, min(seq) as first_seq from keyed
where idempotency_key in (select idempotency_key from stored) group by all""",
            *content,
        ),
        "idem_ledger_size": _sql("select count(*) as n_keys from stored", *content),
        "dedup_normalise": _sql(
            "select seq, block, normalised_name, sorted_name from named", dedup
        ),
        "dedup_block_sizes": _sql(
            """
select block, count(*) as n_records from named where is_existing group by all""",
            dedup,
        ),
        "dedup_fuzzy_match": _sql(_DUPLICATES, dedup),
        "dedup_one_block": _sql(_DUPLICATES, one_block),
        "enrich_lookup": _sql(
            """
select s.seq, s.company_id, r.risk_score, r.region, r.company_id is not null as success,
  case when r.company_id is null
       then 'No enrichment data found for ''' || s.company_id || '''' end as warning
from submissions s left join risk r on r.company_id = s.company_id"""
        ),
        "enrich_documents": """
select d.doc_id as company_id, l.quality, l.toxic, l.doc_id is not null as success,
  case when l.doc_id is null then 'No enrichment data found for ''' || d.doc_id || '''' end
    as warning
from documents d left join labels l on l.doc_id = d.doc_id""",
        "enrich_attempts": _sql("select * from resolved", _RESOLVED),
        "enrich_report": _sql(
            """
select count(*) filter (success) as n_succeeded, count(*) filter (not success) as n_failed,
  coalesce(avg(cast(success as int)), 0.0) as success_rate from resolved""",
            _RESOLVED,
        ),
        "enrich_http_classes": _sql(
            "select company_id, attempt, outcome, detail from classed", _RESOLVED
        ),
        "enrich_snake_names": """
select p_partkey, lower(regexp_replace(regexp_replace(
    p_type || array_to_string(list_transform(string_split(p_name, ' '),
      lambda w: upper(w[1]) || lower(w[2:])), '') || replace(p_brand, '#', 'N'),
    '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')) as snake_name
from part""",
        "enrich_snake_schema": """
select c_custkey as company_id, c_acctbal as account_balance, c_nationkey as https_code
from customer""",
        "enrich_snake_json": """
select p_partkey, '{"part_key":' || p_partkey || ',"brand_info":[{"brand_name":"aKey: \\"bKey\\": ' || p_brand
  || '","size_cm" :' || p_size || '}]}' as document from part""",
        "enrich_fetched": _sql(
            """
select company_id, success, attempts_used,
  case when success then '{"risk_score":' || (cast(company_id[3:] as bigint) % 100)
    || ',"last_seen":{"by_api":"A\\"bC"}}' end as data
from resolved""",
            _RESOLVED,
        ),
        # Of names that keep all characters but the changed one, the one the change was made to comes first.
        "dedup_numbered_names": """
select c_custkey as seq, 'new-' || c_custkey as candidate_id, true as is_potential_duplicate,
  cast(c_custkey as varchar) as matched_id,
  200.0::double * (length(c_name) - 1) / (2 * length(c_name)) as similarity_score, c_name as matched_name
from customer""",
        "breaker_open_marks": _sql(
            """
select o.seq, o.dependency, exists (
    select 1 from opened p where p.dependency = o.dependency
      and o.ts + interval 1 second >= p.ts and o.ts + interval 1 second < p.until) as circuit_open
from outcomes o""",
            _RUNS,
            """
opened as (
  select dependency, ts, failure_run,
    least(ts + interval 43200 second,
      coalesce(lead(ts) over (partition by dependency order by ts, seq), timestamp '9999-01-01')) as until
  from runs qualify failure_run >= 2
)""",
        ),
        "idem_big_numbers": """
select l_orderkey * 10 + l_linenumber as seq,
  row_number() over (partition by l_orderkey order by l_linenumber) > 1 as was_replay
from (select distinct l_orderkey, l_linenumber from lineitem) l""",
        "ledger_round_trip": """
select sha256(cast(o_orderkey as varchar)) as idempotency_key,
  case when o_orderstatus = 'F' then 'first' else 'second' end as status from orders""",
        "sources_read_back": _sql(
            """
select s.seq, s.company_id, s.revenue, s.zip_code, r.region, n.company_name as part_company
from submissions s left join risk r on r.company_id = s.company_id
left join names n on n.seq = s.seq and n.is_existing"""
        ),
        "rejects_split": _sql(f"select seq, {_VALID} as is_valid from decided", _CHECKED),
        "breaker_failure_runs": _sql(
            """
select dependency, seq, failure_run, failure_run >= 2 as threshold_reached from runs""",
            _RUNS,
        ),
        "breaker_states": _sql(states, _RUNS),
        "intake_results": whole_chain,
        "intake_with_ledger": _contexts(
            replay="t.idempotency_key is not null or f.seq <> f.first_seq",
            earlier="t.idempotency_key is not null",
        ),
        "intake_status_counts": whole_chain.replace(
            "select seq, idempotency_key, was_replay, status, company_id, triage_reason,",
            "select status, was_replay, count(*) as n from (select seq, was_replay, status,",
        )
        + ") x group by all",
        "intake_breaker": _met_circuit("dependency", "concat('risk-', cast(n.n_regionkey as varchar))", 2),
        "intake_circuit_open": _met_circuit("'risk'", "'risk'", 3),
        "intake_custom_stage": _contexts(
            audit=f"{audited},",
            dead=f"case when nameless then '' else {audited} end",
            known=False,
        ),
    }
    checks["idem_stored_ledger"] = checks["idem_with_ledger"]
    checks["stream_triage"] = checks["triage_decisions"]
    checks["stream_enrich"] = checks["enrich_lookup"]
    checks["stream_dedupe"] = _per_order(
        _sql("select distinct idempotency_key from keyed", *content)
    )
    checks["stream_idempotent"] = _per_order(checks["idem_first_delivery"])
    checks["stream_key_expiry"] = _per_order(_sql(_KEY_EXPIRY, *content, _CLAIMS))
    checks["stream_circuit"] = checks["breaker_states"]
    checks["stream_intake"] = _per_order(checks["intake_results"])
    return checks
