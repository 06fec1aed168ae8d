"""Input feeds derived from the base tables.

Each feed is one SELECT that Spark and DuckDB both understand, so the checks of a query can
start from exactly the same rows. Dirty values (blank ids, unreadable amounts, missing names) are
spread over the rows by their keys; no feed leaves out rows to become smaller.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.skew import n_tasks

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# In dependency order: a feed may use the ones above it.
FEEDS = {
    "submissions": """
select k as seq,
  case when k % 97 = 0 then '   ' else concat('C-', cast(k as string)) end as company_id,
  case when k % 53 = 0 then null else c_name end as company_name,
  case when k % 29 = 0 then 'not-a-number'
       when k % 4 = 1 then concat('$', cast(rev as string), '.00')
       when k % 4 = 2 and rev >= 1000 then concat(' $',
         cast(cast(floor(rev / 1000) as bigint) as string), ',',
         lpad(cast(rev % 1000 as string), 3, '0'))
       else cast(rev as string) end as revenue,
  case c_mktsegment
       when 'BUILDING' then 'construction'
       when 'MACHINERY' then
         case when k % 4 = 0 then 'weapons manufacturing' else ' e-commerce ' end
       when 'HOUSEHOLD' then case when k % 5 = 0 then 'GAMBLING' else 'food & drink' end
       when 'FURNITURE' then 'retail'
       else 'auto parts' end as industry,
  case when n < 4 then 'ny' when n < 6 then 'new york' when n = 6 then ' NY '
       when n < 13 then 'FL' else 'ca' end as state,
  case when k % 31 = 0 then null
       else concat('1000', cast(n % 10 as string), '-', cast(k as string)) end as zip_code,
  case when k % 41 = 0 then 'HB-17' end as broker_id
from (select c_custkey as k, c_name, c_mktsegment, c_nationkey as n,
        cast(round(c_acctbal * 100) as bigint)
          * case when c_custkey % 10 = 0 then 1000 else 1 end as rev
      from customer) b
""",
    # One delivery per order; orders of a customer differ in received_at only.
    "order_deliveries": """
select o.o_orderkey as seq, s.seq as submission_seq, o.o_orderdate as received_at,
  concat('{"company_id":"', s.company_id, '",',
    case when s.company_name is null then ''
         else concat('"company_name":"', s.company_name, '",') end,
    '"revenue":',
    case when s.seq % 4 in (0, 3) and s.seq % 29 <> 0 then s.revenue
         else concat('"', s.revenue, '"') end,
    ',"industry":"', s.industry, '","state":"', s.state,
    '","received_at":"', cast(o.o_orderdate as string), '"}') as payload
from orders o join submissions s on s.seq = o.o_custkey
""",
    # At-least-once input: every (order, line) delivers the order once more, byte by byte.
    "deliveries": """
select l.l_orderkey * 10 + l.l_linenumber as seq, l.l_orderkey as order_seq,
  o.submission_seq, o.received_at, o.payload
from (select distinct l_orderkey, l_linenumber from lineitem) l
join order_deliveries o on o.seq = l.l_orderkey
""",
    # Model responses: the lines of an order are the attempts for one text.
    "responses": """
select d.order_seq as seq, cast(d.seq % 10 as int) as attempt,
  case (d.order_seq + 3 * (d.seq % 10)) % 7
    when 0 then 'I cannot extract that.'
    when 1 then concat('```json', chr(10), j, chr(10), '```')
    when 2 then concat(j, ' trailing')
    when 3 then concat('{"company_name":"', coalesce(s.company_name, ''), '","revenue":"',
      cast(s.seq % 90 as string), '.5M","industry":null,"state":"ny"}')
    when 4 then concat('{"company_name":"A","revenue":5,"industry":"Retail","state":"ca",',
      '"zip_code":', cast(10000 + s.seq % 90 as string), '}')
    else j end as raw
from deliveries d
join (select *, concat('{"company_name":"', coalesce(company_name, ''), '","revenue":"',
        revenue, '","industry":"', industry, '","state":"', state, '","zip_code":null}') as j
      from submissions) s
  on s.seq = d.submission_seq
""",
    "names": """
select p_partkey as seq, concat('P-', cast(p_partkey as string)) as company_id,
  concat(
    case when p_partkey % 5 = 0
         then concat(upper(split_part(p_name, ' ', 2)), ' ', split_part(p_name, ' ', 1))
         else p_name end,
    case when p_partkey % 11 = 0 then 'x' else '' end, ' ', lower(p_type), ' ', p_brand,
    case p_partkey % 6 when 0 then ' Inc.' when 1 then ', LLC' when 2 then ' Group'
         when 3 then ' S.A.' when 4 then ' Holdings Ltd' else '' end) as company_name,
  case when p_partkey % 37 = 0 then null
       else concat(cast(10000 + p_size as string), '-', cast(p_partkey as string)) end
    as zip_code,
  p_partkey % 2 = 0 as is_existing
from part
""",
    "api_attempts": """
select concat('R-', cast(l_orderkey as string)) as company_id, l_linenumber as attempt,
  case cast((l_orderkey * 7 + l_linenumber * 13) % 10 as int)
    when 0 then 503 when 1 then 503 when 2 then 500 when 3 then 429 when 4 then 404
    else 200 end as status_code
from (select distinct l_orderkey, l_linenumber from lineitem) l
""",
    "risk": """
select concat('C-', cast(c_custkey as string)) as company_id,
  case when c_mktsegment = 'FURNITURE' then null else c_custkey % 100 end as risk_score,
  n_name as region
from customer join nation on n_nationkey = c_nationkey
where c_acctbal >= 0
""",
    "known_companies": """
select distinct s.company_id
from submissions s join orders o on o.o_custkey = s.seq
where o.o_orderstatus = 'F' and o.o_orderpriority = '1-URGENT'
""",
    # Calls of the risk API of a region: every order line stands for one, some time after its order.
    "api_outcomes": """
select l.l_orderkey * 10 + l.l_linenumber as seq, concat('risk-', cast(n.n_regionkey as string)) as dependency,
  o.o_orderdate + interval '1' minute * cast(l.l_linenumber * 200 + l.l_orderkey % 200 as int) as ts,
  l.l_returnflag <> 'R' as ok
from (select l_orderkey, l_linenumber, max(l_returnflag) as l_returnflag from lineitem group by l_orderkey, l_linenumber) l
join orders o on o.o_orderkey = l.l_orderkey
join customer c on c.c_custkey = o.o_custkey
join nation n on n.n_nationkey = c.c_nationkey
""",
    "outcomes": """
select user_id as dependency, event_id as seq, ts, event_type <> 'error' as ok from events
""",
}


def with_feeds(query: str) -> str:
    """``query`` preceded by the definitions of all feeds."""
    parts = [f"{name} as ({sql.strip()})" for name, sql in FEEDS.items()]
    return "with " + ",\n".join(parts) + "\n" + query


@lru_cache(maxsize=256)
def _read(spark: SparkSession, path: str) -> DataFrame:
    """Reading the footer and listing files takes a job; once per session and file is enough."""
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = BASE_TABLES) -> None:
    """Register base tables as temporary views."""
    for name in names:
        _read(spark, f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


# The base tables behind each feed.
_USES = {
    "submissions": ("customer",),
    "order_deliveries": ("customer", "orders"),
    "deliveries": ("customer", "orders", "lineitem"),
    "responses": ("customer", "orders", "lineitem"),
    "names": ("part",),
    "api_attempts": ("lineitem",),
    "risk": ("customer", "nation"),
    "known_companies": ("customer", "orders"),
    "api_outcomes": ("customer", "orders", "lineitem", "nation"),
    "outcomes": ("events",),
}


# Feeds whose rows hold JSON to parse.
_COSTLY = ("order_deliveries", "deliveries", "responses")
# Feeds with a row per order line, joined to its order.
_BY_ORDER = ("deliveries", "api_outcomes")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One feed as a DataFrame over the tables in ``sf_dir``."""
    load_tables(spark, sf_dir, _USES[name])
    needed = list(FEEDS)[: list(FEEDS).index(name) + 1]
    parts = [f"{n} as ({FEEDS[n].strip()})" for n in needed if set(_USES[n]) <= set(_USES[name])]
    query = "with " + ",\n".join(parts) + f"\nselect * from {name}"
    if name not in _BY_ORDER:
        return _spread(spark.sql(query), name)
    # Order lines are dealt by order once, before anything is joined to them: to make them distinct and to join takes no
    # other shuffle, and the rows that come out, texts included, are spread already.
    lines = _read(spark, f"{sf_dir}/lineitem.parquet").repartition(_feed_tasks(spark), "l_orderkey").hint("merge")
    lines.createOrReplaceTempView("lineitem_by_order")
    return spark.sql(query.replace("from lineitem", "from lineitem_by_order"))


def _spread(rows: DataFrame, name: str) -> DataFrame:
    if name not in _COSTLY:
        return rows
    return rows.repartition(_feed_tasks(rows.sparkSession), "seq")


def _feed_tasks(spark: SparkSession) -> int:
    # A table may be one file and one task; the parsing that follows can use all cores, a few tasks for each so
    # that none waits for long. As many as the session's shuffle partitions, so a task need not grow with the table.
    return max(3 * spark.sparkContext.defaultParallelism, n_tasks(spark))


def streamed_feed(spark: SparkSession, sf_dir: str, name: str, table: str) -> DataFrame:
    """The same feed with one of its base tables read as a stream of files."""
    load_tables(spark, sf_dir, _USES[name])
    path = f"{sf_dir}/{table}.parquet"
    # A pattern, because a stream source takes no path of a single file.
    pattern = f"{sf_dir}/{table}.parq*"
    stream = spark.readStream.schema(_read(spark, path).schema).parquet(pattern)
    stream.createOrReplaceTempView(f"{table}_stream")
    parts = []
    for needed in list(FEEDS)[: list(FEEDS).index(name) + 1]:
        sql = FEEDS[needed].strip()
        if set(_USES[needed]) <= set(_USES[name]):
            if table in _USES[needed]:
                sql = sql.replace(f"from {table}", f"from {table}_stream")
            parts.append(f"{needed} as ({sql})")
    return _spread(spark.sql("with " + ",\n".join(parts) + f"\nselect * from {name}"), name)
