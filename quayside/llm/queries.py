"""Queries of the numbered operators, each over its whole table, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import WORD

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.substrings import find_repeats

    found = find_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.near_vectors import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from uuid import uuid4

    from quayside.llm.token_files import read_tokens, token_digest, write_tokens
    from quayside.session import shared_folder

    with open(tokenizer or tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        json_bytes = file.read()
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid4().hex}"
    write_tokens(_table(spark, sf_dir, "documents"), json_bytes, path)
    return token_digest(read_tokens(spark, path))


def op4_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.suffix_tree import score_documents

    return score_documents(_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm import html_text

    pages = _table(spark, sf_dir, "pages")
    found = html_text.extract_pages(pages.select("page_id", "url", "html"), html_text.fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    from quayside.llm.sentencepiece_fst import encode_documents, read_model

    model = read_model(model_path or tokenizer_path("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_documents(docs, model, ids_crc32="ids_crc32", round_trip="round_trip")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_fallback", "ids_crc32", "round_trip"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm import toxicity
    from quayside.llm.common import in_fold

    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.posting_lists import nearest

    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.simhash import simhash_groups

    groups = simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.mixing import mix_report, mix_sources

    report = mix_report(mix_sources(_table(spark, sf_dir, "documents")))
    return report.select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.whitening import fit_whitening, whiten

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", _scaled("embedding", 1024, 100_000))
    whitened = whiten(vectors, fit_whitening(vectors, "x"), "x")
    return whitened.select("_qs_row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.top_products import top_products

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", _scaled("embedding", 256))
    return top_products(vectors, F.col("vec_id") % 50 == 0, "vec_id", "x", k=5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.periodic_runs import find_runs

    docs = _table(spark, sf_dir, "documents").select("doc_id", _with_periodic_tail("doc_id", "text").alias("text"))
    found = find_runs(docs).select("_qs_row.doc_id", "runs", "kept_text")
    by_length = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    longest = found.withColumn("longest", F.array_min(by_length))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        (-F.col("longest.less")).alias("length"),
        "longest.period",
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def _scaled(vector: str, factor: int, offset: int = 0) -> Column:
    """Components as whole numbers floor(factor * x) + offset; null for a vector that is null, or holds a null
    or non-finite component or one whose whole number does not fit 62 bits."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(factor * x.cast("double")) < 2.0**62))
    whole = F.transform(vector, lambda x: F.floor(factor * x.cast("double")) + F.lit(offset))
    return F.when(usable, whole).alias("x")


def _with_periodic_tail(id_col: str, text_col: str) -> Column:
    """Texts of a tenth of the ids, chosen by crc32, become periodic from some word on; others stay as they
    are, as do texts without words and those of a null id."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        passage = F.slice(words, a + 1, p)
        tail = F.slice(F.flatten(F.array_repeat(passage, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    # A lambda's argument is computed once, however often it is used.
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)))[0]
    return F.when(h % 10 == 0, F.coalesce(changed, F.col(text_col))).otherwise(F.col(text_col))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_token_files": op3_token_files,
    "op4_suffix_tree_scores": op4_suffix_tree_scores,
    "op5_html_text": op5_html_text,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_toxicity": op7_toxicity,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_whitening": op11_whitening,
    "op12_top_products": op12_top_products,
    "op13_periodic_runs": op13_periodic_runs,
}

# The other numbered operators have no SQL: they use a hash, a tokenizer, a fitted model, a search or pseudorandom
# draws that DuckDB cannot repeat; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
),
windows as (
  select doc_id, s, array_to_string(ws[s:s + 19], ' ') as run
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as s from words) w
),
again as (
  select doc_id, s from windows
  qualify row_number() over (partition by run order by doc_id, s) > 1
),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from again),
placed as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from words),
kept as (
  select x.doc_id, string_agg(w, ' ' order by x.p) filter (g.p is null) as text, count(g.p) as n_removed
  from placed x left join gone g on g.doc_id = x.doc_id and g.p = x.p group by x.doc_id
)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from words w left join kept k on k.doc_id = w.doc_id
""",
    "op2_embedding_near_dedup": """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as x from embeddings
  where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0
),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= 0.93
),
reach(a, b) as (
  select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on l.a = r.b
)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links,
  min(r.b) as component_id, e.vec_id = min(r.b) as kept
from embeddings e join reach r on r.a = e.vec_id group by e.vec_id
""",
    "op12_top_products": """
with v as (
  select vec_id, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0
),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
""",
    "op13_periodic_runs": r"""
with bits as (
  -- crc32 bit by bit: the byte comes in with the first of its eight steps
  select doc_id, text, list_reduce(
    list_prepend(cast(4294967295 as bigint), flatten(list_transform(range(1, length(cast(doc_id as varchar)) + 1),
      lambda i: [cast(ascii(cast(doc_id as varchar)[i]) as bigint), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) as c
  from documents
),
hashed as (
  select doc_id, xor(c, 4294967295) as h, xor(c, 4294967295) // 10 as g,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from bits
),
shaped as (
  select *, len(ws) as n, case when len(ws) > 0 then g % len(ws) end as a,
    case when len(ws) > 0 then 1 + (len(ws) - g % len(ws)) // (3 + g % 8) end as p
  from hashed
),
words as (
  select doc_id, i, case when h % 10 = 0 and i >= a then ws[a + (i - a) % p + 1] else ws[i + 1] end as w
  from (select *, unnest(range(0, n)) as i from shaped) s
),
-- a run repeats six words or more at the distance of its period
grams as (
  select doc_id, i, w || ' ' || lead(w, 1) over d || ' ' || lead(w, 2) over d || ' ' || lead(w, 3) over d
    || ' ' || lead(w, 4) over d || ' ' || lead(w, 5) over d as gram
  from words window d as (partition by doc_id order by i)
),
again as (
  select x.doc_id, x.i, y.i - x.i as q from grams x join grams y on x.doc_id = y.doc_id and x.gram = y.gram and x.i < y.i
),
islands as (
  select doc_id, q, min(i) as start, max(i) - min(i) + 6 + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island from again) x
  group by doc_id, q, island
),
runs as (
  select doc_id, start, length, min(q) as period from islands
  where length >= 12 and length >= 2 * q group by doc_id, start, length
),
per_doc as (
  select doc_id, count(*) as n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by doc_id
),
longest as (
  select * from runs qualify row_number() over (partition by doc_id order by length desc, start, period) = 1
),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select x.doc_id, string_agg(w, ' ' order by x.i) as text
  from words x left join gone g on g.doc_id = x.doc_id and g.i = x.i where g.i is null group by x.doc_id
)
select d.doc_id, coalesce(n_runs, 0) as n_runs, l.start, l.length, l.period, 1000 * l.length // l.period as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from documents d left join per_doc p on p.doc_id = d.doc_id left join longest l on l.doc_id = d.doc_id
left join kept k on k.doc_id = d.doc_id
""",
}
