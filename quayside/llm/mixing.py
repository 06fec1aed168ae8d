"""Mixing sources to target weights with blocks of words and pseudorandom permutations.

The documents of a source, in the order of their ids, form one stream of words that is cut into blocks of
fixed length. Each output shard draws its numbers of blocks per source from a multinomial distribution.
The slots a source gets, numbered through all shards, run through a pseudorandom permutation of its block
numbers, a new one each time all blocks have been used, and slots meet blocks in a join by number.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import ROW, checkpointed, n_partitions, packed, range_cuts, range_of, word_count
from quayside.llm.wordhash import mix

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_TIMES = 2.0
BLOCK_WORDS = 256
SHARD_SLOTS = 8192
# The driver and every task hold one row per source; more are refused, not dropped.
MAX_SOURCES = 100_000
SEED = 20_240_501
_ROUNDS = 24
_U = np.uint64
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 chosen by ``key``: a swap-or-not shuffle. Each round pairs x
    with (r - x) mod n and swaps the pair or not, by a hash of its larger member."""
    x = index.astype(_U)
    n = n.astype(_U)
    with np.errstate(over="ignore"):
        for step in range(_ROUNDS):
            salt = mix(key.astype(_U) + _U((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            partner = (salt % n + n - x) % n
            bit = mix(np.maximum(x, partner) ^ mix(salt + _U(1))) & _U(1)
            x = np.where(bit == 1, partner, x)
    return x.astype(np.int64)


def _keys(source: np.ndarray, epoch: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(source.astype(_U) * _U(1_000_003) + epoch.astype(_U) + _U(seed))


@dataclass(frozen=True)
class SourceShare:
    """What the mix takes of one source. ``blocks`` are in its stream, ``slots`` are taken; the last
    slot gives ``last_take`` words of its block at most."""

    source: str | None
    size: int
    target: float
    blocks: int
    slots: int
    last_take: int


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_TIMES) -> list[float]:
    """``share`` of all sizes by weight; a target above ``most`` times its size stops there and the
    excess is shared anew by weight among the others until none is above."""
    total = share * sum(sizes)
    stopped = [False] * len(sizes)
    while True:
        free = sum(w for w, s in zip(weights, stopped, strict=True) if not s)
        left = total - sum(most * z for z, s in zip(sizes, stopped, strict=True) if s)
        each = left / free if free else 0.0
        above = [not s and each * w > most * z for w, z, s in zip(weights, sizes, stopped, strict=True)]
        if not any(above):
            return [most * z if s else each * w for w, z, s in zip(weights, sizes, stopped, strict=True)]
        stopped = [s or a for s, a in zip(stopped, above, strict=True)]


def _share(number: int, source: str | None, size: int, target: float, block: int, seed: int) -> SourceShare:
    blocks = -(-size // block)
    wanted = min(math.floor(target + 1e-9), 2 * size)
    if wanted <= 0:
        return SourceShare(source, size, target, blocks, 0, 0)
    epochs, rest = divmod(wanted, size)
    if rest == 0:
        return SourceShare(source, size, target, blocks, epochs * blocks, block)
    # Only the last block of a stream may be short: find how many slots reach ``rest`` words.
    short = block - (size - (blocks - 1) * block)
    at = 0
    if short:
        index = np.arange(blocks)
        key = _keys(np.array([number]), np.array([epochs]), seed)
        for part in np.array_split(index, max(1, blocks // 1_000_000)):
            hit = np.flatnonzero(permute(part, np.full(len(part), blocks), np.repeat(key, len(part))) == blocks - 1)
            if len(hit):
                at = int(part[hit[0]])
                break
    slots = -(-rest // block)
    if short and at < slots and slots * block - short < rest:
        slots += 1
    before = (slots - 1) * block - (short if short and at < slots - 1 else 0)
    return SourceShare(source, size, target, blocks, epochs * blocks + slots, rest - before)


@dataclass(frozen=True)
class Mix:
    """``sizes``: one row per document (doc_id, copy, source, size, number of its source, first word in
    the stream). ``pieces``: (shard, slot, doc_id, copy, epoch, start, words): what each slot takes of which document."""

    sizes: DataFrame
    shares: list[SourceShare]
    pieces: DataFrame


def _copy_number(doc_id: str, source: str, text: str):
    """Rows that repeat a doc_id are told apart by their number in the order of a hash."""
    return F.row_number().over(Window.partitionBy(doc_id).orderBy(F.xxhash64(source, text)))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    block: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """Plan of a mix. Sources are ranked by code point, null last, and weigh ``weights`` in turn.

    Shards draw multinomial numbers of blocks; what a source is drawn too often is
    left out at the end, what it lacks is added in shards of their own, so each source gives its
    target rounded down to whole words. No block is used more than twice. Everything is a function of
    the documents and ``seed``. Null and empty texts have size 0 and give nothing; an empty table gives an
    empty mix. Repeated rows count each.
    """
    spark = docs.sparkSession
    tasks = n_partitions(spark)
    measured = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[source_col].cast("string").alias("source"),
        word_count(docs[text_col]).alias("size"),
        F.xxhash64(docs[source_col], docs[text_col]).alias("h"),
    )
    measured = checkpointed(measured)
    totals = (
        measured.groupBy("source").agg(F.sum("size").alias("size"))
        .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = [int(r["size"]) for r in totals]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    shares = [
        _share(i, r["source"], z, t, block, seed)
        for i, (r, z, t) in enumerate(zip(totals, sizes, wanted, strict=True))
    ]
    known = spark.createDataFrame(
        [(i, s.source, s.size, float(s.target)) for i, s in enumerate(shares)],
        "number int, name string, source_size long, target double",
    )
    # Streams: sums per (source, range of ids) first, so that no task sees a whole source.
    cuts = range_cuts(measured, "doc_id", 8 * tasks)
    ranged = (
        measured.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("h")))
        .withColumn("part", range_of(F.col("doc_id"), cuts))
        .join(F.broadcast(known), F.col("source").eqNullSafe(F.col("name")))
        .select("doc_id", "copy", "source", "size", "part", "number", "source_size", "target")
    )
    ranged = checkpointed(ranged)
    before = ranged.groupBy("number", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("number", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("number", "part").orderBy("doc_id", "copy").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        ranged.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(before, ["number", "part"])
        .select("doc_id", "copy", "source", "size", "number", "source_size", "target",
                (F.col("base") + F.col("inner")).alias("first"))
    )
    spread = (
        placed.filter("size > 0")
        .withColumn("index", F.explode(F.sequence(
            F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))))
        .withColumn("lo", F.greatest("first", F.col("index") * block))
        .withColumn("hi", F.least(F.col("first") + F.col("size"), (F.col("index") + 1) * block))
        .select("number", "index", "doc_id", "copy", (F.col("lo") - F.col("first")).alias("start"),
                (F.col("lo") - F.col("index") * block).alias("from"), (F.col("hi") - F.col("lo")).alias("n"))
    )
    taken = F.least("n", F.col("take") - F.col("from"))
    pieces = (
        _slots(spark, shares, block, shard_slots, seed, tasks)
        .join(spread, ["number", "index"])
        .withColumn("words", taken)
        .filter("words > 0")
        .select("shard", "slot", "doc_id", "copy", "epoch", "start", "words")
    )
    return Mix(placed, shares, pieces)


_SLOT = "shard long, slot long, number int, epoch int, index long, take long"


def _slots(spark, shares: list[SourceShare], block: int, shard_slots: int, seed: int, tasks: int) -> DataFrame:
    """All slots of the mix. Shards are dealt over tasks; each draws its own numbers."""
    counts = np.array([s.slots for s in shares], dtype=np.int64)
    blocks = np.array([s.blocks for s in shares], dtype=np.int64)
    last = np.array([s.last_take for s in shares], dtype=np.int64)
    total = int(counts.sum())
    shards = -(-total // shard_slots)
    chance = counts / total if total else np.ones(max(1, len(counts))) / max(1, len(counts))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n = np.random.Generator(np.random.PCG64([seed, shard])).multinomial(shard_slots, chance)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), shard)), pa.array(some.astype(np.int32)), pa.array(n[some])],
                    names=["shard", "number", "n"],
                )

    draws = checkpointed(
        spark.range(0, shards, 1, max(1, min(tasks, shards))).mapInArrow(drawn, "shard long, number int, n long")
    )
    so_far = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = draws.withColumn("begin", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    # What the draws left short, in pieces of a shard's length.
    got = draws.groupBy("number").agg(F.sum("n").alias("got"))
    wanted = spark.createDataFrame(
        [(i, int(c)) for i, c in enumerate(counts) if c], "number int, wanted long"
    )
    lacking = (
        F.broadcast(wanted).join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0)))
        .filter("wanted > got")
        .withColumn("begin", F.explode(F.expr(f"sequence(got, wanted - 1, cast({shard_slots} as bigint))")))
        .select((F.lit(shards) + F.col("number")).cast("long").alias("shard"), "number",
                F.least(F.lit(shard_slots), F.col("wanted") - F.col("begin")).cast("long").alias("n"), "begin")
    )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, n, begin in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                k = np.arange(begin, min(begin + n, int(counts[number])))
                if not len(k):
                    continue
                epoch = k // blocks[number]
                source = np.full(len(k), number)
                index = permute(k % blocks[number], np.full(len(k), blocks[number]), _keys(source, epoch, seed))
                take = np.full(len(k), block, dtype=np.int64)
                take[k == counts[number] - 1] = last[number]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), shard)), pa.array(k), pa.array(source.astype(np.int32)),
                     pa.array(epoch.astype(np.int32)), pa.array(index), pa.array(take)],
                    names=["shard", "slot", "number", "epoch", "index", "take"],
                )

    return runs.select("shard", "number", "n", "begin").unionByName(lacking).mapInArrow(numbered, _SLOT)


def mix_report(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target of its source, and the words
    the mix takes of it, repeats counted."""
    taken = mixed.pieces.groupBy(F.col("doc_id").alias("id"), F.col("copy").alias("nth")).agg(F.sum("words").alias("taken"))
    met = mixed.sizes.join(taken, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("copy") == F.col("nth")), "left")
    return met.select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """``docs`` as the mix takes them: the text of a row becomes the words taken of it, in order, a second
    taking after the first, joined by one space. A document taken exactly once and whole keeps its
    text. Documents of which nothing is taken are not in the mix and go.
    """
    mixed = mix_sources(docs, id_col, text_col, source_col, **options)
    spans = mixed.pieces.groupBy("doc_id", "copy").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "start", "words"))).alias("spans")
    )
    spans = spans.select(F.col("doc_id").alias("_qs_id"), F.col("copy").alias("_qs_copy"), F.col("spans").alias("_qs_spans"))
    own = docs.select(
        packed(docs, text_col),
        docs[id_col].cast("long").alias("id"),
        docs[text_col].cast("string").alias("text"),
        _copy_number(id_col, source_col, text_col).alias("copy"),
    )
    met = own.join(spans, own["id"].eqNullSafe(spans["_qs_id"]) & (own["copy"] == spans["_qs_copy"]))

    def taken(texts, spans):
        import pandas as pd

        return pd.Series([_words_taken(t, s) for t, s in zip(texts, spans, strict=True)])

    take = F.pandas_udf(taken, "string")
    return met.select(
        *[
            take("text", "_qs_spans").alias(c) if c == text_col else F.col(f"{ROW}.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def _words_taken(text: str | None, spans) -> str:
    words = _WORDS.findall((text or "").encode())
    out: list[bytes] = []
    once_whole = len({s["epoch"] for s in spans}) == 1 and sum(s["words"] for s in spans) == len(words)
    if once_whole:
        return text
    for span in spans:
        out += words[span["start"] : span["start"] + span["words"]]
    return b" ".join(out).decode()
