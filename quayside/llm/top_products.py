"""Exact top k by inner product of whole-number vectors, by norm-sorted pruning (after LEMP and FEXIPRO).

Candidates are range-partitioned into blocks of falling length. A query starts with the k-th best product among
the longest vectors of all; a product is at most the product of the two lengths (Cauchy-Schwarz), so a query goes
only to the blocks that can reach its bound. In a block candidates are processed in falling order of
length, until no query can be reached any more. Both sides are turned by the singular vectors of all rows, which move
most of a vector's length into its first components: the partial product over these, and the
product of the two lengths left over, bound the whole one. What passes is multiplied exactly, in whole numbers.

Blocks and groups of queries form a grid of cells, each of bounded size; a cell's result is at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import checkpointed, give_back, n_partitions
from quayside.llm.vectors import padded, summed, triangle

# Bounds of a cell: candidates of a block (on average) and queries of a group; candidates looked at together.
BLOCK_ROWS = 100_000
GROUP_ROWS = 4096
STEP_ROWS = 1024
# The longest vectors of all, which give every query its first bound.
PROBES = 4096
# Shares of the components after which a partial product is held against the bound.
STAGES = (0.25, 0.5)
# Part of the two lengths' product that rounding of the turned components may amount to, generously.
_SLACK = 1e-9
_EXACT = 2.0**53
RESULT = "query_id {id}, rank int, vec_id {id}, score bigint"


class Best:
    """The k best candidates of each query so far, and the product a further one must reach."""

    def __init__(self, bounds: np.ndarray, k: int):
        self.k = k
        self.bounds = bounds.astype(np.float64).copy()
        self.query, self.score, self.place = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, place: np.ndarray, order: np.ndarray) -> None:
        """``order`` ranks all candidates by id, so that ties go to the smaller one."""
        self.query = np.concatenate([self.query, query])
        self.score = np.concatenate([self.score, score])
        self.place = np.concatenate([self.place, place])
        by = np.lexsort((order[self.place], -self.score, self.query))
        sorted_query = self.query[by]
        begin = np.searchsorted(sorted_query, sorted_query)
        rank = np.arange(len(by)) - begin
        by = by[rank < self.k]
        self.query, self.score, self.place = self.query[by], self.score[by], self.place[by]
        full = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        at = self.query[full]
        self.bounds[at] = np.maximum(self.bounds[at], self.score[full])


def exact_products(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of the pairs (i, j) in 64-bit whole numbers, some rows at a time."""
    out = np.empty(len(i), np.int64)
    step = max(1, (1 << 21) // max(1, q.shape[1]))
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        out[part] = (q[i[part]] * c[j[part]]).sum(axis=1)
    return out


def best_in_block(
    q: np.ndarray, q_row: np.ndarray, bounds: np.ndarray, c: np.ndarray, c_row: np.ndarray, c_order: np.ndarray,
    axes: np.ndarray, k: int,
) -> Best:
    """All of the queries' k best among the candidates, given in falling length, that reach ``bounds``."""
    best = Best(bounds, k)
    width = q.shape[1]
    stages = sorted({max(1, int(width * s)) for s in STAGES})
    q_far = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    turned_q = q.astype(np.float64) @ axes
    rest_q = [np.sqrt((turned_q[:, h:] ** 2).sum(axis=1)) for h in stages]
    whole_q = q.astype(np.float64)
    for at in range(0, len(c), STEP_ROWS):
        part = c[at : at + STEP_ROWS].astype(np.float64)
        c_far = np.sqrt((part**2).sum(axis=1))
        reach = q_far * c_far[0] * (1 + _SLACK)
        near = np.flatnonzero(reach >= best.bounds)
        if not len(near):
            break
        turned = part @ axes
        h = stages[0]
        rest = np.sqrt((turned[:, h:] ** 2).sum(axis=1))
        partial = turned_q[near, :h] @ turned[:, :h].T
        upper = partial + np.outer(rest_q[0][near], rest) + _SLACK * np.outer(q_far[near], c_far)
        i, j = np.nonzero(upper >= best.bounds[near, None])
        if len(i) > upper.size // 4 and q_far.max() * c_far[0] < _EXACT / 2:
            # So many pass that a product of whole matrices, exact below 2^53, costs less than picking.
            whole = whole_q[near] @ part.T
            i, j = np.nonzero(whole >= best.bounds[near, None])
            score = whole[i, j].astype(np.int64)
            i = near[i]
        else:
            partial = partial[i, j]
            i = near[i]
            for s, h in enumerate(stages[1:], 1):
                before = stages[s - 1]
                partial = partial + np.einsum("nd,nd->n", turned_q[i, before:h], turned[j, before:h])
                rest = np.sqrt((turned[:, h:] ** 2).sum(axis=1))
                upper = partial + rest_q[s][i] * rest[j] + _SLACK * q_far[i] * c_far[j]
                ok = upper >= best.bounds[i]
                i, j, partial = i[ok], j[ok], partial[ok]
            score = exact_products(q, c[at : at + STEP_ROWS], i, j)
        own = c_row[at + j] == q_row[i]
        i, j, score = i[~own], j[~own], score[~own]
        best.add(i, score, at + j, c_order)
    return best


def _ordered_ids(column: pa.ChunkedArray) -> np.ndarray:
    """Rank of every id among those of the column; null ids come last."""
    order = pc.sort_indices(column, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def top_products(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", x_col: str = "x", k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query with all rows but its own;
    ties go to the smaller id, a null id last.

    ``x_col`` is an array of whole numbers, null for a row that takes no part; nor does a vector whose squared
    length does not fit 62 bits. A shorter vector counts as if zeros followed. Rows are told apart as rows:
    of rows that repeat an id each is a candidate, also of the others, and a query of its own. A row whose
    id makes ``is_query`` null is no query. Only the three columns named are read, so others may have
    any name. Without queries or candidates the result is empty.
    """
    spark = vectors.sparkSession
    far = F.aggregate("x", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double"))
    given = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(x_col).cast("array<bigint>").alias("x"),
    ).filter(F.col("x").isNotNull()).withColumn("far", F.sqrt(far)).filter(F.col("far") < 2.0**31)
    n_rows, width = given.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = RESULT.format(id=id_type)
    if not n_rows:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    n_blocks = max(n_partitions(spark), -(-n_rows // BLOCK_ROWS))
    # Equal lengths are dealt by a hash of the row, so that many of them do not make one large block.
    dealt = given.repartitionByRange(n_blocks, F.desc("far"), F.xxhash64("row"))
    rows = checkpointed(dealt.withColumn("block", F.spark_partition_id()))
    axes = _singular_axes(rows, width)
    tops = [0.0] * n_blocks
    for block, top in rows.groupBy("block").agg(F.max("far")).collect():
        tops[block] = top
    tops = np.maximum.accumulate(np.array(tops)[::-1])[::-1]
    probes = rows.orderBy(F.desc("far"), "row").limit(PROBES).select("row", "x").toArrow()
    asked = checkpointed(_with_bounds(rows.filter("asks").select("row", "id", "x"), probes, tops, width, k))
    groups = asked.groupBy("group").agg(F.max("last").alias("last")).collect()
    last_of = [-1] * (max((r["group"] for r in groups), default=-1) + 1)
    for r in groups:
        last_of[r["group"]] = r["last"]
    if not last_of:
        return spark.createDataFrame([], schema)
    lasts = F.array(*[F.lit(v) for v in last_of])
    wanted = F.filter(F.sequence(F.lit(0), F.lit(len(last_of) - 1)), lambda g: F.get(lasts, g) >= F.col("block"))
    candidates = rows.select("block", "row", "id", "x", "far", F.explode(wanted).alias("group"))
    questions = asked.select(
        "row", F.col("id").alias("query_id"), "x", "bound", "group", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block")
    )

    def cell(key: tuple, ask: pa.Table, have: pa.Table) -> pa.Table:
        if ask.num_rows and have.num_rows:
            have = have.sort_by([("far", "descending"), ("row", "ascending")]).combine_chunks()
            ask = ask.combine_chunks()
            best = best_in_block(
                padded(ask["x"], width), ask["row"].to_numpy(), ask["bound"].to_numpy(), padded(have["x"], width),
                have["row"].to_numpy(), _ordered_ids(have["id"]), axes, k,
            )
            i, j, score = best.query, best.place, best.score
        else:
            i = j = score = np.zeros(0, np.int64)
        give_back()
        return pa.table(
            {
                "row": ask["row"].take(pa.array(i)), "query_id": ask["query_id"].take(pa.array(i)),
                "vec_id": have["id"].take(pa.array(j)), "score": pa.array(score),
            }
        )

    keys = ["block", "group"]
    found = questions.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        cell, f"row bigint, query_id {id_type}, vec_id {id_type}, score bigint"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _singular_axes(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, by falling singular value: a square as wide as the vectors."""

    def squares(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return (x.T @ x)[np.triu_indices(width)]

    gram = triangle(summed(rows, "x", width, squares, "double"), width, np.float64)
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _with_bounds(queries: DataFrame, probes: pa.Table, tops: np.ndarray, width: int, k: int) -> DataFrame:
    """Each query with ``bound``, the k-th best product among the probes (minus infinity if there are fewer),
    ``last``, the last block that can reach it, and ``group``."""
    probe_rows, probe_x = probes["row"].to_numpy(), padded(probes["x"], width)
    n_groups = -(-queries.count() // GROUP_ROWS) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, row = padded(batch.column("x"), width), batch.column("row").to_numpy()
            bound = np.full(len(q), -np.inf)
            for at in range(0, len(q), 256):
                part = slice(at, at + 256)
                # Rounded products serve as bounds less what they may be off by.
                score = q[part].astype(np.float64) @ probe_x.astype(np.float64).T
                score[row[part, None] == probe_rows[None, :]] = -np.inf
                if score.shape[1] >= k:
                    bound[part] = -np.partition(-score, k - 1, axis=1)[:, k - 1]
            far = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
            bound -= _SLACK * far * tops[0]
            # A query of length zero has the product 0 with all.
            least = np.where(far > 0, bound / np.maximum(far * (1 + _SLACK), 1e-300), -np.inf)
            last = np.maximum(np.searchsorted(-tops, -least, "right") - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bound), pa.array(last.astype(np.int32))],
                names=["row", "id", "x", "bound", "last"],
            )
        give_back()

    id_type = queries.schema["id"].dataType.simpleString()
    found = queries.mapInArrow(run, f"row bigint, id {id_type}, x array<bigint>, bound double, last int")
    return found.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int"))
