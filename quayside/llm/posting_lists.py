"""Approximate nearest neighbours by largest inner product, with balanced posting lists.

Centroids come from a bounded sample that is halved again and again at the median along the axis
between two means, so lists are of about equal size. A vector on a boundary is posted to several lists. Centroids
are searched through an in-memory graph of near neighbours; a query reads the lists whose centroid
is at most a given ratio farther away than the nearest. Vectors get one more component that makes all norms
equal, so that the nearest in distance has the largest inner product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import checkpointed, n_partitions
from quayside.llm.vectors import dimension, matrix, usable

K = 20
# Bounds of the fit: vectors that centroids are fitted on (the first by a hash of the id), and centroids.
SAMPLE_ROWS = 20_000
MAX_LISTS = 4096
LIST_ROWS = 800
REPLICAS = 4
REPLICA_RATIO = 1.10
# How many times as many lists a query reads that has found too little.
WIDER = 8
SEARCH_RATIO = 1.08
GRAPH_NEIGHBOURS = 16
# Rows of a list, and queries of a list, that one task handles at once.
PART_ROWS = 4000
PART_QUERIES = 2000
SEED = 11


@dataclass(frozen=True)
class CentroidGraph:
    centroids: np.ndarray
    neighbours: np.ndarray

    def within(self, point: np.ndarray, ratio: float, most: int | None = None) -> list[int]:
        """Centroids at most ``ratio`` times as far as the nearest one found, nearest first: a best-first
        walk that goes on while the nearest open centroid is that near."""
        n = len(self.centroids)
        entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))
        seen = np.zeros(n, bool)
        seen[entries] = True
        far = np.sqrt(((self.centroids[entries] - point) ** 2).sum(axis=1))
        open_ = [(float(d), int(i)) for d, i in zip(far, entries, strict=True)]
        heapq.heapify(open_)
        best = open_[0][0]
        reached: list[tuple[float, int]] = []
        spare = len(entries)
        while open_:
            d, at = heapq.heappop(open_)
            best = min(best, d)
            if d > ratio * best:
                spare -= 1
                if spare < 0:
                    break
            reached.append((d, at))
            new = np.unique(self.neighbours[at])
            new = new[~seen[new]]
            if len(new):
                seen[new] = True
                far = np.sqrt(((self.centroids[new] - point) ** 2).sum(axis=1))
                for e, i in zip(far.tolist(), new.tolist(), strict=True):
                    heapq.heappush(open_, (e, i))
        chosen = sorted((d, i) for d, i in reached if d <= ratio * best)
        return [i for _, i in chosen[:most]]


def fit_centroids(sample: np.ndarray, lists: int, seed: int = SEED) -> CentroidGraph:
    """Balanced halving of the sample into ``lists`` (a power of two) parts and the graph of their means."""
    rng = np.random.Generator(np.random.PCG64(seed))
    parts = [np.arange(len(sample))]
    for _ in range(int(math.log2(lists))):
        halved = []
        for part in parts:
            points = sample[part]
            means = points[rng.choice(len(points), 2, replace=len(points) < 2)]
            for _ in range(8):
                order = np.argsort(points @ (means[0] - means[1]), kind="stable")
                half = len(order) // 2
                means = np.stack([points[order[half:]].mean(axis=0), points[order[: max(half, 1)]].mean(axis=0)])
            halved += [part[order[half:]], part[order[: max(half, 1)]]]
        parts = halved
    centroids = np.stack([sample[p].mean(axis=0) for p in parts])
    n = len(centroids)
    near = np.argsort(((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2), axis=1) if n <= 256 else _near(centroids)
    # Siblings in the halving keep the graph connected.
    siblings = np.stack([np.arange(n) ^ (1 << b) for b in range(max(1, int(math.log2(n))))], axis=1) % n
    return CentroidGraph(centroids, np.concatenate([near[:, 1 : 1 + GRAPH_NEIGHBOURS], siblings], axis=1))


def _near(centroids: np.ndarray) -> np.ndarray:
    square = (centroids**2).sum(axis=1)
    out = np.empty((len(centroids), GRAPH_NEIGHBOURS + 1), np.int64)
    for at in range(0, len(centroids), 256):
        d = square[None, :] - 2 * centroids[at : at + 256] @ centroids.T
        out[at : at + 256] = np.argsort(d, axis=1)[:, : GRAPH_NEIGHBOURS + 1]
    return out


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _asked(x: np.ndarray, longest: float) -> np.ndarray:
    scaled = x * (longest / np.linalg.norm(x, axis=1, keepdims=True))
    return np.concatenate([scaled, np.zeros((len(x), 1))], axis=1)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    list_rows: int = LIST_ROWS,
    replicas: int = REPLICAS,
    replica_ratio: float = REPLICA_RATIO,
    search_ratio: float = SEARCH_RATIO,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest rows of ``vectors``
    found, its own id left out; all candidates if there are fewer. Equal scores go to the smaller vec_id. The
    score is the inner product in double precision.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null id, take no part.
    Equal vectors are one class with its k + 1 smallest ids (no other can be among the nearest). A
    repeated candidate id counts once; of a query id with several vectors the one first in order counts.
    All usable vectors must have one length.
    """
    spark = vectors.sparkSession
    tasks = n_partitions(spark)

    def clean(df: DataFrame) -> DataFrame:
        return df.select(df[id_col].cast("long").alias("id"), df[vector_col].alias("vector")).filter(
            F.col("id").isNotNull() & usable(F.col("vector"))
        )

    given = checkpointed(clean(vectors))
    width = dimension(given, "vector")
    # The k + 1 smallest ids of each class, first within salted parts of it.
    first = given.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(4 * tasks))).distinct()
    for part in (["vector", "salt"], ["vector"]):
        first = first.withColumn("nth", F.row_number().over(Window.partitionBy(*part).orderBy("id"))).filter(F.col("nth") <= k + 1)
    classes = checkpointed(
        first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("node", F.col("ids")[0])
    )
    n = classes.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    lists = min(MAX_LISTS, 1 << max(0, round(math.log2(max(1.0, n / list_rows)))))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    longest = math.sqrt(classes.agg(F.max(square)).first()[0])
    sample = classes.select("vector").orderBy(F.xxhash64("node"), "node").limit(sample_rows).toArrow()
    graph = fit_centroids(_lifted(matrix(sample["vector"], width), longest), lists, seed)

    def post(batches: Iterator[pa.RecordBatch], as_query: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            points = _asked(x, longest) if as_query else _lifted(x, longest)
            found = [
                graph.within(p, search_ratio) if as_query else graph.within(p, replica_ratio, replicas) for p in points
            ]
            rows = pa.array(np.repeat(np.arange(len(x)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array([i for f in found for i in f], pa.int32()),
                 pa.array([n for f in found for n in range(len(f))], pa.int32())],
                names=["id", "vector", "list", "nth"],
            )

    kind = dict(given.dtypes)["vector"]
    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector")).repartition(tasks, "id")
    posted = checkpointed(
        classes.select(F.col("node").alias("id"), "vector").repartition(tasks, "id")
        .mapInArrow(lambda b: post(b, False), f"id long, vector {kind}, list int, nth int")
    )
    wanted = checkpointed(asked.mapInArrow(lambda b: post(b, True), f"id long, vector {kind}, list int, nth int"))
    part_of = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    keys = ["list", "part", "q_part"]

    def scan(key, rows: pa.Table, asking: pa.Table) -> pa.Table:
        rows = rows.sort_by("id").combine_chunks()
        asking = asking.sort_by("id").combine_chunks()
        # Scores below what the nearest list has already given cannot be among the nearest.
        known = asking["least"].to_numpy(zero_copy_only=False)
        out_q, out_n, out_s = [], [], []
        if rows.num_rows and asking.num_rows:
            x, q = matrix(rows["vector"], width), matrix(asking["vector"], width)
            node, query = rows["id"].to_numpy(), asking["id"].to_numpy()
            keep = min(k + 1, len(x))
            for at in range(0, len(q), 256):
                scores = q[at : at + 256] @ x.T
                least = np.partition(scores, len(x) - keep, axis=1)[:, len(x) - keep]
                least = np.maximum(least, known[at : at + 256])
                i, j = np.nonzero(scores >= least[:, None] - 1e-9 * longest**2)
                out_q.append(query[at + i])
                out_n.append(node[j])
                out_s.append(np.einsum("ij,ij->i", q[at + i], x[j]))
        cat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        return pa.table({"query_id": cat(out_q, np.int64), "node": cat(out_n, np.int64), "score": cat(out_s, np.float64)})

    def sizes_of(wanted: DataFrame) -> DataFrame:
        # Long lists, and lists that many queries read, are cut into parts. There are MAX_LISTS lists at most.
        sizes = (
            posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
            .join(wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("q_parts")), "list")
        )
        return F.broadcast(checkpointed(sizes))

    def scanned(asking: DataFrame, sizes: DataFrame) -> DataFrame:
        left = posted.join(sizes, "list").withColumn("part", part_of("parts")).withColumn("q_part", every("q_parts"))
        left = left.select("list", "part", "q_part", "id", "vector")
        right = asking.join(sizes, "list").withColumn("q_part", part_of("q_parts")).withColumn("part", every("parts"))
        return (
            left.repartition(tasks, *keys).groupBy(*keys)
            .cogroup(right.select(*keys, "id", "vector", "least").repartition(tasks, *keys).groupBy(*keys))
            .applyInArrow(scan, "query_id long, node long, score double")
        )

    # The nearest list first: its scores bound what the other lists have to report.
    lowest = F.lit(float("-inf"))
    sizes = sizes_of(wanted)
    nearest_list = checkpointed(scanned(wanted.filter("nth = 0").withColumn("least", lowest), sizes))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"))
    bound = (
        nearest_list.withColumn("at", F.row_number().over(place)).filter(F.col("at") == k + 1)
        .select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    )
    others = wanted.filter("nth > 0").join(bound, "id", "left").withColumn("least", F.coalesce("least", lowest))
    scored = nearest_list.unionByName(scanned(others, sizes))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(scored: DataFrame) -> DataFrame:
        classes_found = (
            scored.groupBy("query_id", "node").agg(F.max("score").alias("score"))
            .withColumn("nth", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
            .filter(F.col("nth") <= k + 1)
        )
        return (
            classes_found.join(classes.select("node", "ids"), "node")
            .select("query_id", F.explode("ids").alias("vec_id"), "score")
            .filter("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )

    if lists == 1:
        return ranked(scored)

    def widen(batches: Iterator[pa.RecordBatch], reads: int) -> Iterator[pa.RecordBatch]:
        square = (graph.centroids**2).sum(axis=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                far = square[None, :] - 2 * _asked(matrix(part.column(1), width), longest) @ graph.centroids.T
                near = np.argsort(far, axis=1, kind="stable")[:, :reads]
                rows = pa.array(np.repeat(np.arange(part.num_rows), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(near.ravel().astype(np.int32))],
                    names=["id", "vector", "list"],
                )

    # Queries with fewer than k results read further lists, until they have k or have read all.
    found, reads, settled = checkpointed(ranked(scored)), 1, []
    asking = wanted.filter("nth = 0").select("id", "vector")
    while True:
        enough = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
        short = checkpointed(asking.join(enough, "id", "left_anti"))
        if reads == lists or short.isEmpty():
            break
        settled.append(found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti"))
        reads, asking = min(lists, WIDER * reads), short
        more = short.mapInArrow(lambda b, reads=reads: widen(b, reads), f"id long, vector {kind}, list int")
        before = wanted.join(short.select("id"), "id", "left_semi").select("id", "vector", "list")
        more = checkpointed(more.unionByName(before).dropDuplicates(["id", "list"]))
        found = checkpointed(ranked(scanned(more.withColumn("least", lowest), sizes_of(more))))
    for part in settled:
        found = found.unionByName(part)
    return found
