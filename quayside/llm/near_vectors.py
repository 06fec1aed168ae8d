"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Vectors are normalised, so that a cosine of at least c is a distance of at most sqrt(2 - 2c). A table hashes
a vector to floor((A x + b) / w) with ``k`` Gaussian rows in A; vectors at that distance agree in one
row with a known probability, so the number of tables follows from the wanted recall. Equal vectors
are one class throughout. Vectors that agree in a table meet in one sorted group, where cosines
are computed in double precision from the given vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import checkpointed, group_bounds, n_partitions, pairs_within, whole_groups
from quayside.llm.components import components
from quayside.llm.vectors import dimension, matrix, usable
from quayside.llm.wordhash import mix

MIN_COSINE = 0.93
# Share of the pairs at exactly the least cosine that some table brings together; closer ones have more.
RECALL = 0.998
WIDTH = 2.0
SEED = 7
# Rows of one bucket that a task compares at once; larger buckets are cut into a grid.
CELL_ROWS = 4096


def agree_chance(distance: float, width: float) -> float:
    """Probability that two vectors at this distance fall in one cell of a random projection."""
    if distance <= 0:
        return 1.0
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class HashPlan:
    rows: int
    tables: int
    width: float


def plan_for(n: int, min_cosine: float = MIN_COSINE, recall: float = RECALL, width: float = WIDTH) -> HashPlan:
    """Rows per table so that unrelated vectors (at a right angle) rarely meet among ``n``, and tables
    for the recall."""
    near = agree_chance(math.sqrt(max(0.0, 2 - 2 * min_cosine)), width)
    far = agree_chance(math.sqrt(2), width)
    rows = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - near**rows)) if near < 1 else 1
    return HashPlan(rows, max(1, tables), width)


def _codes(unit: np.ndarray, plan: HashPlan, seed: int) -> np.ndarray:
    """One 32-bit code per vector and table."""
    draw = np.random.Generator(np.random.PCG64([seed, unit.shape[1], plan.rows, plan.tables]))
    a = draw.standard_normal((plan.tables * plan.rows, unit.shape[1]))
    b = draw.uniform(0, plan.width, plan.tables * plan.rows)
    cells = np.floor((unit @ a.T + b) / plan.width).astype(np.int64).reshape(len(unit), plan.tables, plan.rows)
    code = np.zeros((len(unit), plan.tables), np.uint64)
    with np.errstate(over="ignore"):
        for row in range(plan.rows):
            code = mix(code * np.uint64(31) + cells[:, :, row].astype(np.uint64) + np.uint64(row + 1))
    return (code >> np.uint64(32)).astype(np.uint32)


def _hashed(batches: Iterator[pa.RecordBatch], width: int, plan: HashPlan, seed: int) -> Iterator[pa.RecordBatch]:
    """A row per vector and table, with the codes of all tables."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            x = matrix(part["vector"], width)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            codes = _codes(unit, plan, seed)
            n, t = codes.shape
            rows = pa.array(np.repeat(np.arange(n), t))
            packed_codes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * t), n, [None, pa.py_buffer(np.ascontiguousarray(codes))])
            packed_x = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(4 * width if part["vector"].type.value_type == pa.float32() else 8 * width), n,
                [None, pa.py_buffer(np.ascontiguousarray(x, dtype=np.float32 if part["vector"].type.value_type == pa.float32() else np.float64))],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part["label"].take(rows),
                    pa.array(np.tile(np.arange(t, dtype=np.int32), n)),
                    pa.array(codes.reshape(-1).astype(np.int64)),
                    part["node"].take(rows),
                    part["n"].take(rows),
                    packed_x.cast(pa.binary()).take(rows),
                    packed_codes.cast(pa.binary()).take(rows),
                ],
                names=["label", "tab", "code", "node", "n", "x", "codes"],
            )


def _bytes_matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(dtype).reshape(len(values), -1)


def _linked(batches, keys: list[str], dtype, min_cosine: float, cell_rows: int | None) -> Iterator[pa.RecordBatch]:
    """For each bucket: the links found first in its table, as counts per node, and edges of a spanning forest.
    Rows of a bucket above ``cell_rows`` are handed on."""
    for table in whole_groups(batches, keys, 2_000):
        bounds = group_bounds(table, keys)
        sizes = np.diff(bounds)
        over = np.repeat(sizes > cell_rows, sizes) if cell_rows else np.zeros(table.num_rows, bool)
        use = np.repeat(sizes > 1, sizes) & ~over
        if use.any():
            rows = np.flatnonzero(use)
            part = table.take(pa.array(rows))
            x = _bytes_matrix(part["x"], dtype).astype(np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            codes = _bytes_matrix(part["codes"], np.uint32)
            node, n, tab = part["node"].to_numpy(), part["n"].to_numpy(), part["tab"].to_numpy()
            slot = part["slot"].to_numpy() if "slot" in part.column_names else None
            inner = np.concatenate([[0], np.cumsum(sizes[(sizes > 1) & (sizes <= (cell_rows or np.inf))])])
            links = np.zeros(len(rows), np.int64)
            edges: set[tuple[int, int]] = set()
            parent: dict[int, int] = {}
            for i, j in pairs_within(inner, 50_000):
                near = np.einsum("ij,ij->i", x[i], x[j]) >= min_cosine * norm[i] * norm[j]
                i, j = i[near], j[near]
                # A pair counts in the first table that brings it together.
                earlier = np.arange(codes.shape[1])[None, :] < tab[i][:, None]
                first = ~((codes[i] == codes[j]) & earlier).any(axis=1)
                if slot is not None:
                    # Two rows of one slot meet in all cells of that slot: only the diagonal one counts.
                    own = slot[i] != slot[j]
                    own |= (part["cell_a"].to_numpy()[i] == part["cell_b"].to_numpy()[i])
                    first &= own
                i, j = i[first], j[first]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                _forest(node[i], node[j], parent, edges)
            found = np.flatnonzero(links)
            e = np.array(sorted(edges), dtype=np.int64).reshape(-1, 2)
            a = np.concatenate([node[found], e[:, 0]])
            b = pa.array(np.concatenate([np.zeros(len(found), np.int64), e[:, 1]]), mask=np.arange(len(a)) < len(found))
            count = np.concatenate([links[found], np.zeros(len(e), np.int64)])
            yield _out(a, b, count, None)
        if over.any():
            yield _out(None, None, None, table.filter(pa.array(over)))


_LINKED = "a long, b long, links long, label int, tab int, code long, n long, x binary, codes binary"


def _forest(a: np.ndarray, b: np.ndarray, parent: dict[int, int], edges: set[tuple[int, int]]) -> None:
    """Adds the pairs that join two trees."""

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = up
        return v

    for u, v in zip(a.tolist(), b.tolist(), strict=True):
        ru, rv = root(u), root(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
            edges.add((min(u, v), max(u, v)))


def _out(a, b, count, rest: pa.Table | None) -> pa.RecordBatch:
    if rest is None:
        k = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), b, pa.array(count), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())],
            names=["a", "b", "links", "label", "tab", "code", "n", "x", "codes"],
        )
    k = rest.num_rows
    get = lambda c: rest[c].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [get("node"), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), get("label"), get("tab"), get("code"),
         get("n"), get("x"), get("codes")],
        names=["a", "b", "links", "label", "tab", "code", "n", "x", "codes"],
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    recall: float = RECALL,
    cell_rows: int = CELL_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors of the same label with a cosine of at
    least ``min_cosine`` that were found), component_id (smallest vec_id reachable) and kept.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null label or
    id, link with nothing. Rows with the same vector and label are one class: they link with each
    other, and all of them with what one of them links with; rows that repeat an id count as vectors of their
    own. All usable vectors must have one length. No pair below ``min_cosine`` is linked.
    """
    tasks = n_partitions(vectors.sparkSession)
    given = checkpointed(
        vectors.select(
            vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("int").alias("label"),
            vectors[vector_col].alias("vector"),
        ).withColumn("ok", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    )
    good = given.filter("ok")
    width = dimension(good, "vector")
    # A class has a number of its own: ids repeat, with unlike vectors too.
    classes = checkpointed(
        good.groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    plan = plan_for(most, min_cosine, recall)
    dtype = np.float32 if dict(given.dtypes)["vector"] == "array<float>" else np.float64
    keys = ["label", "tab", "code"]
    hashed = classes.repartition(tasks, "node").mapInArrow(
        lambda batches: _hashed(batches, width, plan, seed),
        "label int, tab int, code long, node long, n long, x binary, codes binary",
    )
    first = checkpointed(
        hashed.repartition(tasks, *keys).sortWithinPartitions(*keys, "node").mapInArrow(
            lambda batches: _linked(batches, keys, dtype, min_cosine, cell_rows), _LINKED
        )
    )
    over = first.filter("tab is not null").select(F.col("a").alias("node"), *keys, "n", "x", "codes")
    heavy = over.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / (cell_rows / 2)).cast("int").alias("slots"))
    cell = [*keys, "cell_a", "cell_b"]
    celled = (
        over.join(heavy, keys)
        .withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .withColumn("cell_a", F.least("slot", "other")).withColumn("cell_b", F.greatest("slot", "other"))
        .select(*cell, "slot", "node", "n", "x", "codes")
    )
    second = celled.repartition(tasks, *cell).sortWithinPartitions(*cell, "node").mapInArrow(
        lambda batches: _linked(batches, cell, dtype, min_cosine, None), _LINKED
    )
    found = checkpointed(first.filter("tab is null").unionByName(second).select("a", "b", "links"))
    links = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("b is not null").select("a", "b"), "a", "b")
    # The smallest node of a component has no row of its own there.
    grouped = (
        classes.join(links, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    )
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labelled = grouped.join(smallest, "component").select(
        "label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    met = given.join(labelled.withColumn("ok", F.lit(True)), ["label", "vector", "ok"], "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
