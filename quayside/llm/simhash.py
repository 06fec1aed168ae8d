"""Near-duplicate documents by SimHash, found through deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. If two fingerprints differ in at most
4 bits, one segment differs in at most one, since 4 < 3 * 2. For each of its bits a segment is indexed with
that bit blanked: two segments that differ in at most one bit share at least one blanked form. Pairs
that share a form are found by an equality join (both sides land in one sorted group) and verified on
all 64 bits, so the search is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, checkpointed, give_back, group_bounds, n_partitions, packed, pairs_within, whole_groups
from quayside.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Widths of the segments, low bits first.
SEGMENTS = (21, 21, 22)
# Rows of one blanked form that a task compares at once; larger groups are cut into a grid.
CELL_ROWS = 8192
_BATCH = 255 * 256
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of ASCII-lower-cased words; see ``fingerprints``."""
    words = _WORDS.findall(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]  # noqa: B905
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BATCH):
        part = np.array(hashes[at : at + _BATCH], dtype="<u8")
        if len(part) % 255:
            part = np.append(part, np.zeros(-len(part) % 255, "<u8"))
        # One byte per bit, eight at a time as one integer: 255 of them add up without a carry.
        lanes = np.unpackbits(part.view(np.uint8), bitorder="little").view("<u8").reshape(-1, 255, 8)
        ones += lanes.sum(axis=1).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    set_bits = 2 * ones > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): SimHash of every whole text, one row per input row.

    Shingles of four words, repeats included; a shorter text is one shingle; null and empty
    texts have fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t or b"") for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )
        give_back()

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, fp long")


def _blanked() -> list[int]:
    """For each of the 64 bits: the mask of its segment without that bit, as signed 64-bit."""
    masks, low = [], 0
    for width in SEGMENTS:
        segment = ((1 << width) - 1) << low
        masks += [segment & ~(1 << bit) for bit in range(low, low + width)]
        low += width
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def _forest(fp: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the links among ``fp``: each member is compared with those not
    yet reached, so no list of all pairs is made."""
    left = np.arange(len(fp))
    while len(left):
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            at = frontier.pop()
            near = _links(fp[left], fp[at], max_bits)
            for other in left[near].tolist():
                yield root, other
                frontier.append(other)
            left = left[~near]


def _match(batches: Iterator[pa.RecordBatch], max_bits: int, cell_rows: int | None) -> Iterator[pa.RecordBatch]:
    """Edges of each group of rows with one (v, form, cell). A group above ``cell_rows`` is handed on as
    rows (v, form, node, fp) with a null b."""
    keys = ["v", "form", "cell"]
    for table in whole_groups(batches, keys):
        bounds = group_bounds(table, keys)
        node = table["node"].to_numpy()
        signed = table["fp"].to_numpy()
        fp = signed.view(np.uint64)
        sizes = np.diff(bounds)
        found: list[np.ndarray] = []
        small = (sizes > 1) & (sizes <= 8)
        if small.any():
            rows = np.flatnonzero(np.repeat(small, sizes))
            inner = np.concatenate([[0], np.cumsum(sizes[small])])
            for i, j in pairs_within(inner):
                i, j = rows[i], rows[j]
                near = _links(fp[i], fp[j], max_bits)
                found.append(np.stack([node[i[near]], node[j[near]]]))
        large = sizes > 8 if cell_rows is None else (sizes > 8) & (sizes <= cell_rows)
        for k in np.flatnonzero(large):
            s = bounds[k]
            pairs = np.array(list(_forest(fp[s : bounds[k + 1]], max_bits)), dtype=np.int64).reshape(-1, 2)
            found.append(node[s + pairs].T)
        edges = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=1)
        over = np.flatnonzero(np.repeat(sizes > cell_rows, sizes)) if cell_rows else np.zeros(0, np.int64)
        n, m = edges.shape[1], len(over)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([edges[0], node[over]])),
                pa.array(np.concatenate([edges[1], node[over]]), mask=np.arange(n + m) >= n),
                pa.array(np.concatenate([np.zeros(n, np.int64), signed[over]])),
                pa.array(np.concatenate([np.zeros(n, np.int32), table["v"].to_numpy()[over]])),
                pa.array(np.concatenate([np.zeros(n, np.int64), table["form"].to_numpy()[over]])),
            ],
            names=["a", "b", "fp", "v", "form"],
        )


_MATCHED = "a long, b long, fp long, v int, form long"


def near_fingerprints(nodes: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): edges between nodes of ``nodes`` (node, fp, with distinct fp) that connect exactly
    what is within ``max_bits`` of each other.

    A group of one blanked form above ``cell_rows`` goes through a second pass that cuts it into a grid
    of cells, each with the rows of two slots, so that no task compares more than that at once
    and no pair is missed.
    """
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find at most {2 * len(SEGMENTS) - 1} differing bits")
    n_tasks = n_partitions(nodes.sparkSession)
    masks = F.array(*[F.lit(m).cast("long") for m in _blanked()])
    formed = nodes.select("node", "fp", F.posexplode(masks).alias("v", "mask")).select(
        "node", "fp", F.col("v").cast("int").alias("v"), F.col("fp").bitwiseAND(F.col("mask")).alias("form"),
        F.lit(0).alias("cell"),
    )
    first = checkpointed(
        formed.repartition(n_tasks, "v", "form")
        .sortWithinPartitions("v", "form", "cell", "node")
        .mapInArrow(lambda batches: _match(batches, max_bits, cell_rows), _MATCHED)
    )
    over = first.filter("b is null").select(F.col("a").alias("node"), "fp", "v", "form")
    heavy = over.groupBy("v", "form").agg(F.ceil(F.count(F.lit(1)) / (cell_rows / 2)).cast("int").alias("slots"))
    celled = (
        over.join(heavy, ["v", "form"])
        .withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .withColumn("cell", F.least("slot", "other") * F.col("slots") + F.greatest("slot", "other"))
        .select("node", "fp", "v", "form", "cell")
    )
    second = (
        celled.repartition(n_tasks, "v", "form", "cell")
        .sortWithinPartitions("v", "form", "cell", "node")
        .mapInArrow(lambda batches: _match(batches, max_bits, None), _MATCHED)
    )
    return first.filter("b is not null").select("a", "b").unionByName(second.select("a", "b"))


def _linked(printed: DataFrame, max_bits: int) -> DataFrame:
    """(fp, group): the fingerprints of rows with an id, each with the smallest it can reach."""
    nodes = checkpointed(printed.filter("doc_id is not null").select("fp").distinct().withColumn("node", F.col("fp")))
    found = components(near_fingerprints(nodes, max_bits), "a", "b")
    return nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("group"))


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row.

    Equal fingerprints are one node; only nodes are compared. ``component_id`` is the smallest doc_id
    reachable through links of at most ``max_bits`` differing bits; that rows repeat a doc_id links nothing.
    A fingerprint that only rows with a null doc_id have is linked to nothing and
    its component_id is null. Repeated rows share a component. Empty input gives an empty table.
    """
    printed = checkpointed(fingerprints(docs, id_col, text_col))
    firsts = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    grouped = checkpointed(firsts.join(_linked(printed, max_bits), "fp", "left"))
    smallest = grouped.filter("group is not null").groupBy("group").agg(F.min("first").alias("component_id"))
    labelled = grouped.join(smallest, "group", "left").select("fp", "component_id")
    return printed.join(labelled, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the one with the smallest id and, of rows
    that repeat that id in the group, the one with the smallest text. Rows without id stay."""
    printed = checkpointed(fingerprints(docs, id_col, text_col).filter("doc_id is not null"))
    linked = checkpointed(_linked(printed, MAX_BITS))
    first = checkpointed(printed.join(linked, "fp").groupBy("group").agg(F.min("doc_id").alias("_qs_id")))
    again = checkpointed(printed.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_qs_id")))
    held = docs.select(
        packed(docs), docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")
    )
    row_id = F.col("id") == F.col("_qs_id")
    once = held.join(first.join(again, "_qs_id", "left_anti").select("_qs_id").distinct(), row_id, "left_semi")

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint((t or "").encode()) for t in texts], dtype=np.uint64).view(np.int64))

    # Rows of a repeated id are told apart by their own fingerprints; the smallest is a partial aggregate.
    several = first.join(again, "_qs_id", "left_semi")
    rows = (
        held.join(several.select("_qs_id").distinct(), row_id, "left_semi")
        .select(F.col("id").alias("_qs_id"), "text", ROW)
        .withColumn("fp", print_of("text"))
        .join(linked, "fp").join(several, ["group", "_qs_id"])
        .groupBy("group", "_qs_id").agg(F.min_by(ROW, F.struct("text")).alias(ROW))
        .select(f"{ROW}.*")
    )
    return once.select(f"{ROW}.*").unionByName(rows).unionByName(docs.filter(F.col(id_col).isNull()))
