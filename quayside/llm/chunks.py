"""Chunks of documents, and question rounds between chunks and buckets of hashed keys.

A chunk holds whole documents, sent to its task once, as compressed Arrow data; later passes over it read the
same shuffle files. In a
round every chunk asks about the distinct keys of its documents, once each, however often they occur in
it. Keys are split over buckets by their leading bits, so each bucket sees every chunk that has a
key, settles it, and answers in the order asked. A key that a third of all documents hold costs
one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, binary_array, give_back, n_partitions, packed, range_cuts
from quayside.llm.wordhash import mix

CHUNK_BYTES = 2 << 20
# Chunks and buckets per partition: messages number chunks times buckets.
_MANY = 1
# Documents a task packs at a time.
_PACK_BYTES = 16 << 20
# kind 1: what a chunk passes on to its own next pass; other kinds: questions and their answers.
KEEP = 1
MESSAGE = "bucket int, chunk int, kind int, data binary, more binary"
_KEY_BITS = 40
# So many values make it worth to compress their first bytes, second bytes and so on apart.
_OWN_PART = 1024
_U32, _LOW_32 = np.uint64(32), np.uint64(0xFFFFFFFF)

Send = Callable[[int, pa.Table, dict], list[pa.RecordBatch]]
Settle = Callable[[pa.Table], pa.RecordBatch]
# Of a kind of messages the bytes of each value in both parts of a question, and of an answer; None: sent as it is.
Widths = tuple[tuple[int | None, int], tuple[int, int | None]]


class Chunks:
    """Documents by chunk, with the numbers of chunks, buckets and partitions."""

    def __init__(
        self, docs: DataFrame, id_col: str, text_col: str, ordered: bool, chunk_bytes: int = CHUNK_BYTES,
        widths: dict[int, Widths] | None = None,
    ):
        """``ordered``: chunks are ranges of ids, so that a smaller chunk holds smaller ids; null ids
        come last. Otherwise documents are dealt by a hash of their id. ``widths``: messages of these kinds are
        sent in fewer bytes, and the keys of their questions as differences."""
        spark = docs.sparkSession
        self.widths = widths or {}
        self.tasks = n_partitions(spark)
        given = docs.select(
            docs[id_col].cast("long").alias("doc_id"),
            docs[text_col].cast("string").alias("text"),
            packed(docs, text_col),
        )
        size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.row_type = given.schema[ROW].dataType.simpleString()
        n_chunks = self.chunks = max(_MANY * self.tasks, -(-size // chunk_bytes))
        self.buckets = _MANY * self.tasks
        cuts = range_cuts(given, "doc_id", self.chunks) if ordered else None

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size >= _PACK_BYTES:
                    yield _packed_by_chunk(held, n_chunks, cuts)
                    held, size = [], 0
            if held:
                yield _packed_by_chunk(held, n_chunks, cuts)
            held.clear()
            give_back()

        self.docs = given.mapInArrow(dealt, "chunk int, docs binary").repartition(self.tasks, "chunk")

    def first_round(self, send: Send) -> DataFrame:
        def run(key, table):
            chunk = key[0].as_py()
            out = shortened(pa.Table.from_batches(send(chunk, unpacked(table), {})), widths, 0)
            give_back()
            return out

        widths = self.widths
        return self.docs.groupBy("chunk").applyInArrow(run, MESSAGE)

    def next_round(self, answers: DataFrame | Sequence[DataFrame], send: Send, schema: str = MESSAGE) -> DataFrame:
        """``send`` gets the chunk, its documents and {kind: answers joined in the order asked, and how
        much of the second part each row brought}. Answers of several rounds, of unlike kinds, are each read from the
        shuffle that first brought them, so nothing has to be kept and sent again."""
        rounds = [answers] if isinstance(answers, DataFrame) else list(answers)
        given = reduce(DataFrame.unionAll, [a.repartition(self.tasks, "chunk") for a in rounds])

        widths = self.widths

        def run(key, docs, told):
            chunk = key[0].as_py()
            told = restored(told, widths)
            got = {}
            kinds = told["kind"].to_numpy()
            buckets = told["bucket"].to_numpy()
            for kind in np.unique(kinds):
                rows = np.flatnonzero(kinds == kind)
                rows = rows[np.argsort(buckets[rows], kind="stable")]
                part = told.take(pa.array(rows))
                got[int(kind)] = (joined(part["data"]), joined(part["more"]), lengths(part["more"]))
            out = pa.Table.from_batches(send(chunk, unpacked(docs), got))
            if schema == MESSAGE:
                out = shortened(out, widths, 0)
            give_back()
            return out

        return self.docs.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(run, schema)

    def settle(self, messages: DataFrame, settlers: dict[int, Settle]) -> DataFrame:
        """A settler gets the questions of its kind in one bucket, in the order of chunks, and returns
        their answers; what a chunk keeps for itself goes through unchanged."""

        widths = self.widths

        def run(key, table):
            table = restored(table.combine_chunks(), widths)
            kinds = table["kind"].to_numpy()
            out = [table.filter(pa.array(kinds == KEEP))]
            for kind, settler in settlers.items():
                asked = table.filter(pa.array(kinds == kind))
                if asked.num_rows:
                    order = np.argsort(asked["chunk"].to_numpy(), kind="stable")
                    out.append(pa.Table.from_batches([settler(asked.take(pa.array(order)))]).cast(out[0].schema))
            return shortened(pa.concat_tables(out), widths, 1)

        return messages.repartition(self.tasks, "bucket").groupBy("bucket").applyInArrow(run, MESSAGE)


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _short(value: bytes, width: int, keys: bool) -> bytes:
    """Values of ``width`` bytes, their first bytes before their second ones and so on, compressed, of many values each
    by itself. Of ``keys``, which are in order, the differences: a byte or two less for each."""
    if not value:
        return b""
    flat = np.frombuffer(value, np.uint8)
    if keys:
        flat, width = np.diff(widen(flat, width), prepend=np.uint64(0)).view(np.uint8), 8
    planes = np.ascontiguousarray(flat.reshape(-1, width).T)
    parts = [_codec().compress(p, asbytes=True) for p in planes.reshape(_n_parts(planes.shape[1], width), -1)]
    return np.array([len(flat), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _n_parts(n: int, width: int) -> int:
    return width if n >= _OWN_PART else 1


def _full(value: bytes, width: int, keys: bool) -> bytes:
    if not value:
        return b""
    size, wide = int.from_bytes(value[:4], "little"), 8 if keys else width
    n_parts = _n_parts(size // wide, wide)
    at = 4 + 4 * n_parts
    parts = []
    for n in np.frombuffer(value, "<u4", n_parts, 4).tolist():
        parts.append(np.frombuffer(_codec().decompress(value[at : at + n], size // n_parts), np.uint8))
        at += n
    flat = np.ascontiguousarray(np.concatenate(parts).reshape(wide, -1).T)
    return narrow(np.cumsum(flat.view("<u8").reshape(-1), dtype=np.uint64), width).tobytes() if keys else flat.tobytes()


def _recoded(table: pa.Table, widths: dict[int, Widths], answer: np.ndarray, code: Callable) -> pa.Table:
    if not widths or not table.num_rows:
        return table
    sizes = [widths[k][a] if k in widths else None for k, a in zip(table["kind"].to_pylist(), answer, strict=True)]
    for part, name in enumerate(("data", "more")):
        values = zip(table[name].to_pylist(), sizes, answer, strict=True)
        made = [v if w is None or w[part] is None else code(v, w[part], part == 0 and not a) for v, w, a in values]
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(made, pa.binary()))
    return table


def shortened(table: pa.Table, widths: dict[int, Widths], answer: int) -> pa.Table:
    """Messages in fewer bytes: questions, or with ``answer`` 1 answers, whose kinds are negative on the way."""
    table = _recoded(table, widths, np.full(table.num_rows, answer), _short)
    if not widths or not answer:
        return table
    kinds = table["kind"].to_numpy()
    kinds = np.where(np.isin(kinds, list(widths)), -kinds, kinds).astype(np.int32)
    return table.set_column(table.schema.get_field_index("kind"), "kind", pa.array(kinds))


def restored(table: pa.Table, widths: dict[int, Widths]) -> pa.Table:
    """Messages as they were before ``shortened``."""
    if not widths:
        return table
    kinds = table["kind"].to_numpy()
    table = table.set_column(table.schema.get_field_index("kind"), "kind", pa.array(np.abs(kinds).astype(np.int32)))
    return _recoded(table, widths, (kinds < 0).astype(int), _full)


def packed_numbers(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**32 - 1, each in about as many bits as it has: their lengths, compressed, and all bits
    after the first one of each number plus one."""
    v = values.astype(np.uint64) + np.uint64(1)
    size = np.frexp(v.astype(np.float64))[1] - 1
    if len(size) and size.max() > 32:
        raise ValueError("numbers to pack must be below 2**32")
    lens = _codec().compress(size.astype(np.uint8), asbytes=True) if len(size) else b""
    end = np.cumsum(size, dtype=np.int64)
    at, size = end - size, size.astype(np.uint64)
    word = at >> 5
    bits = (v ^ (np.uint64(1) << size)) << (at & 31).astype(np.uint64)
    n_words = (int(end[-1]) + 31) // 32 if len(end) else 0
    out = np.zeros(n_words + 2, np.uint64)
    if len(v):
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        out[word[begin]] += np.add.reduceat(bits & _LOW_32, begin)
        out[word[begin] + 1] += np.add.reduceat(bits >> _U32, begin)
    head = np.array([len(v), len(lens)], "<u4")
    return head.tobytes() + lens + out[:n_words].astype("<u4").tobytes()


def unpacked_numbers(data: bytes | np.ndarray) -> list[np.ndarray]:
    """The numbers of each ``packed_numbers`` value in ``data``, which holds any number of them."""
    data, out, at = bytes(data), [], 0
    while at < len(data):
        n, n_lens = np.frombuffer(data, "<u4", 2, at).tolist()
        at += 8
        lens = _codec().decompress(data[at : at + n_lens], n) if n else b""
        at += n_lens
        size = np.frombuffer(lens, np.uint8)
        begin = np.cumsum(size, dtype=np.int64) - size
        n_words = (int(begin[-1]) + int(size[-1]) + 31) // 32 if n else 0
        words = np.zeros(n_words + 2, np.uint64)
        words[:n_words] = np.frombuffer(data, "<u4", n_words, at)
        at += 4 * n_words
        word, size = begin >> 5, size.astype(np.uint64)
        bits = (words[word] | (words[word + 1] << _U32)) >> (begin & 31).astype(np.uint64)
        one = np.uint64(1) << size
        out.append((bits & (one - np.uint64(1))) + one - np.uint64(1))
    return out


def bucket_bounds(n_buckets: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted ``hashes`` fall in, and where each begins and the last ends."""
    if not len(hashes):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    at = ((hashes >> np.uint64(40)) * np.uint64(n_buckets)) >> np.uint64(24)
    begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[begin].astype(np.int32), np.append(begin, len(hashes))


def questions(
    n_buckets: int, chunk: int, hashes: np.ndarray, data: np.ndarray, more: np.ndarray | None = None,
    kind: int = 0, to_all: bool = False,
) -> pa.RecordBatch:
    """Messages about sorted ``hashes``: ``data`` and ``more`` are byte matrices with one row per hash.
    ``to_all`` sends one to every bucket, even without a question."""
    buckets, bounds = bucket_bounds(n_buckets, hashes)
    if to_all:
        counts = np.zeros(n_buckets, np.int64)
        counts[buckets] = np.diff(bounds)
        buckets, bounds = np.arange(n_buckets, dtype=np.int32), np.concatenate([[0], np.cumsum(counts)])
    more = np.zeros((len(data), 0), np.uint8) if more is None else more
    return message_rows(buckets, chunk, kind, cut(data, bounds), cut(more, bounds))


def cut(rows: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of a matrix as one value for each range of its rows."""
    return binary_array(np.ascontiguousarray(rows).reshape(-1), bounds * rows.shape[1])


def message_rows(buckets: np.ndarray, chunk: int, kind: int, data: pa.Array, more: pa.Array) -> pa.RecordBatch:
    """One message of a chunk to each of ``buckets``."""
    n = len(buckets)
    ints = [pa.array(v) for v in (buckets.astype(np.int32), np.full(n, chunk, np.int32), np.full(n, kind, np.int32))]
    return pa.RecordBatch.from_arrays([*ints, data, more], names=["bucket", "chunk", "kind", "data", "more"])


def keep(n_buckets: int, chunk: int, data: bytes) -> pa.RecordBatch:
    """What the chunk passes on to its own next pass, by way of some bucket."""
    ints = [pa.array([v], pa.int32()) for v in (chunk % n_buckets, chunk, KEEP)]
    return pa.RecordBatch.from_arrays(
        [*ints, pa.array([data], pa.binary()), pa.array([b""], pa.binary())],
        names=["bucket", "chunk", "kind", "data", "more"],
    )


def _packed_by_chunk(batches: list[pa.RecordBatch], n_chunks: int, cuts: np.ndarray | None) -> pa.RecordBatch:
    """One value of compressed Arrow data per chunk that has documents among ``batches``."""
    table = pa.Table.from_batches(batches).combine_chunks()
    missing = table["doc_id"].is_null().to_numpy()
    ids = pc.fill_null(table["doc_id"], 0).to_numpy()
    if cuts is None:
        chunk = (mix(ids.astype(np.uint64)) % np.uint64(n_chunks)).astype(np.int32)
    else:
        chunk = np.where(missing, len(cuts), np.searchsorted(cuts, ids, "left")).astype(np.int32)
    order = np.argsort(chunk, kind="stable")
    table = table.take(pa.array(order))
    chunk = chunk[order]
    begin = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, np.int64)
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    values = []
    for s, e in zip(begin, np.append(begin[1:], len(chunk)), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table.slice(s, e - s))
        values.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(chunk[begin]), pa.array(values, pa.binary())], names=["chunk", "docs"])


def unpacked(rows: pa.Table) -> pa.Table:
    """The documents of a chunk in order."""
    parts = [pa.ipc.open_stream(value.as_buffer()).read_all() for value in rows["docs"]]
    return in_order(pa.concat_tables(parts))


def in_order(docs: pa.Table) -> pa.Table:
    """Documents by (id, text), null ids last: the same order in each pass."""
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


def joined(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all values after one another."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


def lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.binary_length(column).to_numpy().astype(np.int64)


def narrow(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of unsigned 64-bit values, as a byte matrix."""
    return np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def widen(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8").reshape(-1)


def answers(asked: pa.Table, data: np.ndarray, more: np.ndarray | None, per_row: np.ndarray) -> pa.RecordBatch:
    """One answer row per question row; ``per_row`` is the number of keys in each."""
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    flat = np.ascontiguousarray(data).reshape(-1)
    width = data.shape[1] if data.ndim == 2 else 1
    more_bytes = np.zeros(0, np.uint8) if more is None else np.ascontiguousarray(more).reshape(-1)
    more_width = 0 if more is None else more.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            asked["bucket"].combine_chunks(),
            asked["chunk"].combine_chunks(),
            asked["kind"].combine_chunks(),
            binary_array(flat, bounds * width),
            binary_array(more_bytes, bounds * more_width),
        ],
        names=["bucket", "chunk", "kind", "data", "more"],
    )
