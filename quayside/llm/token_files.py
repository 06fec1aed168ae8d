"""Token ids in Parquet files made for selective reads.

Documents are range-partitioned and sorted by id, tokenised where they lie, and written as one list column of
ids beside small columns of metadata. Row groups are limited in size, pages have an index, ids are
dictionary or delta encoded, so a reader can take counts without ids or a range of documents without the rest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import binary_array, give_back, n_partitions, process_memory, texts_of

END_ID = 0
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# Pieces of text that a worker remembers at least, and twice as many at most (some 40 bytes each); bytes of the longest.
REMEMBERED = 200_000
LONGEST = 48
# Bytes of text cut into pieces at a time.
_CUT_BYTES = 8 << 20
_SPACE, _WHITE, _LETTER, _DIGIT, _MARK, _HARD = range(6)


def _byte_kinds() -> np.ndarray:
    """What a byte is to the pre-tokenizer. Bytes of U+00C0 to U+01FF are letters (save two signs, see ``_kinds``);
    whatever else is not ASCII, and control characters, are hard: the library itself has to tell."""
    kinds = np.full(256, _HARD, np.uint8)
    kinds[0x21:0x7F] = _MARK
    kinds[0x30:0x3A] = _DIGIT
    kinds[0x41:0x5B] = kinds[0x61:0x7B] = _LETTER
    kinds[0x80:0xC0] = kinds[0xC3:0xC8] = _LETTER
    kinds[0x09:0x0E] = _WHITE
    kinds[0x20] = _SPACE
    return kinds


_KINDS = _byte_kinds()
_SHORT_FORMS = np.isin(np.arange(256), list(b"stmdrvl"))


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kinds of all bytes: the two signs among the letters (multiplied and divided) are hard, and so is an apostrophe
    that may begin a short form such as 's, which is a pre-token of its own."""
    kinds = _KINDS[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    kinds[at[(data[at + 1] == 0x97) | (data[at + 1] == 0xB7)]] = _HARD
    at = np.flatnonzero(data[:-1] == 0x27)
    kinds[at[_SHORT_FORMS[data[at + 1]]]] = _HARD
    return kinds


def _cuts(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of the texts begin, whose ids in turn are those of the texts, and which may be more than a pre-token.

    Most pieces are pre-tokens: letters, digits or marks with a space before them; of white space all but the last
    character, which is a piece of its own unless it is a space before another piece, or all of it at the
    end of a text. What stands from one space to the next is one piece if it holds a hard byte: no pre-token goes on
    over a space that has no white space on one of its sides. Texts with hard bytes where both sides of a space may
    be white, and those marked ``whole``, are one piece.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    kinds = _kinds(data)
    given = np.diff(offsets) > 0
    begin, end = offsets[:-1][given], offsets[1:][given]
    white = kinds <= _WHITE
    cut = np.empty(len(data), bool)
    cut[1:] = kinds[1:] != kinds[:-1]
    # A space belongs to what follows it; other white space ends where something else begins.
    cut[1:] &= ~white[1:] & (kinds[:-1] != _SPACE) | ~white[:-1]
    last = white.copy()
    last[:-1] &= ~white[1:]
    last[end - 1] = False
    last[1:] &= white[:-1]
    cut |= last
    cut[begin] = True
    hard = np.flatnonzero(kinds == _HARD)
    spans = [(begin[whole[given]], end[whole[given]])]
    if len(hard):
        doubtful = white | (kinds == _HARD)
        inside = np.flatnonzero((kinds[1:-1] == _SPACE) & doubtful[:-2] & doubtful[2:]) + 1
        of_hard = np.unique(np.searchsorted(begin, hard, "right") - 1)
        of_inside = np.unique(np.searchsorted(begin, inside, "right") - 1)
        both = np.intersect1d(of_hard, of_inside)
        spans.append((begin[both], end[both]))
        runs = np.union1d(np.flatnonzero(kinds == _SPACE), begin)
        held = np.unique(np.searchsorted(runs, hard, "right") - 1)
        spans.append((runs[held], np.append(runs, len(data))[held + 1]))
    longer = np.zeros(len(data), bool)
    if any(len(first) for first, _ in spans):
        change = np.zeros(len(data) + 1, np.int32)
        for first, upto in spans:
            longer[first] = True
            np.add.at(change, first + 1, 1)
            np.subtract.at(change, upto, 1)
        cut &= np.cumsum(change[:-1]) <= 0
    cuts = np.flatnonzero(cut)
    return cuts, longer[cuts]


class DocumentTokenizer:
    """Ids of whole texts with the tokenizers library, which encodes every piece of text (see ``_cuts``) that is not
    remembered; a worker remembers from one task to the next. Texts that hold an added token such as an end mark are given to the library whole, as are all
    texts of a tokenizer that is not plain byte-level BPE.
    """

    def __init__(self, json_text: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one thread
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(json_text)
        # The same model for what is one pre-token already.
        self.pre_tokens = Tokenizer.from_str(json_text)
        self.pre_tokens.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spec = json.loads(json_text)
        before = spec.get("pre_tokenizer") or {}
        self.by_pieces = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space", False)
        )
        # Strings that are one token wherever they stand: their texts are encoded whole.
        self.added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        self.forget()

    def forget(self) -> None:
        """Empty the memory: pieces, their ids, and the number of the call that last needed each."""
        self.known = self.known_ids = pa.array([], pa.large_binary())
        self.needed = np.zeros(0, np.int64)
        self.calls = 0

    @staticmethod
    def _encoded(library, texts: list[str]) -> pa.Array:
        """Ids of each text as the bytes of unsigned 32-bit integers."""
        ids = [f.ids for f in library.encode_batch_fast(texts, add_special_tokens=False)]
        ends = 4 * np.cumsum([0, *map(len, ids)])
        flat = np.fromiter(chain.from_iterable(ids), np.uint32)
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(flat)])

    def _remembered(self, pieces: pa.Array, longer: np.ndarray) -> pa.Array:
        """Ids of distinct pieces, from memory where they are in it."""
        at = pc.index_in(pieces, value_set=self.known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        self.calls += 1
        self.needed[at[~new]] = self.calls
        missing, parts, held = [], [self.known_ids], len(self.known)
        for some, library in ((new & ~longer, self.pre_tokens), (new & longer, self.library)):
            some = np.flatnonzero(some)
            missing.append(pieces.take(pa.array(some)))
            parts.append(self._encoded(library, missing[-1].cast(pa.large_string()).to_pylist()))
            at[some] = held + np.arange(len(some))
            held += len(some)
        ids = pa.concat_arrays(parts)
        out = ids.take(pa.array(at))
        known = pa.concat_arrays([self.known, *missing])
        needed = np.append(self.needed, np.full(len(known) - len(self.known), self.calls))
        stays = np.flatnonzero(pc.binary_length(known).to_numpy() <= LONGEST)
        if len(stays) > 2 * REMEMBERED:
            stays = stays[np.argsort(-needed[stays], kind="stable")[:REMEMBERED]]
        if len(stays) < len(known):
            known, ids, needed = known.take(pa.array(stays)), ids.take(pa.array(stays)), needed[stays]
        self.known, self.known_ids, self.needed = known, ids, needed
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column's texts after one another, and how many each text has, without end ids."""
        if not self.by_pieces:
            ids, upto = texts_of(self._encoded(self.library, [t or "" for t in texts.to_pylist()]))
            return ids.view("<u4"), np.diff(upto // 4)
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        data, offsets = texts_of(texts)
        cuts, longer = _cuts(data, offsets, whole)
        pieces = binary_array(data, np.append(cuts, len(data))).cast(pa.large_binary()).dictionary_encode()
        which = pieces.indices.to_numpy()
        longer_of = np.zeros(len(pieces.dictionary), bool)
        longer_of[which[longer]] = True
        ids, upto = texts_of(self._remembered(pieces.dictionary, longer_of).take(pieces.indices))
        return ids.view("<u4"), np.diff(upto[np.searchsorted(cuts, offsets)] // 4)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without an end id."""
        ids, sizes = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        return [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def tokenizer_of(json_bytes: bytes) -> DocumentTokenizer:
    """The tokenizer of this process, with what it remembers."""
    made, key = process_memory("tokenizers"), hashlib.sha256(json_bytes).digest()
    if key not in made:
        made.clear()
        made[key] = DocumentTokenizer(json_bytes.decode())
    return made[key]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with about so much text as is cut at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + _CUT_BYTES, "right"))
        yield batch.slice(at, max(upto, at + 1) - at)
        at = max(upto, at + 1)


def write_tokens(
    docs: DataFrame,
    tokenizer_json: bytes,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Write (doc_id, part, begin, n_tokens, ids) under ``path``, in ascending order of doc_id within and across
    parts. ``begin`` is the number of ids before the document in its part; every document ends with
    ``end_id``; null and empty texts have just that. Rows that repeat an id follow one another in the order
    of their texts; null ids come first. An empty table makes files without rows.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer_of(held.value)
        begin = 0
        for batch in batches:
            for part in _parts(batch):
                found, sizes = machine.encode_column(part.column(1))
                ends = np.cumsum(sizes)
                bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                flat = np.insert(found.view(np.int32), ends, np.uint32(end_id).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(begin + bounds[:-1]), pa.array(sizes + 1),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))],
                    names=["doc_id", "part", "begin", "n_tokens", "ids"],
                )
                begin += int(bounds[-1])
        give_back()

    ordered = (
        docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
        .repartitionByRange(n_partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )
    coded = ordered.select("doc_id", "text", "part").mapInArrow(
        run, "doc_id long, part int, begin long, n_tokens long, ids array<int>"
    )
    (
        coded.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) without touching the ids: start counts the ids of all documents before it.
    Parts are summed first; only their sums, one row each, are put in order together."""
    rows = spark.read.parquet(path).select("doc_id", "part", "begin", "n_tokens")
    return _with_start(rows).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids), of a range of ids if given; the bounds reach the scan, where row
    groups and pages outside are skipped."""
    rows = spark.read.parquet(path)
    rows = _with_start(rows)
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    return rows.select("doc_id", "start", "n_tokens", "ids")


def _with_start(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("begin"))


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("long")
    def crc(ids: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.ascontiguousarray(x, dtype="<u4")) for x in ids], dtype="int64")

    return tokens.select("doc_id", "start", "n_tokens", crc("ids").alias("ids_crc32"))
