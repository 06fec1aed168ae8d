"""Exact repeats of word sequences over a whole corpus, by fixed-block anchors.

A repeat of at least ``window`` words holds, in its earlier place, a whole block of ``window // 2`` words
that starts at a multiple of that length. Blocks that do not overlap are the index; every rolling
window of that length probes it. Hits are extended: of the full windows around hits, known by
a second, wider hash, all but the earliest occurrence are repeats, and runs of them form maximal repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.chunks import KEEP, Chunks, answers, joined, keep, lengths, narrow, questions, widen
from quayside.llm.common import ROW, texts_of
from quayside.llm.wordhash import Words, windows

WINDOW_WORDS = 20
_KEY = 5  # bytes of a key besides its bucket; two bits of a probe's key are flags


def _probes(words: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of all rolling blocks within documents, their flags, the positions of the
    rolling blocks, and which distinct hash each has."""
    values = words.hashes(0)
    rolling = windows(values, block, 0)
    whole = np.flatnonzero(words.doc[: len(rolling)] == words.doc[block - 1 :]) if len(rolling) else np.zeros(0, np.int64)
    distinct, which, count = np.unique(rolling[whole], return_inverse=True, return_counts=True)
    flags = (count > 1).astype(np.uint64)
    aligned = (whole - words.first[words.doc[whole]]) % block == 0
    flags[which[aligned]] |= np.uint64(2)
    return distinct, flags, whole, which


def _settle_probes(asked: pa.Table) -> pa.RecordBatch:
    """A probe hits if its key occurs at a second place and begins a block at one of them."""
    keys = widen(joined(asked["data"]), _KEY)
    order = np.argsort(keys >> np.uint64(2), kind="stable")
    value = keys[order] >> np.uint64(2)
    begin = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(value)))
    flags = np.bitwise_or.reduceat(keys[order] & np.uint64(3), begin) if len(value) else keys
    hit = ((size > 1) | (flags & np.uint64(1)).astype(bool)) & (flags & np.uint64(2)).astype(bool)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(hit, size)
    return answers(asked, out.reshape(-1, 1), None, lengths(asked["data"]) // _KEY)


def _candidates(words: Words, window: int, block: int, whole: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Starts of the full windows inside documents that contain a block which was hit."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hits = np.zeros(len(words) + 1, np.int64)
    hits[whole[hit] + 1] = 1
    total = np.cumsum(hits)
    inner = window - block + 1
    some = total[inner : inner + n] > total[:n]
    return np.flatnonzero(some & (words.doc[:n] == words.doc[window - 1 :]))


def _window_groups(words: Words, window: int, starts: np.ndarray):
    """Distinct windows among ``starts`` as two hashes each, the group of each start, and which starts
    are the first of their group."""
    a = windows(words.hashes(0), window, 0)[starts]
    b = windows(words.hashes(1), window, 1)[starts] >> np.uint64(32)
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    return a[order[new]], b[order[new]], group, first


def _settle_windows(asked: pa.Table) -> pa.RecordBatch:
    """Answers 1 where a smaller chunk has the window too; questions come in the order of chunks."""
    a = widen(joined(asked["data"]), _KEY)
    b = widen(joined(asked["more"]), 4)
    per_row = lengths(asked["data"]) // _KEY
    order = np.lexsort((b, a))  # stable: the smallest chunk of a group comes first
    later = np.zeros(len(a), np.uint8)
    if len(a):
        later[order[1:]] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    return answers(asked, later.reshape(-1, 1), None, per_row)


def find_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """One row per document: all columns of ``docs`` but the text as struct ``_qs_row``, doc_id, text
    , n_words, n_removed, ``spans`` (maximal runs of removed words as start and length) and
    kept_text (the words left, joined by one space).

    A word is removed if a window of ``window`` words around it has a word sequence that also starts
    earlier: in a smaller doc_id or earlier in the same document. Rows with equal ids count in the order of their
    texts, equal rows after one another; null ids come last. Documents shorter than a window keep
    all words; null and empty texts have none. Keys are hashes of 45 bits and more for probes, which only
    choose candidates, and 79 bits and more for windows.
    """
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    block = window // 2
    chunks = Chunks(docs, id_col, text_col, ordered=True)
    buckets = chunks.buckets

    def probe(chunk, table, _):
        words = Words(*texts_of(table["text"]))
        distinct, flags, _, _ = _probes(words, block)
        keys = (distinct << np.uint64(2)) | flags
        return [questions(buckets, chunk, distinct, narrow(keys, _KEY))]

    def extend(chunk, table, got):
        words = Words(*texts_of(table["text"]))
        distinct, _, whole, which = _probes(words, block)
        hit = got[0][0].astype(bool) if 0 in got else np.zeros(len(distinct), bool)
        starts = _candidates(words, window, block, whole, hit[which])
        a, b, _, _ = _window_groups(words, window, starts)
        mask = np.zeros(len(words), bool)
        mask[starts] = True
        return [
            questions(buckets, chunk, a, narrow(a, _KEY), narrow(b, 4)),
            keep(buckets, chunk, np.packbits(mask).tobytes()),
        ]

    def cut(chunk, table, got):
        words = Words(*texts_of(table["text"]))
        starts = np.zeros(0, np.int64)
        if KEEP in got:
            starts = np.flatnonzero(np.unpackbits(got[KEEP][0], count=len(words)))
        removed = np.zeros(len(words) + 1, np.int64)
        if len(starts):
            _, _, group, first = _window_groups(words, window, starts)
            again = starts[~first | got[0][0].astype(bool)[group]]
            np.add.at(removed, again, 1)
            np.subtract.at(removed, again + window, 1)
        gone = np.cumsum(removed)[:-1] > 0
        return [_result(table, words, gone)]

    schema = (
        f"{ROW} {chunks.row_type}, doc_id long, text string, n_words long, n_removed long, "
        "spans array<struct<start:int,length:int>>, kept_text string"
    )
    probes = chunks.first_round(probe)
    hits = chunks.settle(probes, {0: _settle_probes})
    asked = chunks.next_round(hits, extend)
    told = chunks.settle(asked, {0: _settle_windows})
    return chunks.next_round(told, cut, schema)


def _result(table: pa.Table, words: Words, gone: np.ndarray) -> pa.RecordBatch:
    n_docs = table.num_rows
    n_words = np.diff(words.first)
    total = np.concatenate([[0], np.cumsum(gone)])
    n_removed = total[words.first[1:]] - total[words.first[:-1]]
    # Runs of removed words within documents.
    before = np.append(False, gone[:-1]) if len(gone) else gone
    head = np.zeros(len(gone) + 1, bool)
    head[words.first] = True
    open_ = np.flatnonzero(gone & (~before | head[:-1]))
    after = np.append(gone[1:], False) if len(gone) else gone
    close = np.flatnonzero(gone & (~after | head[1:])) + 1
    in_doc = words.doc[open_] if len(open_) else np.zeros(0, np.int64)
    offsets = np.searchsorted(in_doc, np.arange(n_docs + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(
        pa.array(offsets),
        pa.StructArray.from_arrays(
            [
                pa.array((open_ - words.first[in_doc]).astype(np.int32)),
                pa.array((close - open_).astype(np.int32)),
            ],
            names=["start", "length"],
        ),
    )
    return pa.RecordBatch.from_arrays(
        [
            table[ROW].combine_chunks(),
            table["doc_id"].combine_chunks(),
            table["text"].combine_chunks(),
            pa.array(n_words),
            pa.array(n_removed),
            spans,
            _kept_texts(words, gone, n_docs),
        ],
        names=[ROW, "doc_id", "text", "n_words", "n_removed", "spans", "kept_text"],
    )


def _kept_texts(words: Words, gone: np.ndarray, n_docs: int) -> pa.Array:
    """The words that stay, one space between them, as one string per document."""
    keep = np.flatnonzero(~gone)
    starts, ends, doc = words.starts[keep], words.ends[keep], words.doc[keep] if len(keep) else keep
    # Each word takes one byte more, for a space; the space after a document's last word is left out.
    sizes = ends - starts + 1
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    sizes = sizes - last
    total = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(total[-1]), 32, np.uint8)
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    take = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    spaces = (total[1:] - 1)[~last]
    put = np.ones(len(out), bool)
    put[spaces] = False
    out[put] = words.data[take]
    bounds = total[np.searchsorted(doc, np.arange(n_docs + 1))]
    return pa.Array.from_buffers(
        pa.large_string(), n_docs, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)]
    ).cast(pa.string())


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with repeated passages taken out of the texts. A text that loses nothing stays as it is,
    null included; one that does becomes its words left, joined by one space, maybe none. No
    document goes."""
    found = find_repeats(docs, id_col, text_col, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kept = [text.alias(c) if c == text_col else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]
    return found.select(*kept)
