"""Runs of words: stretches of a document that repeat one passage over and over.

A run is a stretch with smallest period q of at least ``min_words`` and 2q words that no neighbouring word
extends. Every run has, under one of two opposite orders of the words, a Lyndon root that is the longest Lyndon
word at its place (Bannai et al. 2017). So two candidates per word, each extended to both sides by
longest common extensions, find all runs. Extensions to the right come from Ukkonen's suffix tree of the
words, those to the left from the tree of the reversed words: the string depth of the lowest common ancestor
of two leaves, a range minimum over the Euler tour.

Trees are built for the stretches a run can lie in only. In a run of period q and length L every word is covered
by a sequence of L - q or more, and L - q >= min_words / 2, words that occurs again inside the run. Words not
covered by a sequence of that many words which occurs twice in the same stretch are left out, again and again until
nothing changes. That step compares hashes, and hashes of unlike words that are equal only add words to
the trees, which tell words apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, give_back, packed, texts_of
from quayside.llm.wordhash import Words, mix, windows

MIN_WORDS = 12
# Text looked at together; a longer document is taken alone.
CHUNK_BYTES = 4 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class SuffixTree:
    """Ukkonen's tree of a sequence of whole numbers above zero; zero ends it and is the smallest."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        self.n = n = len(text)
        self.sigma = sigma = max(text) + 1
        start, end, link, suffix = [0], [0], [0], [-1]
        edges: dict[int, int] = {}
        node = edge = length = waiting = leaves = 0
        for i, c in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                key = node * sigma + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(leaves)
                    leaves += 1
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = start[child]
                    span = end[child] - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[at + length] == c:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(start)
                    edges[key] = split
                    edges[split * sigma + c] = split + 1
                    edges[split * sigma + text[at + length]] = child
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    suffix += (-1, leaves)
                    leaves += 1
                    start[child] = at + length
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.children = np.fromiter(edges.values(), np.int64, len(edges))
        self.spans = np.array(end) - np.array(start)
        self.suffix = suffix

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, and for each leaf the depth of the node at which the
        Euler tour turned since the leaf before. ``reverse``: larger numbers first, the end still first of all."""
        parent, symbol = np.divmod(self.keys, self.sigma)
        rank = np.where(symbol == 0, 0, self.sigma - symbol) if reverse else symbol
        order = np.argsort(parent * self.sigma + rank)
        child, parent = self.children[order], parent[order]
        first = np.searchsorted(parent, np.arange(len(self.spans) + 1)).tolist()
        child, spans, suffix = child.tolist(), self.spans.tolist(), self.suffix
        leaves, turns = [], []
        stack = [(0, 0, 0)]
        turn = 0
        while stack:
            node, depth, above = stack.pop()
            if above >= 0:
                turn = above
            if suffix[node] >= 0:
                leaves.append(suffix[node])
                turns.append(turn)
                continue
            lo, hi = first[node], first[node + 1]
            for k in range(hi - 1, lo, -1):
                other = child[k]
                stack.append((other, depth + spans[other], depth))
            other = child[lo]
            stack.append((other, depth + spans[other], -1))
        return np.array(leaves), np.array(turns)


class CommonExtensions:
    """Longest common prefixes of two suffixes, in constant time each after the tree's Euler tour."""

    def __init__(self, tree: SuffixTree):
        leaves, turns = tree.tour()
        self.rank = np.empty(tree.n, np.int64)
        self.rank[leaves] = np.arange(tree.n)
        self.levels = [turns.astype(np.int32)]
        width = 1
        while 2 * width <= tree.n:
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of unlike places."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every place but the last the next one of smaller rank; the last has the smallest."""
    values = rank.tolist()
    out = [0] * (len(values) - 1)
    stack = [len(values) - 1]
    for i in range(len(values) - 2, -1, -1):
        value = values[i]
        while values[stack[-1]] > value:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(symbols: list[int], min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period."""
    m = len(symbols)
    if m < max(2, min_words):
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(symbols)
    right = CommonExtensions(tree)
    left = CommonExtensions(SuffixTree(symbols[::-1]))
    backward = np.empty(tree.n, np.int64)
    backward[tree.tour(reverse=True)[0]] = np.arange(tree.n)
    found = []
    i = np.arange(m)
    for rank in (right.rank, backward):
        j = next_smaller(rank)
        start = i - left(m - i, m - j)
        length = j + right(i, j) - start
        ok = length >= np.maximum(min_words, 2 * (j - i))
        found.append(np.stack([start, length, j - i], axis=1)[ok])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeating_stretches(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (word numbers) of the stretches a run can lie in."""
    gram = max(1, -(-min_words // 2))
    hashes = words.hashes()
    at, group = np.arange(len(words)), words.doc
    while len(at):
        n = len(at) - gram + 1
        if n <= 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = np.flatnonzero(group[:n] == group[gram - 1 :])
        key = mix(windows(hashes[at], gram)[whole] ^ mix(group[whole].astype(np.uint64)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(whole), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        change = np.zeros(len(at) + 1, np.int32)
        np.add.at(change, whole[again], 1)
        np.add.at(change, whole[again] + gram, -1)
        covered = np.cumsum(change[:-1]) > 0
        kept, of = at[covered], group[covered]
        begin = np.ones(len(kept), bool)
        begin[1:] = (kept[1:] != kept[:-1] + 1) | (of[1:] != of[:-1])
        number = np.cumsum(begin) - 1
        long = np.bincount(number, minlength=1)[number] >= min_words if len(kept) else np.zeros(0, bool)
        kept, number = kept[long], number[long]
        if len(kept) == len(at):
            bounds = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(kept))
            return kept[bounds[:-1]], kept[bounds[1:] - 1] + 1
        at, group = kept, number
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def runs_in_stretches(words: list[bytes], stretches: list[tuple[int, int]], min_words: int) -> np.ndarray:
    """Runs of a document whose runs all lie in the given stretches. What stands between two stretches is one
    symbol that occurs nowhere else, which no run can hold."""
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    origin: list[int] = []
    for s, e in stretches:
        symbols += [number.setdefault(w, len(number) + 1) for w in words[s:e]]
        symbols.append(0)
        origin += range(s, e + 1)
    symbols.pop()
    between = len(number)
    for k, symbol in enumerate(symbols):
        if not symbol:
            between += 1
            symbols[k] = between
    rows = runs_of(symbols, min_words)
    rows[:, 0] = np.array(origin, dtype=np.int64)[rows[:, 0]]
    return rows


def _chunk_bounds(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(offsets) - 1:
        upto = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        upto = max(upto, at + 1)
        yield at, upto
        at = upto


def _looked_through(batch: pa.RecordBatch, min_words: int) -> Iterator[pa.RecordBatch]:
    data, offsets = texts_of(batch.column("text"))
    for lo, hi in _chunk_bounds(offsets):
        part = data[offsets[lo] : offsets[hi]]
        bounds = offsets[lo : hi + 1] - offsets[lo]
        words = Words(part, bounds)
        starts, ends = repeating_stretches(words, min_words)
        # Stretches of a document: those that begin between its first word and the next document's.
        cut = np.searchsorted(starts, words.first)
        counts, kept, flat, n_runs = np.diff(words.first), [], [], []
        for d in range(hi - lo):
            own = part[bounds[d] : bounds[d + 1]].tobytes().split()
            rows = np.zeros((0, 3), np.int64)
            if cut[d + 1] > cut[d]:
                where = slice(cut[d], cut[d + 1])
                inside = zip((starts[where] - words.first[d]).tolist(), (ends[where] - words.first[d]).tolist(), strict=True)
                rows = runs_in_stretches(own, list(inside), min_words)
            if len(rows):
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, rows[:, 0] + rows[:, 2], 1)
                np.add.at(change, rows[:, 0] + rows[:, 1], -1)
                own = [own[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            kept.append(b" ".join(own))
            flat.append(rows)
            n_runs.append(len(rows))
        rows = np.concatenate(flat)
        runs = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], ["start", "length", "period"]),
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(ROW).slice(lo, hi - lo),
                pa.array(counts.astype(np.int64)),
                runs,
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=[ROW, "n_words", "runs", "kept_text"],
        )


def find_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row ``n_words``, ``runs`` (start, length and period by start, then period; words are numbered
    from 0) and ``kept_text``: the words no run holds behind its first period, joined by one space.

    The other columns of ``docs`` come first, all in the struct ``_qs_row``, whatever their names are. A null
    text has no words, no runs and an empty kept text, like an empty one. Ids play no part: null
    and repeated ids, or repeated rows, each give a row of their own; an empty table gives an empty one.
    A text is never cut: memory of a task grows with the longest repeating stretches of one document (about
    0.7 kB a word), and not with its other words.
    """
    given = docs.select(docs[text_col].cast("string").alias("text"), packed(docs, text_col))
    row_type = given.schema[ROW].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _looked_through(batch, min_words)
        give_back()

    return given.mapInArrow(run, f"{ROW} {row_type}, n_words bigint, runs array<{RUN}>, kept_text string")


def collapse_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every run cut to its first period in the texts; columns and rows as given."""
    found = find_runs(docs, text_col, min_words)
    return found.select(*[F.col("kept_text" if c == text_col else f"{ROW}.`{c}`").alias(c) for c in docs.columns])
