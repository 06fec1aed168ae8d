"""SentencePiece encoding and decoding with weighted transducers in the tropical semiring.

A model file is compiled into three machines: the normaliser (characters to characters), the pieces (a trie from
runs of characters to ids) and byte fallback (any character to the ids of its bytes). They are composed with an
input, and its encoding is the path of least weight.

In a unigram model an arc weighs minus its piece's score. A BPE model has no such weights: there an arc may
only follow an arc it is compatible with (merging the two pieces' characters by rank gives just these two
pieces), and a sequence of pieces is what BPE makes of its characters if and only if all neighbours are
compatible. Compatible arcs weigh nothing, others have infinite weight, so the state of the composition is
(position, last piece). One compatible path reaches each position, and the search keeps just that.

Many segments are composed at once as array operations: the trie is walked from all places together, then weights are
settled position by position.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, give_back, packed

SPACE = "▁"
# Types of pieces and models in the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Weight of a character that no piece covers, beyond that of any piece.
FALLBACK_WEIGHT = 10.0
# Segments remembered by a worker: two generations of at most so many each.
REMEMBERED = 100_000
# Documents encoded at a time, and characters of new segments composed at a time (one segment at least).
SLICE_ROWS = 256
COMPOSED = 1 << 18
# Places with so few arcs are settled one by one, others as arrays.
FEW_ARCS = 16
_NEVER = np.int64(1) << 40


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at += 1
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        else:
            raise ValueError("not a model file")
        yield tag >> 3, value


class _Memory:
    """A bounded memory: when the young generation is full it becomes the old one, which is forgotten;
    what is met again in the old one is young anew."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value

    def add(self, many: dict) -> None:
        if len(self.young) + len(many) > self.most:
            self.young, self.old = {}, self.young
        self.young.update(islice(many.items(), self.most))


class _Table:
    """Numbers by whole-number key, looked up for arrays of keys; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            mine = self.keys[slot] == keys
            self.values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            same = found == keys[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (found >= 0)]
        return out


class PieceTransducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes_: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.silent: set[int] = set()
        self.unknown = 0
        kind_of_model, self.dummy_prefix, self.strip, self.escape = UNIGRAM, True, True, True
        for number, value in _fields(model):
            if number == 1:
                entry = dict(_fields(value))
                self._add(entry.get(1, b"").decode(), entry.get(2, 0.0), entry.get(3, NORMAL))
            elif number == 2:
                kind_of_model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("character maps in the normaliser are not supported")
                self.dummy_prefix = bool(spec.get(3, 1))
                self.strip = bool(spec.get(4, 1))
                self.escape = bool(spec.get(5, 1))
        if kind_of_model not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.bpe = kind_of_model == BPE
        self.longest = max((len(p) for p in self.ids), default=1)
        # Inputs may be cut before a run of spaces if no piece goes on across such a place.
        across = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.cut = None if across else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._texts = [b"" if at in self.silent else p.encode() for at, p in enumerate(self.pieces)]
        for at, value in self.byte_of.items():
            self._texts[at] = bytes([value])
        self._compile()
        self.forget()

    def _add(self, piece: str, score: float, kind: int) -> None:
        at = len(self.pieces)
        self.pieces.append(piece)
        self.scores.append(score)
        if kind in (NORMAL, USER_DEFINED, UNUSED):
            self.ids[piece] = at
        elif kind == BYTE:
            value = int(piece[3:5], 16)
            self.bytes_[value], self.byte_of[at] = at, value
        else:
            self.silent.add(at)
            if kind == UNKNOWN:
                self.unknown = at

    def forget(self) -> None:
        """Empty the memories; the machines stay."""
        self._segments = _Memory(REMEMBERED)
        self._met = _Memory(REMEMBERED)

    # The normaliser.
    def normalise(self, text: str) -> str:
        if self.strip:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if self.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text

    # The machine of pieces. A piece has the number of its id; one more number stands for a character no
    # piece covers, another for the border of a segment.
    def _compile(self) -> None:
        n = len(self.pieces)
        self._uncovered, self._border = n, n + 1
        chars = sorted({ord(c) for p in self.ids for c in p})
        self._letters = len(chars) + 1
        self._letter = np.zeros(0x110000, np.int32)
        self._letter[chars] = np.arange(1, len(chars) + 1)
        nodes, edges = {"": 0}, []
        ends = [-1]
        for piece, at in self.ids.items():
            node = 0
            for i, c in enumerate(piece):
                child = nodes.get(piece[: i + 1])
                if child is None:
                    child = nodes[piece[: i + 1]] = len(ends)
                    ends.append(-1)
                    edges.append((node * self._letters + int(self._letter[ord(c)]), child))
                node = child
            ends[node] = at
        made = np.array(edges, dtype=np.int64).reshape(-1, 2)
        self._trie = _Table(made[:, 0], made[:, 1])
        self._ends = np.array(ends, dtype=np.int64)
        cost = -np.array(self.scores, dtype=np.float64)
        low = min(self.scores, default=0.0)
        self._cost = np.zeros(n + 2) if self.bpe else np.append(cost, [FALLBACK_WEIGHT - low, 0.0])
        if self.bpe:
            self._compile_merges()

    def _compile_merges(self) -> None:
        """Ranks of pieces as merges, the two parts each is merged from last, and which of them merging by
        rank can give at all. Pieces of one character are there before any merge."""
        n = len(self.pieces)
        self._rank = np.full(n + 2, -1, np.int64)
        made = [at for p, at in self.ids.items() if len(p) > 1]
        # Equal scores share a rank; the leftmost of equals goes first.
        ranks = {score: i for i, score in enumerate(sorted({self.scores[at] for at in made}, reverse=True))}
        self._rank[made] = [ranks[self.scores[at]] for at in made]
        pairs = []
        for piece, at in self.ids.items():
            for i in range(1, len(piece)):
                left, right = self.ids.get(piece[:i]), self.ids.get(piece[i:])
                # A character without a piece of its own merges as well as any other.
                if left is not None and right is not None:
                    pairs.append((len(piece), left, right, at))
                elif (left is None and i == 1) or (right is None and i == len(piece) - 1):
                    raise ValueError("a BPE piece holds a character that is no piece")
        found = np.array(pairs, dtype=np.int64).reshape(-1, 4)
        self._pairs = _Table(found[:, 1] * (n + 2) + found[:, 2], self._rank[found[:, 3]])
        self._left = np.full(n + 2, -1, np.int64)
        self._right = np.full(n + 2, -1, np.int64)
        # Pieces that do not rank behind their parts are odd: the order of merges is not that of ranks.
        self._odd = np.zeros(n + 2, bool)
        whole = self._rank < 0
        for size in np.unique(found[:, 0]):
            _, left, right, at = found[found[:, 0] == size].T
            for piece in np.unique(at[self._odd[left] | self._odd[right]]).tolist():
                parts = self._merged(self.pieces[piece])
                whole[piece] = self._odd[piece] = parts == [self.pieces[piece]]
            can = whole[left] & whole[right] & ~self._odd[at] & ~self._odd[left] & ~self._odd[right]
            left, right, at = left[can], right[can], at[can]
            can = self._compatible(left, right, apart=False)
            left, right, at = left[can], right[can], at[can]
            self._left[at], self._right[at] = left, right
            whole[at] = True
            self._odd[at] = np.maximum(self._rank[left], self._rank[right]) >= self._rank[at]
        self._ends = np.where((self._ends >= 0) & ~whole[self._ends], -1, self._ends)

    def _compatible(self, left: np.ndarray, right: np.ndarray, apart: bool = True) -> np.ndarray:
        """Whether BPE leaves each two pieces whole when they meet (``apart``: and does not merge the two).

        Merges are undone at the border from the last one back. The two parts that touch there at a time
        would be merged if together they are a piece that ranks before the merge that ends either part; of
        equal ranks the one further left goes first."""
        out = np.ones(len(left), bool)
        row = np.arange(len(left))
        until_left = np.full(len(left), _NEVER)
        until_right = until_left.copy()
        if apart:
            for i in np.flatnonzero(self._odd[left] | self._odd[right]).tolist():
                out[i] = self._by_merging(int(left[i]), int(right[i]))
            row = np.flatnonzero(~(self._odd[left] | self._odd[right]))
            left, right, until_left, until_right = left[row], right[row], until_left[row], until_right[row]
        first = not apart
        width = len(self.pieces) + 2
        while len(row):
            rank = self._pairs.get(left * width + right).astype(np.int64)
            merged = (rank >= 0) & (rank < until_left) & (rank <= until_right) & (not first)
            first = False
            out[row[merged]] = False
            from_left, from_right = self._rank[left], self._rank[right]
            go = ~merged & ((from_left >= 0) | (from_right >= 0))
            row, left, right, until_left, until_right, from_left, from_right = (
                x[go] for x in (row, left, right, until_left, until_right, from_left, from_right)
            )
            undo = from_left > from_right
            until_left, until_right = np.where(undo, from_left, until_left), np.where(undo, until_right, from_right)
            left, right = np.where(undo, self._right[left], left), np.where(undo, right, self._left[right])
        return out

    def _merged(self, text: str) -> list[str]:
        """Characters merged by rank: the neighbours that form the best-scored piece first, the
        leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _by_merging(self, left: int, right: int) -> bool:
        """Whether two pieces are compatible, found by merging their characters."""
        known = self._met.get((left, right))
        if known is None:
            if max(left, right) >= len(self.pieces):
                known = True
            else:
                parts = [self.pieces[left], self.pieces[right]]
                known = self._merged("".join(parts)) == parts
            self._met.put((left, right), known)
        return known

    def _one_compatible(self, left: int, right: int) -> bool:
        """``_compatible`` of one pair, without arrays."""
        known = self._met.get((left, right))
        if known is None:
            known = bool(self._compatible(np.array([left]), np.array([right]))[0])
            self._met.put((left, right), known)
        return known

    def _arcs(self, codes: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, piece) of all arcs of the composition; ``stop`` is the end of the segment a
        character is in."""
        letters = self._letter[codes].astype(np.int64)
        begin = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        begins, ends, pieces = [], [], []
        for size in range(1, self.longest + 1):
            node = self._trie.get(node * self._letters + letters[begin + size - 1]).astype(np.int64)
            piece = np.where(node >= 0, self._ends[node], -1)
            if size == 1:
                piece = np.where(piece < 0, self._uncovered, piece)
            has = np.flatnonzero(piece >= 0)
            begins.append(begin[has])
            ends.append(begin[has] + size)
            pieces.append(piece[has])
            go = (node >= 0) & (begin + size < stop[begin])
            begin, node = begin[go], node[go]
            if not len(begin):
                break
        return np.concatenate(begins), np.concatenate(ends), np.concatenate(pieces)

    def _compose(self, segments: list[str]) -> list[bytes]:
        """Ids of segments: the path of least weight through the composition with each of them."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(s) for s in segments])
        stops = np.cumsum(sizes)
        starts = stops - sizes
        begin, end, piece = self._arcs(codes, np.repeat(stops, sizes))
        # No merge and no piece goes across a place that no arc spans: what follows is a path of its own.
        long = end - begin > 1
        spans = np.bincount(begin[long] + 1, minlength=len(codes) + 1) - np.bincount(end[long], minlength=len(codes) + 1)
        free = np.flatnonzero(np.cumsum(spans) == 0)[:-1]
        place = np.arange(len(codes)) - np.repeat(free, np.diff(np.append(free, len(codes))))
        # What is known of a position stands with the character before it.
        weight = np.full(len(codes), np.inf)
        last = np.full(len(codes), -1, np.int64)
        came = np.full(len(codes), -1, np.int64)
        at_place = place[end - 1]
        order = np.lexsort((begin, at_place))
        begin, end, piece, at_place = begin[order], end[order] - 1, piece[order], at_place[order]
        opening = place[begin] == 0
        cost = self._cost[piece]
        bounds = np.append(np.flatnonzero(np.append(True, at_place[1:] != at_place[:-1])), len(end))
        # Beyond this place only few paths go on, which are followed one by one.
        few = int(np.max(np.flatnonzero(np.diff(bounds) > FEW_ARCS), initial=-1)) + 1
        for lo, hi in zip(bounds[:few], bounds[1 : few + 1], strict=True):
            b, e, p, o = begin[lo:hi], end[lo:hi], piece[lo:hi], opening[lo:hi]
            total = np.where(o, 0.0, weight[b - 1]) + cost[lo:hi]
            if self.bpe:
                before = np.where(o, self._border, last[b - 1])
                ok = np.flatnonzero(self._compatible(before, p))
            else:
                by_weight = np.lexsort((b, total, e))
                ok = by_weight[np.append(True, e[by_weight][1:] != e[by_weight][:-1])]
            weight[e[ok]], last[e[ok]], came[e[ok]] = total[ok], p[ok], b[ok]
        self._follow(begin[bounds[few]:], end[bounds[few]:], piece[bounds[few]:], opening[bounds[few]:], weight, last, came)
        on_path = np.zeros(len(codes), bool)
        at = np.append(free[1:], len(codes)) - 1
        while len(at):
            on_path[at] = True
            at = came[at]
            at = at[place[at] > 0] - 1
        taken = np.flatnonzero(on_path)
        ids, count = last[taken].astype(np.int32), np.ones(len(taken), np.int64)
        open_ = np.flatnonzero(ids == self._uncovered)
        if len(open_):
            spelt = {int(c): self._spelt(int(c)) for c in np.unique(codes[taken[open_]])}
            found = [spelt[int(c)] for c in codes[taken[open_]]]
            count[open_] = [len(f) for f in found]
            where = np.repeat(ids == self._uncovered, count)
            ids = np.repeat(ids, count)
            ids[where] = np.concatenate(found)
        upto = np.concatenate([[0], np.cumsum(count)])
        cuts = upto[np.searchsorted(taken, np.append(starts, len(codes)))] * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _follow(self, begin, end, piece, opening, weight, last, came) -> None:
        """Settles positions one after another; ``weight``, ``last`` and ``came`` are filled in."""
        if not len(begin):
            return
        weights, lasts, came_from = {}, {}, {}
        for at in np.unique(begin[~opening] - 1).tolist():
            weights[at], lasts[at] = float(weight[at]), int(last[at])
        infinite, cost = float("inf"), self._cost
        for b, e, p, o in zip(begin.tolist(), end.tolist(), piece.tolist(), opening.tolist(), strict=True):
            if self.bpe:
                if not self._one_compatible(self._border if o else lasts[b - 1], p):
                    continue
                total = 0.0
            else:
                total = (0.0 if o else weights[b - 1]) + float(cost[p])
                if e in came_from and total >= weights.get(e, infinite):
                    continue
            weights[e], lasts[e], came_from[e] = total, p, b
        at = np.array(list(came_from), dtype=np.int64)
        weight[at], last[at] = [weights[e] for e in came_from], [lasts[e] for e in came_from]
        came[at] = list(came_from.values())

    def _spelt(self, code: int) -> np.ndarray:
        """Ids of a character that no piece covers."""
        found = [self.bytes_[b] for b in chr(code).encode()] if self.bytes_ else [self.unknown]
        return np.array(found, dtype=np.int32)

    def _learn(self, segments: list[str]) -> dict[str, bytes]:
        """Ids of new segments, as many at a time as fit the bound, those of like length together."""
        out: dict[str, bytes] = {}
        segments.sort(key=len)
        upto = np.cumsum([len(s) for s in segments])
        at = 0
        while at < len(segments):
            before = int(upto[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, before + COMPOSED, "right")))
            out.update(zip(segments[at:stop], self._compose(segments[at:stop]), strict=True))
            at = stop
        return out

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of texts; null and empty texts have none."""
        cut, met = [], set()
        for text in texts:
            normal = self.normalise(text or "")
            segments = ([normal] if self.cut is None else self.cut.findall(normal)) if normal else []
            cut.append(segments)
            met.update(segments)
        young, old = self._segments.young, self._segments.old
        known = {s: young[s] for s in met if s in young}
        again = {s: old[s] for s in met.difference(known) if s in old}
        again.update(self._learn(list(met.difference(known, again))))
        self._segments.add({s: ids for s, ids in again.items() if len(s) <= 64})
        known.update(again)
        return [np.frombuffer(b"".join([known[s] for s in segments]), dtype=np.int32) for segments in cut]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The text of ids: fallback bytes are put together, control pieces are silent."""
        spelt = self._texts
        text = b"".join([spelt[at] for at in ids]).decode("utf-8", "replace")
        if self.escape:
            text = text.replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_compiled: dict[int, PieceTransducer] = {}


def compiled(model: bytes) -> PieceTransducer:
    """The machines of a model file, compiled once per worker."""
    key = zlib.crc32(model)
    if key not in _compiled:
        _compiled[key] = PieceTransducer(model)
    return _compiled[key]


def read_model(path: str) -> bytes:
    """A model file, at most a few megabytes; its bytes travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode_documents(
    docs: DataFrame, model: bytes, text_col: str = "text", ids: str = "ids", n_fallback: str = "n_fallback",
    ids_crc32: str | None = None, round_trip: str | None = None,
) -> DataFrame:
    """``docs`` with its text replaced by the ids (array) and the number of them that are fallback
    bytes. Null and empty texts have no ids; repeated rows are encoded each; very long texts are encoded whole;
    an empty table gives an empty one. Columns of the same names are replaced.

    ``ids_crc32`` and ``round_trip`` name columns to add in the same pass: the unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers, and whether decoding them gives the text (null as empty)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = [c for c in (ids_crc32, round_trip) if c is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(held.value)
        is_byte = np.zeros(len(machine.pieces), bool)
        is_byte[list(machine.byte_of)] = True
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column(1).to_pylist()
                found = machine.encode_all(texts)
                flat = np.concatenate([np.zeros(0, np.int32), *found])
                bounds = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                total = np.concatenate([[0], np.cumsum(is_byte[flat])])
                columns = [
                    part.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    pa.array(total[bounds[1:]] - total[bounds[:-1]]),
                ]
                if ids_crc32 is not None:
                    columns.append(pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()))
                if round_trip is not None:
                    same = [machine.decode(f.tolist()) == (t or "") for f, t in zip(found, texts, strict=True)]
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        machine.forget()
        give_back()

    taken = (text_col, ids, n_fallback, *added)
    given = docs.select(packed(docs, *taken), docs[text_col].cast("string").alias("text"))
    row_type = given.schema[ROW].dataType.simpleString()
    types = [(ROW, row_type), ("ids", "array<int>"), ("n_fallback", "long")]
    types += [("crc", "long")] * (ids_crc32 is not None) + [("same", "boolean")] * (round_trip is not None)
    names = [name for name, _ in types]
    out = given.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in types))
    kept = [F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns if c not in taken]
    made = zip(names[1:], (ids, n_fallback, *added), strict=True)
    return out.select(*kept, *[F.col(name).alias(alias) for name, alias in made])


def decode_column(column, model: bytes, spark):
    """Text of a column of ids; a null is a null."""
    held = spark.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = compiled(held.value)
        for ids in parts:
            yield pd.Series([None if x is None else machine.decode(x.tolist()) for x in ids], dtype=object)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(column)


def crc_of_ids(column):
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""

    def crc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in parts:
            found = [None if x is None else zlib.crc32(np.asarray(x, dtype="<u4").tobytes()) for x in ids]
            yield pd.Series(found, dtype="Int64")

    crc.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(crc, "long")(column)
