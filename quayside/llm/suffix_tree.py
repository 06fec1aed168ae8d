"""A probabilistic suffix tree over words, learned from and applied to a whole corpus.

States are contexts of up to ``depth`` words. A context that is frequent enough is retained if its next-word
distribution diverges from that of its suffix: the log-likelihood its own counts gain over
the suffix's distribution must reach a threshold. Distributions are smoothed by discounting counts and giving
the mass to the suffix's distribution, down to the words' own. A word is scored in the longest
retained suffix of what stands before it.

Counts, and the sums that decide on contexts, are asked for in rounds between chunks of documents and buckets of
word sequences: a sequence is sent once per chunk that has it. Words are asked for by hashes. With the counts of words,
and of longer contexts, come their numbers in the corpus, and a longer run is asked for as the numbers of its context and its
last word: sorted, these take far fewer bits than hashes of runs. A chunk keeps nothing between rounds; it reads the
answers of all earlier ones again where they lie.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.chunks import (
    Chunks, answers, bucket_bounds, cut, joined, lengths, message_rows, narrow, packed_numbers, questions, unpacked_numbers, widen,
)
from quayside.llm.common import texts_of
from quayside.llm.wordhash import Words

FOLDS = 7
HELD_OUT = 2
DEPTH = 2
# Larger chunks than elsewhere: the more documents, the more often a word is asked for just once.
CHUNK_BYTES = 6 << 20
# Occurrences a context needs, and a next word needs to be in its distribution.
MIN_CONTEXT = 16
MIN_NEXT = 2
DISCOUNT = 0.5
# Nats that the counts of a context must gain over its suffix.
MIN_GAIN = 8.0
_END = np.uint64(0x5A1D0C0FFEE5EED1)
# Kinds of messages, to which the number of tokens is added: counts and numbers of runs, sums of contexts.
_COUNTS, _STATES = 100, 200
# Bytes of the key of a context: its number among those of its bucket.
_NUMBER_KEY = 6
_U32, _LOW_32 = np.uint64(32), np.uint64(0xFFFFFFFF)


def _key_bytes(n: int) -> int:
    return 8 if n == 1 else _NUMBER_KEY


def _keys(values: np.ndarray, n: int) -> np.ndarray:
    """Keys of hashed words (``n`` is 1) or of numbered contexts, in order like the values."""
    return narrow(values, _key_bytes(n))


@dataclass(frozen=True)
class Settings:
    depth: int = DEPTH
    min_context: int = MIN_CONTEXT
    min_next: int = MIN_NEXT
    discount: float = DISCOUNT
    min_gain: float = MIN_GAIN
    folds: int = FOLDS
    held_out: int = HELD_OUT


class _Tokens:
    """The tokens of a chunk: lower-cased words of each document and its end."""

    def __init__(self, table: pa.Table, s: Settings):
        words = Words(*texts_of(table["text"]), lower=True)
        n_docs = table.num_rows
        self.first = words.first + np.arange(n_docs + 1)
        self.hash = np.empty(len(words) + n_docs, np.uint64)
        ends = self.first[1:] - 1
        inner = np.ones(len(self.hash), bool)
        inner[ends] = False
        self.hash[inner] = words.hashes(0)
        self.hash[ends] = _END
        self.doc = np.repeat(np.arange(n_docs), np.diff(self.first))
        ids = table["doc_id"].to_pylist()
        self.out = np.array([i is not None and zlib.crc32(str(i).encode()) % s.folds == s.held_out for i in ids], bool)
        self.train = ~self.out[self.doc] if n_docs else np.zeros(0, bool)

    def starts(self, n: int) -> np.ndarray:
        """Where runs of ``n`` tokens begin that stay inside a document, as a mask over all tokens."""
        ok = np.zeros(len(self.hash), bool)
        m = len(self.hash) - n + 1
        if m > 0:
            ok[:m] = self.doc[:m] == self.doc[n - 1 :]
        return ok


class _Counted:
    """Distinct runs that begin at ``at``: their keys in order, and which of them is at each place."""

    def __init__(self, tokens: _Tokens, at: np.ndarray, keys: np.ndarray, which: np.ndarray):
        self.at, self.hash, self.which = at, keys, which
        self.train = np.bincount(self.which, tokens.train[at], len(self.hash)).astype(np.uint64)
        # The order in which they are asked for.
        self.order: np.ndarray | slice = slice(None)

    def spread(self, values: np.ndarray, n_tokens: int) -> np.ndarray:
        """Values of distinct runs at each place one begins, zero elsewhere."""
        out = np.zeros(n_tokens, values.dtype)
        out[self.at] = values[self.which]
        return out

    def places(self) -> np.ndarray:
        """One place of each distinct run."""
        place = np.empty(len(self.hash), np.int64)
        place[self.which] = self.at
        return place

    def back(self, values: np.ndarray) -> np.ndarray:
        """Values in the order asked for, in that of the distinct runs."""
        out = np.empty_like(values)
        out[self.order] = values
        return out


class _Runs(_Counted):
    """Distinct runs as numbers of a context and of the word after it, dealt over buckets by context. Those of a
    frequent context are split over the buckets next to its own by their last word."""

    def __init__(self, tokens: _Tokens, context: np.ndarray, word: np.ndarray, at: np.ndarray):
        super().__init__(tokens, at, *np.unique(context << _U32 | word, return_inverse=True))

    def deal(self, n_buckets: int, share: np.ndarray) -> None:
        """``share``: part of all tokens that follow the context of each distinct run."""
        n = np.uint64(n_buckets)
        context, word = self.hash >> _U32, self.hash & _LOW_32
        parts = np.minimum(1 + 2 * share * n_buckets, n_buckets).astype(np.uint64)
        part = word % parts
        bucket = (context + part) % n
        self.order = _stable(part, n_buckets)
        self.order = self.order[_stable(bucket[self.order], n_buckets)]
        # In one bucket a context has one part, so that this tells its runs apart.
        self.bucket, self.part, self.context, self.word = (v[self.order] for v in (bucket, part, context // n, word // parts))

    def messages(self, chunk: int, kind: int) -> pa.RecordBatch:
        new_bucket = _changes(self.bucket)
        new_part = new_bucket | _changes(self.part)
        new = new_part | _changes(self.context)
        begin = np.flatnonzero(new)
        context, fresh = self.context[begin], new_part[begin]
        contexts = context - np.where(fresh, np.uint64(0), np.append(np.uint64(0), context[:-1]) + np.uint64(1))
        words = self.word - np.where(new, np.uint64(0), np.append(np.uint64(0), self.word[:-1]) + np.uint64(1))
        more = np.diff(np.append(begin, len(new))) - 1
        bounds = np.append(np.flatnonzero(new_bucket), len(new))
        at = np.searchsorted(begin, bounds)
        values = []
        for i, j, s, e in zip(bounds, bounds[1:], at, at[1:]):
            values.append(b"".join(map(packed_numbers, (self.part[begin[s:e]], contexts[s:e], more[s:e], words[i:j]))))
        counts = narrow(np.minimum(self.train, _LOW_32)[self.order], 4)
        return message_rows(self.bucket[bounds[:-1]], chunk, kind, pa.array(values, pa.binary()), cut(counts, bounds))


def _run_keys(asked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order in each row, of runs asked for in messages of one bucket, and how many are in each row."""
    found = []
    for value in asked["data"].to_pylist():
        part, context, more, word = unpacked_numbers(value)
        size = more.astype(np.int64) + 1
        new_part = _changes(part)
        context = _running(context + ~new_part, new_part)
        new = np.zeros(len(word), bool)
        new[np.cumsum(size) - size] = True
        found.append((part, context, size, _running(word + ~new, new)))
    parts, contexts, sizes, words = (np.concatenate(v) for v in zip(*found, strict=True))
    # Contexts of one part after all of the part before.
    context = _within_32_bits(parts * (contexts.max(initial=0) + np.uint64(1)) + contexts)
    return np.repeat(context, sizes) << _U32 | words, np.array([len(v[3]) for v in found])


def _within_32_bits(numbers: np.ndarray) -> np.ndarray:
    if numbers.max(initial=0) > _LOW_32:
        raise ValueError("more than 2**32 words or contexts to number")
    return numbers


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value is not the one before it."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _running(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Running sums that begin anew where ``new`` is set."""
    total = np.cumsum(values)
    begin = np.flatnonzero(new)
    return total - np.repeat((total - values)[begin], np.diff(np.append(begin, len(values))))


def _stable(values: np.ndarray, most: int) -> np.ndarray:
    """A stable order of numbers below ``most``."""
    return np.argsort(values.astype(np.uint16 if most <= 1 << 16 else np.uint64), kind="stable")


def _hashed_keys(asked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return joined(asked["data"]).view("<u8"), lengths(asked["data"]) // 8


_SMALL = 127


def _short(counts: np.ndarray, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Counts as one byte each, with those of 127 and more in a list besides; the top bit marks an owner."""
    large = counts >= _SMALL
    low = np.where(large, _SMALL, counts).astype(np.uint8)
    if owner is not None:
        low |= owner.astype(np.uint8) << 7
    return low, large


def _long(low: np.ndarray, large: np.ndarray) -> np.ndarray:
    counts = (low & 127).astype(np.int64)
    counts[counts == _SMALL] = large
    return counts


def _halves(values: np.ndarray) -> np.ndarray:
    """Numbers of up to 64 bits as twice as many of 32."""
    return np.concatenate([values & 0xFFFFFFFF, values >> 32])


def _whole(halves: np.ndarray) -> np.ndarray:
    low, high = halves.reshape(2, -1).astype(np.int64)
    return low | high << 32


def _settle_counts(n: int, min_count: int, min_number: int | None):
    """Sums the counts of equal keys of ``n`` tokens. Answers are the sums (0 below ``min_count``) and, for words, the
    bucket's tokens and distinct tokens in each row, or else which chunk is the first to ask for a run that counts. If
    ``min_number`` is given, runs of so many are numbered: words by falling count, longer runs in the order of keys."""

    def settle(asked: pa.Table) -> pa.RecordBatch:
        keys, per_row = _hashed_keys(asked) if n == 1 else _run_keys(asked)
        counts = joined(asked["more"]).view("<u4").astype(np.int64)
        order = np.argsort(keys, kind="stable")
        value = keys[order]
        begin = np.flatnonzero(_changes(value))
        total = np.add.reduceat(counts[order], begin) if len(value) else counts
        told = np.where(total >= min_count, total, 0)
        size = np.diff(np.append(begin, len(value)))
        out = np.zeros(len(keys), np.int64)
        out[order] = np.repeat(told, size)
        owner = None
        if n > 1:
            owner = np.zeros(len(keys), bool)
            owner[order[begin]] = told > 0
        low, large = _short(out, owner)
        sums = np.array([total.sum(), (total > 0).sum()] if n == 1 else [], np.int64)
        ends = np.cumsum(per_row)
        rows = list(zip(ends - per_row, ends, strict=True))
        more = [packed_numbers(_halves(np.concatenate([sums, out[s:e][large[s:e]]]))) for s, e in rows]
        if min_number is not None:
            have = np.flatnonzero(told >= min_number)
            number = np.zeros(len(told), np.int64)
            number[have[np.argsort(-told[have], kind="stable")] if n == 1 else have] = np.arange(len(have))
            of_key = np.empty(len(keys), np.int64)
            of_key[order] = np.repeat(number, size)
            numbers = (of_key[s:e][out[s:e] >= min_number] for s, e in rows)
            # Those of longer runs rise in each row.
            packed = (packed_numbers(v if n == 1 else np.diff(v, prepend=0)) for v in numbers)
            more = [m + v for m, v in zip(more, packed, strict=True)]
        made = answers(asked, low.reshape(-1, 1), None, per_row)
        return pa.RecordBatch.from_arrays([*made.columns[:4], pa.array(more, pa.binary())], names=made.schema.names)

    return settle


def _settle_states(key_bytes: int, min_gain: float):
    """Sums kept next words, their counts and the gain of equal contexts. Answers are the first two sums, or zeros
    for a context that is not retained."""

    def settle(asked: pa.Table) -> pa.RecordBatch:
        keys = widen(joined(asked["data"]), key_bytes) if key_bytes < 8 else joined(asked["data"]).view("<u8")
        values = joined(asked["more"]).view("<f4").reshape(-1, 3).astype(np.float64)
        order = np.argsort(keys, kind="stable")
        value = keys[order]
        out = np.zeros((len(keys), 2), "<f4")
        if len(keys):
            begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            total = np.add.reduceat(values[order], begin, axis=0).astype("<f4")
            told = np.where(total[:, 2:] >= min_gain, total[:, :2], np.float32(0))
            out[order] = np.repeat(told, np.diff(np.append(begin, len(value))), axis=0)
        return answers(asked, out.view(np.uint8).reshape(-1, 8), None, lengths(asked["data"]) // key_bytes)

    return settle


class _Model:
    """What a chunk knows so far: answers per order of runs, in the order of their distinct runs."""

    def __init__(self, tokens: _Tokens, s: Settings, n_buckets: int, state: dict):
        self.t, self.s, self.n_buckets, self.state = tokens, s, n_buckets, state
        self.count: dict[int, np.ndarray] = {}
        self.number: dict[int, np.ndarray] = {}
        self.runs: dict[int, _Counted] = {}
        self.prob = None
        if "words" not in state:
            return
        words = word_runs(tokens)
        buckets, bounds = bucket_bounds(n_buckets, words.hash)
        self._have(1, words, np.repeat(buckets, np.diff(bounds)))
        self.total, self.distinct = state["total"], state["distinct"]
        self.prob = (self.count[1] + 1.0) / (self.total + self.distinct + 1.0)
        for d in range(1, s.depth + 1):
            if f"runs{d}" not in state:
                break
            runs = self.ask_runs(d)
            self._have(d + 1, runs, runs.bucket)
            if f"states{d}" not in state:
                break
            self.prob = self._deeper(d, self.prob, self.ask_states(d), state[f"states{d}"])

    def _have(self, n: int, counted: _Counted, buckets: np.ndarray) -> None:
        """``buckets``: of runs in the order asked for."""
        low, large, numbers = self.state["words" if n == 1 else f"runs{n - 1}"]
        values = _long(low, large)
        self.runs[n] = counted
        self.count[n] = counted.spread(counted.back(values), len(self.t.hash))
        if n <= self.s.depth:
            has = np.flatnonzero(values >= _numbered(self.s, n))
            at = buckets[has].astype(np.uint64)
            found = np.concatenate([np.zeros(0, np.uint64), *numbers])
            if n > 1:
                found = _running(found, _changes(at))
            of_run = np.zeros(len(values), np.uint64)
            of_run[has] = _within_32_bits(found * np.uint64(self.n_buckets) + at)
            self.number[n] = counted.spread(counted.back(of_run), len(self.t.hash))

    def ask_runs(self, d: int) -> _Runs:
        """Runs of d + 1 tokens whose context is frequent enough and whose last d tokens may count."""
        use = self.t.starts(d + 1)
        frequent = self.count[d] >= self.s.min_context
        again = np.append(self.count[d][1:], 0) >= self.s.min_next
        at = np.flatnonzero(use & frequent & again)
        runs = _Runs(self.t, self.number[d][at], self.number[1][at + d], at)
        runs.deal(self.n_buckets, self.count[d][runs.places()] / max(self.total, 1))
        return runs

    def ask_states(self, d: int) -> _Counted:
        """Contexts of d tokens that are frequent enough and followed by something."""
        at = np.flatnonzero(self.t.starts(d + 1) & (self.count[d] >= self.s.min_context))
        runs = self.runs[d]
        here = runs.spread(np.arange(len(runs.hash)), len(self.t.hash))[at]
        found = np.flatnonzero(np.bincount(here, minlength=len(runs.hash)))
        number = self.number[d][runs.places()[found]]
        order = np.argsort(number)
        which = np.empty(len(runs.hash), np.int64)
        which[found[order]] = np.arange(len(found))
        contexts = _Counted(self.t, at, number[order], which[here])
        contexts.order = _stable(contexts.hash % np.uint64(self.n_buckets), self.n_buckets)
        return contexts

    def contributions(self, d: int, contexts: _Counted, owned: np.ndarray) -> np.ndarray:
        """Per distinct context: kept next words, their counts and their gain, from the runs this
        chunk was the first to ask for."""
        place = self.runs[d + 1].places()
        count = self.count[d + 1][place]
        mine = owned & (count >= self.s.min_next)
        place, count = place[mine], count[mine].astype(np.float64)
        of_place = np.full(len(self.t.hash), -1, np.int64)
        of_place[contexts.at] = contexts.which
        context = of_place[place]
        gain = count * np.log(count / self.count[d][place] / self.prob[place + d])
        n = len(contexts.hash)
        return np.stack([np.bincount(context, w, n) for w in (np.ones(len(count)), count, gain)], axis=1)

    def _deeper(self, d: int, before: np.ndarray, contexts: _Counted, sums: np.ndarray) -> np.ndarray:
        """Probabilities with the retained contexts of d tokens, where one stands before a token."""
        sums = contexts.back(sums)
        kept, total = (sums[contexts.which, i].astype(np.float64) for i in range(2))
        at = contexts.at
        n = self.count[d][at].astype(np.float64)
        rest = np.maximum(1.0 - (total - self.s.discount * kept) / n, 1e-9)
        own = np.maximum(self.count[d + 1][at] - self.s.discount, 0.0) / n
        out = before.copy()
        out[at + d] = np.where(kept > 0, own + rest * before[at + d], before[at + d])
        return out


def word_runs(tokens: _Tokens) -> _Counted:
    # Words repeat so often that finding the distinct ones first takes less than sorting all.
    found = pa.array(tokens.hash).dictionary_encode()
    keys = found.dictionary.to_numpy()
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return _Counted(tokens, np.arange(len(tokens.hash)), keys[order], rank[found.indices.to_numpy()])


def _numbered(s: Settings, n: int) -> int:
    """Occurrences from which on runs of ``n`` tokens are numbered: all that may be contexts, or words after one."""
    return min(s.min_context, s.min_next) if n == 1 else s.min_context


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are ASCII-lower-cased words and one end per document. The tree learns from documents outside the
    held-out fold (a null doc_id is in no fold). base_score adds log10((c + 1) / (N + V + 1)), the distribution
    of the root; score adds the log10 probabilities in the longest retained contexts. Null and
    empty texts are an end only; repeated rows count each; an empty table gives an empty one. Words
    are told apart by 64-bit hashes, longer runs by the numbers of their words.
    """
    s = settings or Settings()
    widths = {_COUNTS + 1: ((8, 4), (1, None))}
    widths |= {_COUNTS + d + 1: ((None, 4), (1, None)) for d in range(1, s.depth + 1)}
    widths |= {_STATES + d: ((_NUMBER_KEY, 12), (8, 8)) for d in range(1, s.depth + 1)}
    given = docs.select(id_col, text_col)
    chunks = Chunks(given, id_col, text_col, ordered=False, chunk_bytes=CHUNK_BYTES, widths=widths)
    buckets, n_buckets = chunks.buckets, np.uint64(chunks.buckets)

    def ask_words(chunk, table, _):
        words = word_runs(_Tokens(table, s))
        more = narrow(np.minimum(words.train, _LOW_32), 4)
        return [questions(buckets, chunk, words.hash, _keys(words.hash, 1), more, _COUNTS + 1, to_all=True)]

    none = (np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64))

    def received(table, got, d: int) -> tuple[_Model, np.ndarray | None]:
        """The model after the answers of ``d`` passes, and which of the newest runs the chunk owns."""
        def counts(n):
            low, more, _ = got.get(_COUNTS + n, none)
            found = unpacked_numbers(more)
            step = 2 if n <= s.depth else 1
            return low, [_whole(v) for v in found[::step]], found[1::step] if n <= s.depth else None

        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        low, large, numbers = counts(1)
        # Each row begins with the two sums of its bucket.
        total, distinct = (sum(int(v[i]) for v in large) for i in range(2))
        state = {"words": (low, join(v[2:] for v in large), numbers), "total": total, "distinct": distinct}
        owned = None
        for n in range(2, min(d, s.depth + 1) + 1):
            low, large, numbers = counts(n)
            state[f"runs{n - 1}"] = (low & 127, join(large), numbers)
            owned = (low >> 7).astype(bool)
        for n in range(1, d - 1):
            state[f"states{n}"] = got.get(_STATES + n, none)[0].view("<f4").reshape(-1, 2)
        return _Model(_Tokens(table, s), s, buckets, state), owned

    def pass_number(d: int):
        def send(chunk, table, got):
            model, owned = received(table, got, d)
            out = []
            if d > 1:
                contexts = model.ask_states(d - 1)
                sums = model.contributions(d - 1, contexts, model.runs[d].back(owned)).astype("<f4")[contexts.order]
                bucket, key = (v[contexts.order] for v in (contexts.hash % n_buckets, contexts.hash // n_buckets))
                bounds = np.append(np.flatnonzero(_changes(bucket)), len(bucket))
                rows = cut(narrow(key, _NUMBER_KEY), bounds), cut(sums.view(np.uint8).reshape(-1, 12), bounds)
                out.append(message_rows(bucket[bounds[:-1]], chunk, _STATES + d - 1, *rows))
            if d <= s.depth:
                out.append(model.ask_runs(d).messages(chunk, _COUNTS + d + 1))
            return out

        return send

    def finish(chunk, table, got):
        model, _ = received(table, got, s.depth + 2)
        t, n_docs = model.t, table.num_rows
        base = np.log10((model.count[1] + 1.0) / (model.total + model.distinct + 1.0))
        per_doc = lambda w: np.bincount(t.doc, w, n_docs)
        return [
            pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks(),
                    pa.array(t.out),
                    pa.array(np.diff(t.first)),
                    pa.array(per_doc(model.count[1] > 0).astype(np.int64)),
                    pa.array(np.full(n_docs, model.total)),
                    pa.array(per_doc(base)),
                    pa.array(per_doc(np.log10(model.prob))),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )
        ]

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    settlers = {_COUNTS + 1: _settle_counts(1, 0, _numbered(s, 1))}
    for d in range(1, s.depth + 1):
        settlers[_COUNTS + d + 1] = _settle_counts(d + 1, s.min_next, _numbered(s, d + 1) if d < s.depth else None)
        settlers[_STATES + d] = _settle_states(_NUMBER_KEY, s.min_gain)
    told = [chunks.settle(chunks.first_round(ask_words), settlers)]
    for d in range(1, s.depth + 2):
        told.append(chunks.settle(chunks.next_round(told, pass_number(d)), settlers))
    return chunks.next_round(told, finish, schema)
