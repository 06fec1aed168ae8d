import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm.chunks import questions
from quayside.llm.suffix_tree import (
    Settings, _key_bytes, _keys, _run_keys, _Runs, _settle_counts, _settle_states, score_documents,
)


def tokens(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", data), None]


def brute(rows, s):
    """The same tree from plain dictionaries."""
    docs = [(i, tokens(t), i is not None and zlib.crc32(str(i).encode()) % s.folds == s.held_out) for i, t in rows]
    count = Counter()
    for _, t, out in docs:
        if not out:
            count.update(tuple(t[i : i + n]) for n in range(1, s.depth + 2) for i in range(len(t) - n + 1))
    total = sum(c for k, c in count.items() if len(k) == 1)
    distinct = sum(len(k) == 1 for k in count)
    followers = defaultdict(list)
    for k, c in count.items():
        if len(k) > 1 and c >= s.min_next:
            followers[k[:-1]].append((k[-1], c))
    states = {}

    def prob(context, word):
        p = (count[(word,)] + 1) / (total + distinct + 1)
        for n in range(1, len(context) + 1):
            state = states.get(context[len(context) - n :])
            if state:
                own = count[(*context[len(context) - n :], word)]
                own = own if own >= s.min_next else 0
                p = max(own - s.discount, 0) / state[0] + state[1] * p
        return p

    for n in range(1, s.depth + 1):
        for context, found in [(c, f) for c, f in followers.items() if len(c) == n]:
            size = count[context]
            if size < s.min_context:
                continue
            gain = sum(c * math.log(c / size / prob(context[1:], w)) for w, c in found)
            if gain >= s.min_gain:
                states[context] = (size, 1 - (sum(c for _, c in found) - s.discount * len(found)) / size)
    out = []
    for i, t, held in docs:
        base = sum(math.log10((count[(w,)] + 1) / (total + distinct + 1)) for w in t)
        score = sum(math.log10(prob(tuple(t[max(0, k - s.depth) : k]), w)) for k, w in enumerate(t))
        out.append((i, held, len(t), sum(count[(w,)] > 0 for w in t), total, base, score))
    return out


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_matches_plain_counts(spark, numbered_texts, depth):
    rows = [(i, t) for i, t, _ in numbered_texts] + [(3, "again again"), (None, "no id")]
    s = Settings(depth=depth, min_context=4, min_gain=3.0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in score_documents(df, settings=s).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    want = sorted(brute(rows, s), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-5)
    assert sum(g[6] for g in got) > sum(g[5] for g in got) + 100


def test_answers_tell_of_retained_contexts_only():
    hashes = np.array([5 << 40, 9 << 40], np.uint64)
    sums = [np.array([[2, 30, 7.0], [1, 20, 7.0]], "<f4"), np.array([[1, 10, 2.0], [0, 0, 0.5]], "<f4")]
    asked = pa.Table.from_batches([
        questions(1, chunk, hashes, _keys(hashes, 2), given.view(np.uint8).reshape(-1, 12)) for chunk, given in enumerate(sums)
    ])
    told = _settle_states(_key_bytes(2), 8.0)(asked)
    for answer in told["data"].to_pylist():
        assert np.frombuffer(answer, "<f4").reshape(-1, 2).tolist() == [[3, 40], [0, 0]]


class Train:
    def __init__(self, n):
        self.train = np.ones(n, bool)


def drawn_runs(seed, n, n_buckets):
    """Runs of a context and a word, both of numbers that fall in frequency, a fifth of them in context 3."""
    r = np.random.default_rng(seed)
    context, word = (np.minimum(r.zipf(1.3, n), 50_000).astype(np.uint64) for _ in range(2))
    context[: n // 5] = 3
    runs = _Runs(Train(n), context, word, np.arange(n))
    share = np.bincount((runs.hash >> np.uint64(32)).astype(np.int64), runs.train)[runs.hash >> np.uint64(32)] / n
    runs.deal(n_buckets, share)
    return runs


def test_runs_are_sent_in_fewer_bytes_than_hashes():
    runs = drawn_runs(1, 200_000, 10)
    sent = runs.messages(0, 102)
    assert sum(len(v) for v in sent["data"].to_pylist()) < 2.5 * len(runs.hash)


@pytest.mark.parametrize("n_buckets", [1, 16])
def test_runs_keep_apart_and_frequent_contexts_are_split(n_buckets):
    chunks = [drawn_runs(0, 40_000, n_buckets)] * 2
    sent = pa.Table.from_batches([c.messages(i, 102) for i, c in enumerate(chunks)])
    told, loads = [], []
    for bucket in range(n_buckets):
        asked = sent.filter(pa.array(sent["bucket"].to_numpy() == bucket))
        keys, per_row = _run_keys(asked)
        assert len(np.unique(keys[: per_row[0]])) == per_row[0]
        loads.append(per_row[0])
        raw = [c.train[c.order].astype("<u4")[c.bucket == bucket].tobytes() for c in chunks]
        asked = asked.set_column(4, "more", pa.array(raw, pa.binary()))
        told.append(_settle_counts(2, 2, None)(asked)["data"][0].as_py())
    assert max(loads) < 2 * sum(loads) / n_buckets
    counts = chunks[0].back(np.frombuffer(b"".join(told), np.uint8) & 127)
    assert counts.tolist() == np.minimum(2 * chunks[0].train, 127).tolist()


def test_empty(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
