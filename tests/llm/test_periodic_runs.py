import hashlib
import random
import zlib

import numpy as np

from quayside.llm.periodic_runs import (
    CommonExtensions,
    SuffixTree,
    collapse_runs,
    find_runs,
    repeating_stretches,
    runs_of,
)
from quayside.llm.queries import op13_periodic_runs
from quayside.llm.wordhash import Words


def brute_runs(words, least):
    """Every maximal stretch for every distance; of equal stretches the smallest distance is the period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(r):
    words = [r.randint(1, r.choice([1, 2, 3, 5, 40])) for _ in range(r.randint(0, 70))]
    if len(words) > 6 and r.random() < 0.5:
        a = r.randrange(len(words))
        p = 1 + (len(words) - a) // (3 + r.randrange(8))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_all_runs_are_found():
    r = random.Random(3)
    for _ in range(600):
        words, least = some_words(r), r.choice([2, 3, 7, 12])
        assert [tuple(x) for x in runs_of(words, least).tolist()] == brute_runs(words, least), (words, least)


def test_common_extensions_and_leaf_order():
    r = random.Random(4)
    for _ in range(40):
        text = [r.randint(1, 3) for _ in range(r.randint(2, 50))]
        tree = SuffixTree(text)
        suffixes = [[*text[i:], 0] for i in range(len(text) + 1)]
        assert tree.tour()[0].tolist() == sorted(range(len(suffixes)), key=lambda i: suffixes[i])
        turned = [[0 if c == 0 else 9 - c for c in s] for s in suffixes]
        assert tree.tour(reverse=True)[0].tolist() == sorted(range(len(suffixes)), key=lambda i: turned[i])
        pairs = [(i, j) for i in range(len(suffixes)) for j in range(len(suffixes)) if i != j]
        i, j = np.array(pairs).T
        want = [next((k for k, (a, b) in enumerate(zip(suffixes[x], suffixes[y])) if a != b)) for x, y in pairs]
        assert CommonExtensions(tree)(i, j).tolist() == want


def test_stretches_hold_every_run():
    r = random.Random(5)
    for _ in range(300):
        words, least = some_words(r), r.choice([2, 5, 12])
        text = " ".join(map(str, words)).encode()
        starts, ends = repeating_stretches(Words(np.frombuffer(text, np.uint8), np.array([0, len(text)])), least)
        for s, n, _ in brute_runs(words, least):
            assert any(a <= s and s + n <= b for a, b in zip(starts, ends))


def test_rows_nulls_and_clashing_columns(spark, numbered_texts):
    columns = "doc_id long, text string, runs long, kept_text string, _qs_row string, n_words string"
    rows = [(i, t, 7, "x", "y", "z") for i, t, _ in numbered_texts]
    rows += [(None, "a b " * 9, 7, "x", "y", "z"), (None, "a b " * 9, 7, "x", "y", "z"), (3, "é " * 12, 7, "x", "y", "z")]
    docs = spark.createDataFrame(rows, columns)
    got = find_runs(docs).select("_qs_row.doc_id", "n_words", "runs", "kept_text").collect()
    assert len(got) == len(rows)
    want = []
    for i, t, *_ in rows:
        words = (t or "").split()
        runs = brute_runs(words, 12) if len(words) < 2000 else []
        want.append((i, len(words), runs, " ".join(brute_kept(words, runs))))
    seen = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in got]
    assert sorted(seen, key=str) == sorted(want, key=str)
    cut = collapse_runs(docs)
    assert cut.columns == docs.columns and cut.schema == docs.schema
    assert {r.text for r in cut.filter("doc_id is null").collect()} == {"a b"}
    assert cut.filter("runs = 7 and kept_text = 'x' and n_words = 'z'").count() == len(rows)
    assert find_runs(docs.limit(0)).count() == 0


def test_a_long_text_of_one_word_and_many_stretches(spark):
    r = random.Random(6)
    parts = []
    for k in range(300):
        parts += [f"own{k}x{i}" for i in range(20)] + [f"p{k % 7}", f"q{k}"] * r.randint(6, 9)
    docs = spark.createDataFrame([(1, "loop " * 50_000), (2, " ".join(parts))], "doc_id long, text string")
    one, many = find_runs(docs).orderBy("n_words", ascending=False).collect()
    assert [tuple(x) for x in one.runs] == [(0, 50_000, 1)] and one.kept_text == "loop"
    assert [tuple(x) for x in many.runs] == brute_runs(parts, 12) and len(many.runs) == 300


def test_query_makes_tails_periodic(spark, tmp_path):
    r = random.Random(7)
    texts = [(i, " \n".join(r.choice("abcdefgh") * 3 for _ in range(r.randint(0, 80)))) for i in range(-20, 200)]
    texts += [(500, None), (None, "a b " * 9)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x for x in op13_periodic_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for i, t in texts:
        words = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        runs = brute_runs(words, 12)
        x = got[i]
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        best = min(runs, key=lambda z: (-z[1], z[0], z[2]), default=None)
        assert x.n_runs == len(runs) and x.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(" ".join(brute_kept(words, runs)).encode()).hexdigest()
        assert (x.start, x.length, x.period) == (best or (None, None, None))
        assert x.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert changed > 10 and dict(op13_periodic_runs(spark, str(tmp_path)).dtypes)["exponent_milli"] == "bigint"
