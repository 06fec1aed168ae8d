import re

import pytest

from quayside.llm.substrings import dedup_substrings, find_repeats

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(n_words, n_removed, kept) by id, scanning all windows in the order of ids and texts."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, (r[1] or "").encode())):
        words = WORDS.findall((text or "").encode())
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append((i, len(words), sum(gone), kept))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("window", [20, 6])
def test_matches_brute_force(spark, numbered_texts, window):
    rows = [(i, t) for i, t, _ in numbered_texts]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = find_repeats(df, window=window).select("doc_id", "n_words", "n_removed", "kept_text")
    got = sorted((tuple(r) for r in found.collect()), key=key)
    expected = sorted(brute(rows, window), key=key)
    assert got == expected
    assert sum(r[2] for r in got) > 300


def test_repeated_rows_null_ids_and_spans(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "a"), (1, text, "a"), (None, text, "b"), (0, "short", "c"), (2, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string")
    got = {(r["doc_id"], r["n_removed"]): r for r in find_repeats(df).collect()}
    assert set(got) == {(1, 0), (1, 30), (None, 30), (0, 0), (2, 0)}
    assert [tuple(s) for s in got[(1, 30)]["spans"]] == [(0, 30)]
    cut = dedup_substrings(df)
    assert cut.columns == df.columns
    assert sorted(((9 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in cut.collect()), key=str) == sorted(
        [(1, text), (1, ""), (9, ""), (0, "short"), (2, None)], key=str
    )
    assert find_repeats(df.limit(0)).count() == 0


def test_odd_window_is_refused(spark):
    with pytest.raises(ValueError):
        find_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window=5)
