import re

import pytest
import xxhash

from quayside.llm import simhash


def brute(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, max_bits=4):
    parent = {i: i for i in prints}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "a b c", "a b c d", "A B c d e", "x " * 70_000, "é ÉA ß\x0bb\x1cc d e"]
)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute(text)


def test_groups_match_brute_force(spark, numbered_texts):
    df = spark.createDataFrame(numbered_texts, "doc_id long, text string, slot int")
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(df).collect()}
    prints = {i: brute(t) for i, t, _ in numbered_texts}
    assert got == groups(prints)
    assert len(set(got.values())) < len(got)


def test_large_groups_are_cut_and_stay_whole(spark):
    base = 0x0123456789ABCDEF
    prints = {i: base ^ (1 << (i % 40)) ^ (1 << (i // 40 + 20)) for i in range(400)}
    prints = {i: p for p, i in {p: i for i, p in reversed(prints.items())}.items()}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    df = spark.createDataFrame(signed, "node long, fp long")
    from quayside.llm.components import components

    for cells in (16, 10_000):
        edges = simhash.near_fingerprints(df, cell_rows=cells)
        found = {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}
        assert {i: found.get(i, i) for i in prints} == groups(prints)


def test_kept_documents(spark):
    rows = [(1, "a b c d e f", 1), (2, "A b c d e f", 2), (2, "A b c d e f", 2), (3, None, 3), (4, "", 4), (None, "x y", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3]
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_link_nothing(spark):
    """Each text of a repeated id counts for the group of its own fingerprint."""
    unlike = ["one two three four five six", "red green blue grey white black", "north south east west up down", "do re mi fa so la"]
    rows = [(1, unlike[0]), (5, unlike[0].upper()), (5, unlike[1]), (5, unlike[1].upper()), (7, unlike[1]), (7, unlike[2]), (8, None), (8, ""),
            (9, unlike[3]), (None, unlike[3])]
    df = spark.createDataFrame([(i, t, {"n": n}) for n, (i, t) in enumerate(rows)], "doc_id long, text string, first map<string,int>")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect() if r["doc_id"] != 8)
    assert got == [(0, unlike[3]), (1, unlike[0]), (5, unlike[1].upper()), (7, unlike[2]), (9, unlike[3])]
    assert [r["text"] for r in kept.filter("doc_id = 8").collect()] == [None]
    found = sorted((r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(df).collect() if r["doc_id"])
    assert found == [(1, 1), (5, 1), (5, 5), (5, 5), (7, 5), (7, 7), (8, 8), (8, 8), (9, 9)]
