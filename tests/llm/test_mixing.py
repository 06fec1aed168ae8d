import numpy as np
import pytest

from quayside.llm.mixing import mix_report, mix_sources, mixed_documents, permute, targets


def water_fill(sizes, weights):
    """Targets by bisection on the common level."""
    total, low, high = 1.5 * sum(sizes), 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(mid * w, 2 * z) for w, z in zip(weights, sizes)) < total else (low, mid)
    return [min(low * w, 2 * z) for w, z in zip(weights, sizes)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 5, 80, 0, 7], [500], [0, 0], [3, 1, 1000, 1]])
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    got = targets(sizes, weights)
    assert got == pytest.approx(water_fill(sizes, weights), rel=1e-9, abs=1e-6)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


def test_permutation():
    for n in (1, 2, 7, 1000):
        x = permute(np.arange(n), np.full(n, n), np.full(n, 12345, np.uint64))
        assert sorted(x.tolist()) == list(range(n))
    assert (x != np.arange(n)).mean() > 0.9


def rows(texts):
    out = [(i, t, ["a", "b", None, "é", ""][i % 5]) for i, t, _ in texts]
    return [*out, (3, "same id twice", "b"), (3, "same id twice", "b"), (None, "no id here", "a")]


def test_totals_and_limits(spark, numbered_texts):
    given = rows(numbered_texts)
    df = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(4)
    mixed = mix_sources(df, block=16, shard_slots=32)
    report = mix_report(mixed).collect()
    again = mix_report(mix_sources(df.repartition(7), block=16, shard_slots=32)).collect()
    assert sorted(map(str, report)) == sorted(map(str, again))
    assert len(report) == len(given)
    by = {}
    for r in report:
        assert r["taken"] <= 2 * r["size"]
        size, taken, target = by.get(r["source"], (0, 0, r["target"]))
        by[r["source"]] = (size + r["size"], taken + r["taken"], target)
        assert r["size"] == len((next(t for i, t, _ in given if i == r["doc_id"]) or "").split()) or r["doc_id"] == 3
    ranked = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    assert [by[s][2] for s in ranked] == pytest.approx(water_fill([by[s][0] for s in ranked], [3, 1, 2, 3, 1]))
    for size, taken, target in by.values():
        assert abs(taken - target) < 1 + 1e-6
    shards = mixed.pieces.groupBy("shard").agg({"slot": "count"}).count()
    assert shards > 3


def test_texts_are_what_is_taken(spark, numbered_texts):
    given = rows(numbered_texts)
    df = spark.createDataFrame(given, "doc_id long, text string, source string")
    report = {(r["doc_id"], r["source"], r["taken"]) for r in mix_report(mix_sources(df, block=16)).collect() if r["taken"]}
    out = mixed_documents(df, block=16)
    assert out.columns == df.columns
    got = out.collect()
    assert {(r["doc_id"], r["source"], len(r["text"].split())) for r in got} == report
    texts = {i: t for i, t, _ in given}
    for r in got:
        if r["doc_id"] != 3:
            assert set(r["text"].split()) <= set(texts[r["doc_id"]].split())


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_report(mix_sources(df)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], df.schema)
    assert [(r["taken"], r["target"]) for r in mix_report(mix_sources(blank)).collect()] == [(0, 0.0)] * 2
