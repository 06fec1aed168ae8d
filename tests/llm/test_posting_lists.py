import numpy as np

from quayside.llm.posting_lists import fit_centroids, nearest

SCHEMA = "vec_id long, embedding array<double>"


def exact(rows, query, k):
    x = {i: np.array(v) for i, v in rows}
    scored = sorted(((-float(x[query] @ v), i) for i, v in x.items() if i != query))
    return [(i, -s) for s, i in scored[:k]]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.standard_normal(12) * (1 + i % 5)]) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in nearest(df, df.filter("vec_id % 100 = 0"), list_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    for q, found in got.items():
        want = exact(rows, q, 20)
        assert [f[0] for f in found] == list(range(1, 21))
        hit += len({f[1] for f in found} & {w[0] for w in want})
        x = dict(rows)
        assert all(abs(f[2] - float(np.dot(x[q], x[f[1]]))) < 1e-9 for f in found)
    assert len(got) == 30 and hit / 600 >= 0.9


def test_ties_few_candidates_and_unusable(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(60, None), (61, [0.0, 0.0]), (62, [float("nan"), 1.0]), (63, [None, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, df.filter("vec_id in (0, 7, 60, 61)")).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 7] == [i for i in range(21) if i != 7]
    assert {r["query_id"] for r in got} == {0, 7}
    few = df.filter("vec_id < 3")
    assert [r["vec_id"] for r in nearest(few, few.filter("vec_id = 1")).orderBy("rank").collect()] == [0, 2]
    none = df.filter("vec_id > 100")
    assert nearest(none, none).count() == 0


def test_graph_finds_all_near_centroids():
    rng = np.random.default_rng(4)
    graph = fit_centroids(rng.standard_normal((4000, 6)), 64)
    for point in rng.standard_normal((50, 6)):
        far = np.sqrt(((graph.centroids - point) ** 2).sum(axis=1))
        assert set(graph.within(point, 1.1)) == set(np.flatnonzero(far <= 1.1 * far.min()))


def test_small_clusters_far_apart_give_k(spark):
    """A query whose near lists hold fewer than k others reads further ones."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((64, 16)) * 10
    rows = [(i, [float(c) for c in centres[i % 64] + 0.01 * rng.standard_normal(16)]) for i in range(512)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in nearest(df, df.filter("vec_id < 20"), list_rows=8, replicas=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert set(got) == set(range(20))
    assert all([f[0] for f in found] == list(range(1, 21)) and len({f[1] for f in found}) == 20 for found in got.values())
    few = df.filter("vec_id < 15")
    assert nearest(few, few, list_rows=2, replicas=1).groupBy("query_id").count().filter("count <> 14").count() == 0
