import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import top_products as module
from quayside.llm.queries import op12_top_products
from quayside.llm.top_products import top_products

SCHEMA = "vec_id long, x array<bigint>"


def brute(rows, asks, k=5):
    """rows: (id, list or None). Rows are their places; shorter vectors end in zeros."""
    usable = [(p, i, x) for p, (i, x) in enumerate(rows) if x is not None and sum(v * v for v in x) < 2**62]
    out = []
    for p, i, x in usable:
        if i is None or not asks(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j is None, j or 0, j) for o, j, y in usable if o != p]
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, rows, condition, k=5):
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_products(df, F.expr(condition), k=k)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("shape", ["even", "skewed", "low_rank", "equal_lengths"])
def test_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(module, "PROBES", 30)
    monkeypatch.setattr(module, "GROUP_ROWS", 25)
    monkeypatch.setattr(module, "STEP_ROWS", 16)
    rng = np.random.default_rng(len(shape))
    x = rng.integers(-300, 300, (600, 12))
    if shape == "skewed":
        x = (x * rng.pareto(1.5, (600, 1))).astype(np.int64)
    if shape == "low_rank":
        x = rng.integers(-9, 9, (600, 2)) @ rng.integers(-9, 9, (2, 12))
    if shape == "equal_lengths":
        x = np.sign(x) * 100
    rows = [(i, [int(v) for v in x[i]]) for i in range(600)]
    assert found(spark, rows, "vec_id % 9 = 0") == brute(rows, lambda i: i % 9 == 0)


def test_a_bound_prunes_blocks_and_rows():
    rng = np.random.default_rng(1)
    c = rng.integers(-5, 5, (4000, 8))
    c[:20] *= 200
    c = c[np.argsort(-(c**2).sum(axis=1))]
    rows = np.arange(4000)
    q = rng.integers(-5, 5, (3, 8))
    best = module.best_in_block(q, np.array([-1, -2, -3]), np.full(3, -np.inf), c, rows, rows, np.eye(8), 5)
    want = {(i, j) for i in range(3) for j in np.lexsort((rows, -(c @ q[i])))[:5].tolist()}
    assert set(zip(best.query.tolist(), best.place.tolist())) == want


def test_ties_repeats_nulls_and_odd_lengths(spark):
    rows = [(i, [1, 2]) for i in range(12)]
    rows += [(0, [1, 2]), (0, [5, 5]), (None, [1, 2]), (None, [9, 9]), (20, None), (30, []), (40, [3]), (50, [1, 2, 3, 4])]
    rows += [(60, [-4, -4]), (70, [2**40, 2**40])]
    assert found(spark, rows, "vec_id % 10 = 0") == brute(rows, lambda i: i % 10 == 0)
    few = [(0, [1, 1]), (1, [2, 2]), (2, [2, 2])]
    assert found(spark, few, "vec_id = 0") == [(0, 1, 1, 4), (0, 2, 2, 4)]
    assert found(spark, few[:1], "vec_id = 0") == []
    assert found(spark, few, "vec_id > 5") == [] and found(spark, [(1, None)], "vec_id = 1") == []
    assert found(spark, [], "vec_id = 1") == []


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [int(v) for v in rng.integers(-(2**29), 2**29, 6)]) for i in range(200)]
    assert found(spark, rows, "vec_id % 50 = 0") == brute(rows, lambda i: i % 50 == 0)


def test_query_scales_and_leaves_out(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = {i: [float(v) for v in rng.standard_normal(4)] for i in range(120)}
    given = [(i, v, "a", 0.5) for i, v in vectors.items()]
    given += [(200, None, "a", 0.0), (250, [float("nan"), 1.0, 1.0, 1.0], "a", 0.0), (300, [float("inf"), 1.0, 1.0, 1.0], "a", 0.0), (350, [None, 1.0, 1.0, 1.0], "a", 0.0), (400, [0.0] * 4, "a", 0.0)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>, x string, far double")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    whole = [(i, None if v is None else [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in vectors.items()]
    whole.append((400, [0, 0, 0, 0]))
    got = sorted([tuple(r) for r in op12_top_products(spark, str(tmp_path)).collect()], key=str)
    assert got == brute(whole, lambda i: i % 50 == 0)
