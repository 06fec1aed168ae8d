import math

import numpy as np
import pytest

from quayside.llm.near_vectors import agree_chance, near_vectors, plan_for

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(seed=1, n=240, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.standard_normal(width)
        if i % 3:
            x = np.array(rows[i - 1][1]) + rng.standard_normal(width) * rng.choice([0.0, 0.05, 0.25])
        rows.append((i, [float(v) for v in x.astype(np.float32)], None if i % 41 == 40 else i // 60))
    return rows


def brute(rows, least=0.93):
    good = {
        i: (np.array(v, float), lab) for i, v, lab in rows
        if v is not None and lab is not None and i is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)
    }
    links = {i: [] for i, _, _ in rows}
    for i, (x, a) in good.items():
        for j, (y, b) in good.items():
            if i != j and a == b and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i].append(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


@pytest.mark.parametrize("cell_rows", [4096, 4])
def test_matches_brute_force(spark, cell_rows):
    rows = clusters()
    nan, inf = float("nan"), float("inf")
    zero = [0.0] * 16
    rows += [(900, None, 1), (901, zero, 1), (902, [nan, *zero[1:]], 1), (903, [inf, *zero[1:]], 1), (904, [None, *zero[1:]], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in near_vectors(df, recall=0.999999, cell_rows=cell_rows).collect()}
    assert got == brute(rows)
    assert sum(v[0] for v in got.values()) > 100


def test_many_equal_vectors_and_empty(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [2.0, -1.0], 5) for i in range(300)]
    got = {r[0]: tuple(r)[1:] for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[299] == (199, 1, False) and got[0] == (99, 0, True)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_ids_with_unlike_vectors(spark):
    """Each row is a vector of its own: what one of them links with says nothing about the other."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.1], 0), (3, [0.1, 1.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 0.0], 9)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(
        [(1, 1, 1, True), (1, 2, 0, False), (2, 1, 1, False), (3, 2, 0, False), (0, 2, 0, True), (1, 0, 1, True)]
    )


def test_plan():
    assert agree_chance(0.0, 2.0) == 1.0
    plan = plan_for(5000)
    chance = agree_chance(math.sqrt(0.14), 2.0) ** plan.rows
    assert 1 - (1 - chance) ** plan.tables >= 0.998
