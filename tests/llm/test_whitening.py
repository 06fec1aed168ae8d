import numpy as np
import pytest

from quayside.llm.queries import op11_whitening
from quayside.llm.whitening import exact_gram, exact_sums, fit_whitening, refined_eigen, whiten

SPECTRA = {
    "spread": np.linspace(1, 100, 24),
    "clusters": np.r_[50 + 1e-9 * np.arange(8), np.linspace(1, 10, 16)],
    "tight": 50 + 1e-12 * np.arange(24.0),
    "wide": np.geomspace(1e-12, 1e6, 24),
    "rank": np.r_[np.zeros(12), np.arange(1, 13.0)],
    "equal": np.r_[np.full(12, 3.0), np.full(12, 4.0)],
}


@pytest.mark.parametrize("kind", SPECTRA)
def test_eigenvectors_to_double_precision(kind):
    values = SPECTRA[kind].astype(np.longdouble)
    u = np.linalg.qr(np.random.default_rng(1).standard_normal((24, 24)))[0].astype(np.longdouble)
    for _ in range(4):
        u = u + u @ (np.eye(24) - u.T @ u) / 2
    a = (u * values) @ u.T
    a = (a + a.T) / 2
    found, x = refined_eigen(a)
    scale = values.max()
    assert np.abs(np.sort(values)[::-1] - found).max() < 1e-16 * scale
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-16 * scale


def test_well_separated_vectors_are_right_to_the_last_digits():
    rng = np.random.default_rng(2)
    u = np.linalg.qr(rng.standard_normal((16, 16)))[0].astype(np.longdouble)
    for _ in range(4):
        u = u + u @ (np.eye(16) - u.T @ u) / 2
    a = (u * np.arange(16, 0, -1)) @ u.T
    x = refined_eigen((a + a.T) / 2)[1].astype(np.float64)
    assert np.abs(np.abs((x * u).sum(axis=0)) - 1).max() < 1e-15
    assert np.abs(np.abs(x) - np.abs(u.astype(np.float64))).max() < 1e-15


def test_products_are_exact_beyond_double():
    rng = np.random.default_rng(3)
    for bound in (50, 2**20, 2**30, 2**50):
        z = rng.integers(-bound, bound, (300, 5))
        want = [sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for i in range(5) for j in range(i, 5)]
        assert exact_gram(z).tolist() == want
        assert exact_sums(z).tolist() == [sum(map(int, z[:, i])) for i in range(5)]


def plain(x):
    """Covariance, eigenvalues and whitened values by whole numbers and numpy."""
    n, total = len(x), x.sum(axis=0)
    y = n * x - total
    cov = np.array([[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(x.shape[1])] for i in range(x.shape[1])], dtype=object)
    values, axes = np.linalg.eigh((cov / n**3).astype(np.float64))
    return y, values[::-1], axes[:, ::-1]


def test_query_equals_plain_computation(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((400, 10)) * np.geomspace(3, 0.1, 10)).astype(np.float32)
    rows = [(i, [float(v) for v in x], "a", 1) for i, x in enumerate(vectors)]
    odd = [(900, None, "a", 1), (901, [float("nan")] * 10, "a", 1), (902, [None] * 10, "a", 1), (903, [float("-inf")] * 10, "a", 1), (904, [1.0, 2.0], "a", 1)]
    repeated = [(5, rows[7][1], "b", 2), (None, rows[8][1], "b", 2)]
    df = spark.createDataFrame(rows + odd + repeated, "vec_id long, embedding array<float>, n string, component long")
    df.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op11_whitening(spark, str(tmp_path))
    types = dict(got.dtypes)
    assert (types["component"], types["n"], types["deviation"], types["whitened"]) == ("int", "bigint", "bigint", "double")
    got = got.collect()
    x = np.floor(1024 * np.vstack([vectors, vectors[7:9]]).astype(np.float64)).astype(np.int64) + 100_000
    y, values, axes = plain(x)
    white = (y / len(x)) @ axes[:, :8] / np.sqrt(values[:8])
    assert len(got) == 8 * len(x) and {r.n for r in got} == {len(x)}
    shown = {}
    for r in got:
        if r.vec_id is not None and r.vec_id != 5:
            shown[r.vec_id, r.component] = r
    sign = [1 if shown[0, c + 1].whitened * white[0, c] > 0 else -1 for c in range(8)]
    for (i, c), r in shown.items():
        assert r.deviation == int((y[i] ** 2).sum())
        assert abs(r.whitened - sign[c - 1] * white[i, c - 1]) < 1e-10
        assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-10
        assert r.identity_error < 1e-10
    errors = {r.identity_error for r in got}
    assert len(errors) == 1


def test_little_or_no_variance(spark):
    schema = "vec_id long, x array<bigint>, deviation string, w string, _qs_row string"

    def run(vectors):
        df = spark.createDataFrame([(i, v, "d", "w", "r") for i, v in enumerate(vectors)], schema)
        return whiten(df, fit_whitening(df, "x"), "x").collect()

    assert run([]) == [] and run([None, None]) == [] and run([[], []]) == []
    same = run([[5, 6, 7]] * 3)
    assert [r.component for r in same] == [1, 2, 3] * 3
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 and r._qs_row.w == "w" for r in same)
    flat = run([[i, 2 * i, 0] for i in range(5)])
    assert {r.component: r.whitened is None for r in flat} == {1: False, 2: True, 3: True}
    assert abs(flat[0].explained - 1) < 1e-12 and flat[0].identity_error < 1e-12
    one = run([[1, 2]])
    assert len(one) == 2 and one[0].whitened is None


def test_deviation_beyond_a_long_is_null_and_large_numbers_are_exact(spark):
    rows = [(i, [2**45 * (i % 2), 3 * i, 2**44 + i]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, x array<bigint>")
    model = fit_whitening(df, "x")
    y, values, axes = plain(np.array([r[1] for r in rows], dtype=object))
    got = whiten(df, model, "x").collect()
    assert all(r.deviation is None for r in got)
    top = {r._qs_row.vec_id: r.whitened for r in got if r.component == 1}
    assert all(abs(abs(top[i]) - 1) < 1e-9 for i in top) and model.sums == [sum(r[1][k] for r in rows) for k in range(3)]
