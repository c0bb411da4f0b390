import numpy as np
import pytest

from supportlens.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, n string, component string"


def brute(rows, count=16):
    """{(vec_id, component): (deviation, whitened up to its sign, explained)} by a dense eigenvalue solver on exact differences."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in usable]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    differences = lambda v: [n * c - s for c, s in zip(v, sums)]
    d = np.array([differences(v) for v in fit], float) / n
    cov = d.T @ d / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    out = {}
    for (i, _), v in zip(usable, x):
        whole = differences(v)
        w = np.array(whole, float) / n @ u / np.sqrt(e)
        for k in range(len(e)):
            out[i, k + 1] = (n, sum(c * c for c in whole), w[k], e[k] / np.trace(cov))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


def agrees(found, want):
    assert sorted((r.vec_id, r.component) for r in found) == sorted(want)
    components = {k for _, k in want}
    for k in components:
        mine = np.array([r.whitened for r in sorted((r for r in found if r.component == k), key=lambda r: r.vec_id)])
        theirs = np.array([v[2] for (i, c), v in sorted(want.items()) if c == k])
        assert np.allclose(mine * np.sign(mine @ theirs), theirs, atol=1e-8)
    for r in found:
        n, deviation, _, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-10) and r.identity_error < 1e-10


@pytest.mark.parametrize("dim, n, seed", [(40, 300, 1), (20, 60, 2), (3, 50, 3), (1, 9, 4)])
def test_like_dense_solver(spark, dim, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * np.exp(-0.1 * np.arange(dim)) * 3
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(n + i, x[0].tolist()) for i in range(n // 2)]
    agrees(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agrees(queries.QUERIES["op11_jacobi_whitening"](spark, SMALL).collect(), brute(rows))


def test_large_common_part(spark):
    """Entries far from zero lose nothing: 64 c is exact in a float here."""
    rng = np.random.default_rng(5)
    x = 100_000.0 + rng.integers(-40, 40, (200, 6)) / 64
    rows = list(enumerate(x.tolist()))
    agrees(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


def test_numbers_beyond_longs(spark):
    rows = [(1, [3e37, 1.0]), (2, [-3e37, 2.0]), (3, [0.0, 5.0]), (4, [1.0, -4.0])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 8 and all(r.deviation is None for r in found if r.vec_id in (1, 2))
    assert all(r.identity_error < 1e-9 for r in found)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 4.0]), (2, None), (3, []), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [1.0]), (8, [3.0, 0.5]), (9, [1.0, 2.0, 3.0]),
    ]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted((i, k) for i in (0, 1, 1, 8) for k in (1, 2))
    assert {r.n for r in found} == {3}


def test_without_variance(spark):
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in same] == [(None, 0.0, 0.0, 0)] * 4
    flat = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert {(r.component, r.whitened) for r in flat if r.component == 2} == {(2, None)}
    assert sorted(round(r.whitened, 12) for r in flat if r.component == 1) == [-1, 1]


def test_empty_tables(spark):
    for rows in ([], [(1, None)]):
        found = whitening.whiten(frame(spark, rows))
        assert found.count() == 0
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("dim", [30, 120, 400])
def test_solver(dim):
    """Spread, clustered and low-rank spectra, by products alone."""
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    low = np.zeros(dim)
    low[: dim // 8] = 7.0
    for e in (np.sort(rng.random(dim))[::-1] * 100, np.r_[[10.0] * 3, np.full(dim - 3, 5.0)], low, np.exp(-0.3 * np.arange(dim))):
        matrix = (q * e) @ q.T
        matrix = (matrix + matrix.T) / 2
        values, vectors = whitening.leading(lambda u, m=matrix: m @ u, dim, 16)
        assert np.allclose(values, np.sort(e)[::-1][:16], atol=1e-13 * e.max() * dim)
        assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * e.max() * dim
        assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)


def test_corrections_solve():
    """With enough steps the corrections are the exact solutions on the complement of q."""
    rng = np.random.default_rng(7)
    dim = 25
    matrix = rng.normal(size=(dim, dim))
    matrix = matrix @ matrix.T
    q, _ = np.linalg.qr(rng.normal(size=(dim, 3)))
    off = np.eye(dim) - q @ q.T
    residual, theta = off @ rng.normal(size=(dim, 2)), np.array([300.0, 200.0])
    t = whitening.corrections(lambda u: matrix @ u, q, theta, residual, 80)
    for k in range(2):
        assert np.allclose(off @ (matrix - theta[k] * np.eye(dim)) @ off @ t[:, k], -residual[:, k], atol=1e-8)
    assert np.allclose(q.T @ t, 0, atol=1e-10)
