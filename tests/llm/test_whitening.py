import numpy as np
import pytest

from veridq.llm import whitening as W


@pytest.mark.parametrize("low,high,n,d", [(-5, 5, 1, 1), (99_700, 100_300, 300, 9), (-(2**20), 2**20, 700, 5), (-(2**51), 2**51, 130, 3), (7, 8, 65, 4)])
def test_scatter_is_exact(low, high, n, d):
    x = np.random.default_rng(n).integers(low, high, (n, d))
    sums, cross = W.scatter(x)
    y = x.astype(object)
    assert (sums == y.sum(axis=0)).all() and (cross == y.T @ y).all()


def brute(vectors):
    """n, deviations, eigenvalues, trace and covariance of equally long vectors."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    t = n * x - s
    c = t / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return n, (t.astype(object) ** 2).sum(axis=1), e[::-1], u[:, ::-1], np.trace(v), c


def test_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) * 0.1
    rows = [(i, [float(a) for a in v], 1) for i, v in enumerate(base.astype(np.float32))]
    rows += [rows[0], (None, rows[1][1], 1)]  # a repeated row and a null id count
    bad = [(900, None, 1), (901, [], 1), (902, [1.0] * 11 + [None], 1), (903, [float("nan")] * 12, 1), (904, [float("-inf")] * 12, 1), (905, [1e30] * 12, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n int").repartition(5)
    got = W.whiten(df).collect()
    n, dev, e, u, trace, c = brute([r[1] for r in rows])
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    want = c @ u[:, :8] / np.sqrt(e[:8])
    of = {i: (dev[k], want[k]) for k, (i, _, _) in enumerate(rows)}
    sign = {}
    for r in got:
        d, w = of[r.vec_id]
        assert r.deviation == d and int(r.deviation_exact) == d
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(w[r.component - 1]), abs=1e-6)
        if abs(r.whitened) > 1e-3:
            sign.setdefault(r.component, set()).add(np.sign(r.whitened) * np.sign(w[r.component - 1]))
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in sign.values())


def test_defined_cases(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 5.0, 3.0]), (3, [0.5]), (4, [0.25]), (5, [0.25]), (6, [2.0, 2.0]), (7, [1e11, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in W.whiten(df).collect()}
    assert {r.dim: r.n for r in got.values()} == {1: 3, 2: 1, 3: 3}  # each length by itself
    assert sorted(got) == sorted((i, k) for i, v in rows for k in range(1, len(v) + 1))
    assert got[6, 1].whitened == 0.0 and got[6, 1].explained == 0.0 and got[6, 1].identity_error == 0.0
    assert got[7, 1].deviation is None and int(got[7, 1].deviation_exact) > 2**63
    assert got[3, 1].whitened == pytest.approx(2**0.5) and got[4, 1].whitened == got[5, 1].whitened
    assert all(r.identity_error < 1e-6 for r in got.values())
    assert W.whiten(df.limit(0)).collect() == []
    same = spark.createDataFrame([(i, [0.5, -0.5]) for i in range(4)], "vec_id long, embedding array<float>")
    assert {(r.whitened, r.deviation) for r in W.whiten(same).collect()} == {(0.0, 0)}


def test_long_vectors(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(a) for a in rng.normal(size=300)]) for i in range(40)], "vec_id long, embedding array<float>")
    got = W.whiten(df).collect()
    assert len(got) == 320 and max(r.identity_error for r in got) < 1e-9
