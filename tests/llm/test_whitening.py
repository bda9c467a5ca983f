import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from netwatch.llm.whitening import jacobi_davidson, minres, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=8):
    """Exact integers and a dense eigensolver."""
    kept = [(i, v) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    off = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    centred = np.array(off, float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return [i for i, _ in kept], [sum(c * c for c in r) for r in off], e, centred @ u, np.trace(cov)


def check(spark, rows, live=8):
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    got = got.orderBy("component", "vec_id", "deviation").collect()
    ids, deviation, e, projected, trace = brute(rows)
    k = len(e)
    assert len(got) == len(ids) * k
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, deviation[i]))
    z = np.full((len(ids), k), np.nan)
    for c in range(k):
        for i, row in zip(order, got[c * len(ids):(c + 1) * len(ids)]):
            assert (row.vec_id, row.component, row.n, row.deviation) == (ids[i], c + 1, len(ids), deviation[i])
            assert int(row.deviation_exact) == deviation[i]
            z[i, c] = np.nan if row.whitened is None else row.whitened
            assert row.explained == pytest.approx(e[c] / trace if c < live else 0, rel=1e-10, abs=1e-14)
            assert row.identity_error < 1e-9
    for c in range(live):
        want = projected[:, c] / math.sqrt(e[c])
        sign = np.sign((z[:, c] * want).sum())
        assert np.abs(sign * z[:, c] - want).max() < 1e-7
    assert np.isnan(z[:, live:]).all()
    return got


def random_rows(n, d, seed=0, spread=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * (np.linspace(1.0, 0.3, d) if spread is None else spread)
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def test_against_dense_solver(spark):
    check(spark, random_rows(500, 24))


def test_rows_that_are_left_out_and_repeated_rows(spark):
    rows = random_rows(200, 10, seed=3)
    rows += [(300, None), (301, []), (302, [None] * 10), (303, [1.0] * 9 + [None]), (304, [float("nan")] * 10),
             (305, [float("inf")] + [0.0] * 9), rows[0], rows[0], (None, rows[5][1])]
    got = check(spark, rows)
    assert not {r.vec_id for r in got} & {300, 301, 302, 303, 304, 305}


def test_another_length_is_left_out(spark):
    rows = random_rows(60, 9, seed=4)
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in [*rows, (99, [1.0, 2.0])]], SCHEMA))
    assert {r.vec_id for r in got.collect()} == set(range(60))


def test_fewer_dimensions_than_components(spark):
    check(spark, random_rows(80, 3, seed=5), live=3)
    check(spark, random_rows(80, 1, seed=6), live=1)


def test_components_without_variance(spark):
    basis = random_rows(40, 2, seed=7)
    flat = [(i, v + [0.5] * 8) for i, v in basis]
    check(spark, flat, live=2)
    same = whiten(spark.createDataFrame([(i, [0.25, 1.0], 0) for i in range(5)], SCHEMA)).collect()
    assert {(r.component, r.whitened, r.explained, r.deviation, r.identity_error) for r in same} == {
        (1, None, 0.0, 0, 0.0), (2, None, 0.0, 0, 0.0)}


def test_empty_table_and_clashing_columns(spark):
    rows = [(i, v, 0) for i, v in random_rows(50, 8, seed=8)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert whiten(df.limit(0)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    clash = df.withColumns({c: F.lit("x") for c in ("v", "x", "n", "component", "m", "pos")})
    assert whiten(clash).count() == 400


def test_large_numbers_stay_exact(spark):
    # Squares beyond a long: null there, whole in the decimal.
    big = [(i, [float(2.0 ** 31 * (i % 3)), float(i)]) for i in range(30)]
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in big], "vec_id long, embedding array<double>, label int"))
    rows = {r.vec_id: r for r in got.filter("component = 1").collect()}
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in big]
    sums = [sum(r[j] for r in x) for j in range(2)]
    for i in range(30):
        exact = sum((30 * x[i][j] - sums[j]) ** 2 for j in range(2))
        assert int(rows[i].deviation_exact) == exact
        assert rows[i].deviation == (exact if exact < 1 << 63 else None)


def test_ties_and_hidden_multiplicities():
    for v, k in ((np.diag([5.0] * 20 + [1.0] * 30), 8), (np.eye(12), 8), (np.diag([3.0, 3, 3, 1, 0, 0]), 6)):
        e, u, worst = jacobi_davidson(lambda z, v=v: v @ z, len(v), k)
        assert e == pytest.approx(np.linalg.eigvalsh(v)[::-1][:k], abs=1e-13)
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-13 and worst < 1e-13


def test_solver_with_restarts():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 400))
    v = x.T @ x / 1500
    passes = []
    e, u, worst = jacobi_davidson(lambda z: (passes.append(1), v @ z)[1], 400, 8)
    full, vectors = np.linalg.eigh(v)
    assert e == pytest.approx(full[::-1][:8], rel=1e-12)
    assert np.abs(np.abs((u * vectors[:, ::-1][:, :8]).sum(axis=0)) - 1).max() < 1e-12
    assert worst < 1e-13 and len(passes) < 200


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((40, 40))
    a, b, shift = (a + a.T) / 2, rng.standard_normal((40, 3)), np.array([0.0, 0.7, -2.0])
    x = minres(lambda z: a @ z - z * shift, b, 200, 1e-13)
    assert np.abs(a @ x - x * shift - b).max() < 1e-9
    assert not minres(lambda z: a @ z, np.zeros((40, 2)), 5, 1e-3).any()
