"""Whitening against numpy's eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from riskweave.llm import queries, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, x int, component string"


def slow(rows, want=4):
    """{(vec_id, occurrence, component): (n, deviation, |whitened|, explained)}; exact integers."""
    ok = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for dims in {len(v) for _, v in ok} - {0}:
        own = [(i, v) for i, v in ok if len(v) == dims]
        fit = sorted({tuple(v) for _, v in own})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        x = np.array(fit, dtype=np.float64) - np.array(s) / n
        e, u = np.linalg.eigh(x.T @ x / n)
        for k in range(min(want, dims)):
            if e[-1 - k] <= 1e-9 * max(e.sum(), 1e-300):
                continue
            for i, v in own:
                w = (np.array(v) - np.array(s) / n) @ u[:, -1 - k] / math.sqrt(e[-1 - k])
                out.append((str(i), k + 1, n, sum((n * a - b) ** 2 for a, b in zip(v, s)), abs(w), e[-1 - k] / e.sum()))
    return sorted(out)


def same(got, want):
    got = sorted((str(r.vec_id), r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(w[4], abs=1e-8) and g[5] == pytest.approx(w[5], rel=1e-9)


def run(spark, rows):
    return whitening.whiten(spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA)).collect()


def test_equals_numpy_with_faults_copies_and_lengths(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(80, 9)) * np.linspace(3, 0.5, 9) + 5
    rows = [(i, base[i % 70].tolist()) for i in range(120)]
    rows += [(200, None), (201, [None] * 9), (202, [math.nan] * 9), (203, [math.inf] + [0.0] * 8), (None, base[0].tolist()), (3, base[5].tolist())]
    rows += [(300 + i, rng.normal(size=2).tolist()) for i in range(10)] + [(400, []), (401, [1.0, 2.0, 3.0]), (402, [1.0, 2.0, 3.0])]
    got = run(spark, rows)
    same(got, slow(rows))
    assert all(r.identity_error < 1e-9 and r.residual < 1e-12 for r in got)
    assert not [r for r in got if r.vec_id in (400, 401, 402)]  # no entries, and no variance


def test_flat_directions_and_empty_tables(spark):
    rows = [(i, [float(i % 5), 7.0, float(i % 5), -1.0]) for i in range(50)]  # rank one
    got = run(spark, rows)
    same(got, slow(rows))
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)
    assert run(spark, []) == [] and run(spark, [(1, [1.0, 2.0])]) == []


def test_deviation_beyond_64_bits_is_null_and_exact_below(spark):
    rows = [(i, [float(i) * 1e4, 3e5 - i * 2.0]) for i in range(40)]
    got = run(spark, rows)
    want = {(w[0], w[1]): w[3] for w in slow(rows)}
    assert all(r.deviation == want[str(r.vec_id), r.component] for r in got)
    huge = run(spark, [(0, [3e38, 0.0]), (1, [-3e38, 1.0]), (2, [0.0, 5.0])])
    assert huge and all(r.deviation is None for r in huge if r.vec_id < 2)


@pytest.mark.parametrize("size, values", [(40, np.linspace(100, 1, 40)), (30, [10.0] * 6 + [1.0] * 24), (25, [1e6, 1.0, 1e-3] + [0.0] * 22), (150, np.linspace(9, 1, 150))])
def test_eigenpairs_reach_double_precision(size, values):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    a = (q * np.array(values)) @ q.T
    passes = []

    def product(v):
        passes.append(v.shape[1])
        return a @ v

    e, u, residual = whitening.jacobi_davidson(product, size, 4)
    assert e == pytest.approx(np.sort(values)[::-1][:4], abs=1e-11 * max(values)) and residual <= 2 * size * whitening.EPS * 2
    assert np.abs(u.T @ u - np.eye(4)).max() < 1e-12
    assert np.linalg.norm(a @ u - u * e, axis=0).max() < 1e-12 * max(values)
    assert len(passes) < 400 and max(passes) <= 6


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    b = rng.normal(size=(12, 3))
    b[:, 2] = 0
    x = whitening.minres(lambda v: a @ v, b, 40, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 2].any()


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, SF_SMALL).collect()
    same(got, slow(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
