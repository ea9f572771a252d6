"""Whitening against numpy: inertia counts, eigenpairs, exact sums, odd vectors."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metaweave.llm import embedding_whitening as W


def symmetric(eigenvalues, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(eigenvalues),) * 2))
    return q @ np.diag(np.array(eigenvalues, float)) @ q.T


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=12), st.integers(0, 9), st.integers(-51, 51))
def test_inertia_counts(eigenvalues, seed, shift):
    assert W.count_above(symmetric(eigenvalues, seed), shift + 0.5) == sum(e > shift + 0.5 for e in eigenvalues)


def test_inertia_without_diagonal():
    assert W.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert W.count_above(np.zeros((3, 3)), 0.0) == 0
    assert W.count_above(np.array([[0, 1, 0], [1, 0, 2], [0, 2, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("eigenvalues", [[5, 4, 3, 2, 1], [1e6, 1e3, 1, 1e-16], [7, 7, 7, 2, 1, 0], [3, 3 - 1e-13, 1, 0.5], [1, 0, 0, 0], [9], [2, 2, 2, 2, 2, 2],
                                         list(range(1, 65)), [1 + 1e-7 * i for i in range(30)]])
def test_leading_eigenpairs(eigenvalues):
    v = symmetric(eigenvalues, 3)
    want = sorted((e for e in eigenvalues if e > 1e-10 * max(eigenvalues)), reverse=True)[:4]
    got = W.leading_eigenpairs(v, 4)
    assert len(got) == len(want)
    axes = np.array([x for _, x in got])
    np.testing.assert_allclose([e for e, _ in got], want, rtol=1e-9, atol=1e-13 * max(eigenvalues))
    np.testing.assert_allclose(axes @ axes.T, np.eye(len(got)), atol=1e-9)
    assert max(np.linalg.norm(v @ x - e * x) for e, x in got) <= 1e-12 * max(eigenvalues)
    assert W.leading_eigenpairs(np.zeros((3, 3)), 4) == []


def brute_force(rows, k=4):
    """(id, component) -> (n, deviation, |whitened|, explained) by numpy's eigh over Python's integers."""
    fine = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for d in {len(x) for _, x in fine}:
        fit = sorted({x for _, x in fine if len(x) == d})
        n, s = len(fit), [sum(x[j] for x in fit) for j in range(d)]
        c = np.array([[x[j] - s[j] / n for j in range(d)] for x in fit])
        v = c.T @ c / n
        e, q = np.linalg.eigh(v)
        for i, x in fine:
            if len(x) == d:
                dev = sum((n * x[j] - s[j]) ** 2 for j in range(d))
                for a in range(min(k, d)):
                    if e[-1 - a] > 1e-10 * e[-1] > 0:
                        y = (np.array(x) - np.array(s) / n) @ q[:, -1 - a] / math.sqrt(e[-1 - a])
                        out.append((i, a + 1, n, dev, abs(y), e[-1 - a] / np.trace(v)))
    return out


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3], r[4])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    np.testing.assert_allclose(np.array([r[4:] for r in got]), np.array([r[4:] for r in want]), rtol=1e-7, atol=1e-7)


SCHEMA = "vec_id long, embedding array<float>, component string"


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1] + 5]) for i in range(200)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (7, rows[8][1])]
    rows += [(300 + i, [float(np.float32(x)) for x in rng.normal(size=2)]) for i in range(40)]
    rows += [(400, None), (401, []), (402, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 2), (405, [1.0, 2.0, 3.0]),
             (406, [-0.0, 0.0])]
    got = W.whiten(spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)).collect()
    check(got, brute_force(rows))
    assert max(r.identity_error for r in got) < 1e-9
    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_values_stay_exact(spark):
    """Beyond 64 bits deviations are null; entries near the limit of 32 and 64-bit integers pack and sum without loss."""
    rows = [(0, [1.0, 2.0**25]), (1, [2.0, -(2.0**25)]), (2, [3.0, 2.0**20]), (3, [-4.0, 0.0])]
    got = W.whiten(spark.createDataFrame([(*r, "") for r in rows], SCHEMA)).collect()
    check([r for r in got if r.deviation is not None], [r for r in brute_force(rows) if r[3] < 2**63 and r[1] == 1])
    huge = [(i, [x, -x]) for i, x in enumerate([3e30, 1.0, 2.0, 1e18])]
    got = W.whiten(spark.createDataFrame([(*r, "") for r in huge], SCHEMA)).collect()
    assert all(r.deviation is None for r in got) and {r.vec_id for r in got} == {0, 1, 2, 3}


def test_packing_is_canonical():
    x = np.array([[1, -2], [40_000, 0], [2**40, 1], [-(2**63), 2**63 - 1]])
    packed = W.pack(x)
    assert [p[0] for p in packed] == [2, 4, 8, 8] and W.pack(x[:1])[0] == packed[0]
    assert [np.frombuffer(p[1:], f"<i{p[0]}").tolist() for p in packed] == x.tolist()
