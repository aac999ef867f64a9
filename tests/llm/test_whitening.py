"""Whitening against NumPy, and its exact parts against integer brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, _v string, _d int"


def faddeev(m):
    """Characteristic polynomial by Faddeev-LeVerrier over the rationals."""
    d = len(m)
    ident = [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    acc, coefs = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        acc = [[sum(m[i][t] * acc[t][j] for t in range(d)) + coefs[-1] * ident[i][j] for j in range(d)] for i in range(d)]
        coefs.append(-sum(m[i][t] * acc[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in reversed(coefs)]


def gram(rng, d, rank, top):
    a = [[rng.randrange(-top, top) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in a) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d,rank,top", [(1, 1, 9), (2, 2, 5), (5, 5, 1000), (6, 3, 50), (7, 9, 10 ** 12), (4, 0, 3)])
def test_charpoly_is_exact(spark, d, rank, top):
    m = gram(random.Random(d), d, rank, top)
    assert W.charpoly(spark, m) == faddeev(m)


def test_charpoly_mod_needs_pivots():
    m = [[0, 0, 1, 2], [0, 3, 0, 0], [1, 0, 0, 0], [2, 0, 0, 5]]
    primes = np.array([101, 2147483647])
    want = faddeev(m)
    assert W.charpoly_mod(m, primes).tolist() == [[c % int(q) for c in want] for q in primes]


def test_roots_with_multiplicity_and_zeros():
    roots = [0, 0, 3, 3, 3, 7, 7 * 10 ** 20, 7 * 10 ** 20 + 1]
    c = [1]
    for r in roots:
        c = [(-r) * a + b for a, b in zip(c + [0], [0] + c)]
    got = [Fraction(n, 2 ** s) for n, s in W.largest_roots(c, 8)]
    assert all(abs(g - w) <= Fraction(w, 2 ** 200) for g, w in zip(got, sorted(roots, reverse=True)))
    assert [W.roots_above(c, x, 0) for x in (-1, 0, 2, 3, 6, 7)] == [8, 6, 6, 3, 3, 2]


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 0, "x", 1) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(out, vectors, ids, k):
    """Against float64 NumPy on the integers."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    dev = {i: int(((n * r - s).astype(object) ** 2).sum()) for i, r in zip(ids, x)}
    xc = x - s / n
    vals, vecs = np.linalg.eigh(xc.T @ xc / n)
    vals, vecs = vals[::-1][:k], vecs[:, ::-1][:, :k]
    want = {i: r for i, r in zip(ids, xc @ vecs / np.sqrt(vals))}
    got = {}
    for r in out:
        assert r.n == n and r.deviation == dev[r.vec_id] == int(r.deviation_exact)
        assert math.isclose(r.explained, vals[r.component - 1] / np.trace(xc.T @ xc / n), rel_tol=1e-9)
        got.setdefault(r.vec_id, {})[r.component] = r.whitened
    assert set(got) == set(want) and all(set(v) == set(range(1, k + 1)) for v in got.values())
    for c in range(k):
        a = np.array([got[i][c + 1] for i in want])
        b = np.array([want[i][c] for i in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    assert max(r.identity_error for r in out) < 1e-9


def test_whiten_equals_numpy_and_leaves_odd_vectors_out(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(300, 12)).astype(np.float32) * np.linspace(1, 2, 12, dtype=np.float32)
    vectors = [v.tolist() for v in good]
    odd = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("inf")] + [1.0] * 11, [0.5] * 3]
    out = W.whiten(frame(spark, vectors + odd)).collect()
    assert len(out) == 300 * 8
    check(out, vectors, range(300), 8)


def test_large_entries_and_few_dimensions(spark):
    vectors = [[v * 3.0e9, v * v * 1.0] for v in map(float, range(-9, 10))]
    out = W.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in out} == {1, 2}
    assert max(r.identity_error for r in out) < 1e-9
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    for r in out:
        want = sum((len(x) * c - t) ** 2 for c, t in zip(x[r.vec_id], s))
        assert int(r.deviation_exact) == want and r.deviation == (want if want < 2 ** 63 else None)


def test_repeated_ids_rows_and_equal_eigenvalues(spark):
    # A cross-polytope: all eigenvalues equal. Ids repeat, are null, and exceed 2**53.
    vectors = [[s if i == j else 0.0 for j in range(4)] for i in range(4) for s in (1.0, -1.0)]
    ids = [2 ** 53 + 1, 2 ** 53 + 1, None, None, 5, 6, 7, 8]
    out = W.whiten(frame(spark, vectors, ids)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in out) == sorted((i is None, i or 0) for i in ids for _ in range(4))
    assert all(abs(r.explained - 0.25) < 1e-12 and r.identity_error < 1e-12 for r in out)


def test_empty_and_constant_tables(spark):
    assert W.whiten(frame(spark, [None, []])).collect() == []
    assert W.whiten(spark.createDataFrame([], SCHEMA)).columns == W.whiten(frame(spark, [[1.0, 2.0]])).columns
    out = W.whiten(frame(spark, [[1.0, 2.0], [1.0, 2.0]])).collect()
    assert {(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in out} == {
        (1, 0, 0.0, 0.0, None), (2, 0, 0.0, 0.0, None)}
    line = W.whiten(frame(spark, [[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]])).collect()
    assert max(r.identity_error for r in line) < 1e-12 and {r.whitened for r in line if r.component == 2} == {0.0}


def test_query_on_given_table(spark):
    from tessera.llm.queries import op12_whitening
    out = op12_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(out, [r.embedding for r in rows], [r.vec_id for r in rows], 8)
