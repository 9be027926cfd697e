import math
from decimal import Decimal

import numpy as np
import pytest
from giftledger.llm import whitening
from giftledger.llm.whitening import leading_vectors, sturm_count, tridiagonal

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, component string"


def frame(spark, pairs):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", 1, "c") for i, v in pairs], SCHEMA)


def brute(pairs, m=4):
    """Per row: deviation and absolute whitened values; and n, eigenvalue shares."""
    sound = [(i, v) for i, v in pairs if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in sound)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dim - len(v)) for _, v in sound])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(m, int((values > 1e-9 * values.sum()).sum()))
    w = (x - sums / n) @ axes[:, :m] / np.sqrt(values[:m])
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return [i for i, _ in sound], n, deviation, w, values[:m] / values.sum()


def check(result, pairs):
    ids, n, deviation, w, shares = brute(pairs)
    rows = result.collect()
    m = w.shape[1]
    assert len(rows) == m * len(ids)
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1
    for c in range(m):
        mine = sorted((r for r in rows if r.component == c + 1), key=lambda r: (r.vec_id is not None, r.vec_id or 0, r.deviation, abs(r.whitened)))
        theirs = sorted(zip(ids, deviation, w[:, c]), key=lambda r: (r[0] is not None, r[0] or 0, r[1], abs(r[2])))
        assert [(r.vec_id, r.deviation, r.deviation_exact) for r in mine] == [(i, d, Decimal(d)) for i, d, _ in theirs]
        a, b = np.array([r.whitened for r in mine]), np.array([t[2] for t in theirs])
        sign = 1 if a[np.abs(b).argmax()] * b[np.abs(b).argmax()] > 0 else -1
        assert np.allclose(a, sign * b, atol=1e-8)
        assert all(r.explained == pytest.approx(shares[c], rel=1e-9) for r in mine)


def test_equals_brute_force_with_copies(spark):
    draw = np.random.default_rng(1)
    v = draw.normal(size=(500, 12)) * 0.8 ** np.arange(12)
    v[100:300] = v[0]
    pairs = list(enumerate(v.tolist()))
    check(whitening.whiten(frame(spark, pairs).repartition(4)), pairs)


def test_hard_rows(spark):
    pairs = [(1, [1, 0, 2]), (2, [0, 1, 5]), (3, [2, 2]), (4, None), (5, [0, 0, 0]), (6, [float("nan"), 1, 1]), (7, [float("inf"), 1, 1]), (8, [None, 1, 1]),
             (None, [1, 3, 4]), (1, [1, 0, 2]), (2, [4, 4, 1]), (9, []), (10, [-0.0, 0.001, -0.001])]
    check(whitening.whiten(frame(spark, pairs)), pairs)


def test_too_few_directions(spark):
    for pairs in ([], [(0, None)], [(0, [1, 2])], [(0, [1, 2]), (1, [1, 2])], [(0, []), (1, [])]):
        assert whitening.whiten(frame(spark, pairs)).collect() == []
    line = [(i, [i, 2 * i, 3]) for i in range(5)]
    check(whitening.whiten(frame(spark, line)), line)
    assert {r.component for r in whitening.whiten(frame(spark, line)).collect()} == {1}


def test_deviation_beyond_64_bits(spark):
    pairs = [(0, [1e9, 1]), (1, [2e9, 2]), (2, [-1e9, 7])]
    rows = whitening.whiten(frame(spark, pairs)).where("component = 1").orderBy("vec_id").collect()
    _, _, deviation, _, _ = brute(pairs)
    assert [int(r.deviation_exact) for r in rows] == deviation
    assert [r.deviation for r in rows] == [d if d < 2**63 else None for d in deviation] and None in [r.deviation for r in rows]


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 0], [1, 1, 1, 1, 1], [2, 2 - 1e-12, 2 - 2e-9, 1, 1], [7, 0, 0, 0, 0], [1], [2, 1]])
@pytest.mark.parametrize("turned", [True, False])
def test_eigenvectors_with_clusters(values, turned):
    draw, n = np.random.default_rng(len(values)), len(values)
    q = np.linalg.qr(draw.normal(size=(n, n)))[0] if turned else np.eye(n)
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    m = min(4, n)
    found, vectors = leading_vectors(a, m)
    assert np.allclose(found, sorted(values, reverse=True)[:m], atol=1e-13 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(m), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-13 * max(values))


def test_tridiagonal_form_and_counts():
    draw = np.random.default_rng(2)
    a = draw.normal(size=(30, 30))
    a = a + a.T
    diagonal, second, _ = tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(second, 1) + np.diag(second, -1)), values)
    at = np.concatenate([values - 1e-6, values + 1e-6])
    assert list(sturm_count(diagonal, second, at)) == [*range(30), *range(1, 31)]
