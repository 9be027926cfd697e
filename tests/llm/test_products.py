import math

import numpy as np
import pytest
from giftledger.llm import products

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n2 double, chunk int, score string"
EACH = "vec_id % 20 = 0"


def frame(spark, pairs):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", 0.5, 1, "s") for i, v in pairs], SCHEMA)


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) for c in v]


def brute(vectors, k=10, every=20):
    x = {i: whole(v) for i, v in vectors.items()}
    out = {}
    for q in x:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in x if i != q)
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return {q: rows for q, rows in out.items() if rows}


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


@pytest.mark.parametrize("kind", ["lengths differ", "equal lengths", "a third equal", "low rank"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(products, "LEAST_ROWS", 50)
    monkeypatch.setattr(products, "CHUNK_VALUES", 24 * 40)
    draw = np.random.default_rng(3)
    v = draw.normal(size=(600, 24))
    if kind == "lengths differ":
        v *= np.exp(draw.normal(size=(600, 1)))
    elif kind == "equal lengths":
        v /= np.linalg.norm(v, axis=1)[:, None]
    elif kind == "a third equal":
        v[draw.permutation(600)[:200]] = v[0]
    else:
        v = v[:, :3] @ draw.normal(size=(3, 24)) + 0.01 * v
    vectors = {int(i): x for i, x in zip(draw.permutation(600), v.tolist())}
    assert found(products.largest_products(frame(spark, vectors.items()).repartition(5), EACH)) == brute(vectors)


def test_hard_rows(spark):
    rows = [(0, [1, 0]), (100, [0, 1]), (7, [1, 1]), (8, None), (9, [0, 0]), (10, [float("nan"), 1]), (11, [float("inf"), 1]), (12, [None, 1]),
            (13, [1, 2, 3]), (14, []), (None, [1, 1]), (7, [1, 1]), (7, [5, 5]), (15, [-0.0001, -1])]
    long = {0: [1, 0, 0], 100: [0, 1, 0], 7: [1, 1, 0], 9: [0, 0, 0], 13: [1, 2, 3], 14: [0, 0, 0], 15: [-1 / 1024, -1, 0]}
    got = found(products.largest_products(frame(spark, rows), "vec_id % 100 = 0"))
    assert got == brute(long, every=100)


def test_few_and_none(spark):
    run = lambda rows: products.largest_products(frame(spark, rows), EACH)
    assert run([(0, [1, 2])]).collect() == []
    for rows in ([], [(0, None)], [(1, [1, 2]), (2, [3, 4])]):
        none = run(rows)
        assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(run([(0, []), (1, [])])) == {0: [(1, 1, 0)]}
    with pytest.raises(ValueError, match="64 bits"):
        run([(0, [1e30]), (1, [1])])


def test_pruning_reads_less_and_loses_nothing():
    draw = np.random.default_rng(5)
    vectors = np.floor(1024 * draw.normal(size=(6000, 64)) * 0.7 ** np.arange(64)).astype(np.int64)
    vectors[2000:4000] = vectors[2000]
    points, ids = vectors[:50], draw.permutation(6000)
    turn = np.linalg.eigh((vectors.T @ vectors).astype(float))[1][:, ::-1]
    at, got, scores, values = products.search(points, ids[:50], np.full(50, -np.inf), vectors, ids, turn, 10)
    for q in range(50):
        s = vectors @ points[q]
        want = [i for i in np.lexsort((ids, -s)) if i != q][:10]
        mine = sorted(zip(-scores[at == q], got[at == q]))
        assert mine == [(-s[i], ids[i]) for i in want]
    assert values < 0.35 * 50 * 6000 * 64


def test_short_vectors_are_left_unread_by_their_length():
    draw = np.random.default_rng(6)
    vectors = draw.integers(-999, 999, (10_000, 16)) // np.repeat([1, 100], [2_000, 8_000])[:, None]
    *_, values = products.search(vectors[:20], np.arange(20), np.full(20, -np.inf), vectors, np.arange(10_000), np.eye(16), 10)
    assert values <= 20 * 4_096 * 16
