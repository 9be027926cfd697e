import math

import numpy as np
import pytest
from giftledger.llm import neighbours
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, list int, v string, score double"


def brute(vectors, ids, k=10):
    out = {}
    for q in ids:
        d = sorted((math.dist(vectors[q], v), i) for i, v in vectors.items() if i != q)
        out[q] = [(n + 1, i, s) for n, (s, i) in enumerate(d[:k])]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def frame(spark, pairs):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "v", 0.5) for i, v in pairs], SCHEMA)


@pytest.mark.parametrize("part, queries", [(16_384, 4_096), (50, 3)])
def test_recall_with_hot_vectors_and_split_lists(spark, monkeypatch, part, queries):
    monkeypatch.setattr(neighbours, "PART", part)
    monkeypatch.setattr(neighbours, "QUERIES", queries)
    draw = np.random.default_rng(1)
    vectors = {i: draw.normal(size=32).astype(np.float32) for i in range(1500)}
    for i in range(300, 800):
        vectors[i] = vectors[0]  # a third are one vector
    got = found(neighbours.nearest(frame(spark, vectors.items()), F.col("vec_id") % 20 == 0))
    want = brute({i: v.astype(float) for i, v in vectors.items()}, [i for i in vectors if i % 20 == 0])
    assert got.keys() == want.keys() and all(len(got[q]) == 10 for q in got)
    same = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in got)
    assert same >= 0.95 * 10 * len(want)
    for q in range(300, 800, 20):  # ties to the smaller id
        assert [i for _, i, _ in got[q]] == [i for _, i, _ in want[q]]
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 11))
        assert rows == sorted(rows, key=lambda r: (r[2], r[1]))
        assert all(s == pytest.approx(math.dist(vectors[q].astype(float), vectors[i].astype(float)), abs=1e-12) for _, i, s in rows)


def test_hard_rows(spark):
    rows = [(0, [1, 0]), (100, [0, 1]), (7, [1, 1]), (8, None), (9, [0, 0]), (10, [float("nan"), 1]), (11, [float("inf"), 1]), (12, [None, 1]),
            (13, [1, 2, 3]), (14, []), (None, [1, 1]), (7, [1, 1]), (7, [5, 5]), (200, [0, 0])]
    got = found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == {0: [(1, 7, 1.0), (2, 100, math.sqrt(2))], 100: [(1, 7, 1.0), (2, 0, math.sqrt(2))]}


def test_one_vector_and_none(spark):
    assert neighbours.nearest(frame(spark, [(0, [1, 2])]), F.col("vec_id") % 100 == 0).collect() == []
    for rows in ([], [(0, None)], [(0, [0, 0])]):
        none = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0)
        assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    got = found(neighbours.nearest(df, F.col("vec_id") % 100 == 0))
    ids, matrix = np.array(sorted(vectors)), np.array([vectors[i] for i in sorted(vectors)])
    same = 0
    for q in got:
        d = np.sqrt(((matrix - vectors[q]) ** 2).sum(axis=1))
        near = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        same += len({i for _, i, _ in got[q]} & set(near))
    assert same >= 0.93 * 10 * len(got) and len(got) == sum(i % 100 == 0 for i in vectors)


def test_abandoned_candidates_are_farther():
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(2000, 64))
    turn = np.linalg.qr(draw.normal(size=(64, 64)))[0]
    turned = vectors @ turn
    blocks = [turned[:, d:d + 16] for d in range(0, 64, 16)]
    ids, right = np.arange(2000), 0
    for q in range(50):
        places, _ = neighbours.scan(vectors[q], turned[q], vectors, blocks, ids, q, 10)
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        right += len(set(places) & set([i for i in np.argsort(d) if i != q][:10]))
    assert right >= 0.97 * 500


@pytest.mark.parametrize("away", [0.0, 1e-3, 1.0])
@pytest.mark.parametrize("seed", range(6))
def test_all_ties_reach_the_exact_score(away, seed):
    """500 copies in random order, at the query or at a distance from it: the smallest ids are returned."""
    draw = np.random.default_rng(seed)
    query, turn = draw.normal(size=32), np.linalg.qr(draw.normal(size=(32, 32)))[0]
    vectors = np.concatenate([np.tile(query + away * draw.normal(size=32) / 6, (500, 1)), 9 + draw.normal(size=(500, 32))])
    ids = draw.permutation(1000)
    turned = (vectors @ turn).astype(np.float32)
    blocks = [np.ascontiguousarray(turned[:, d:d + 16]) for d in (0, 16)]
    places, _ = neighbours.scan(query, query @ turn, vectors, blocks, ids, -1, 10)
    assert sorted(ids[places]) == sorted(ids[:500])[:10]


def test_ties_with_shuffled_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 400)
    monkeypatch.setattr(neighbours, "usable", lambda v, steps, of=neighbours.usable: (lambda rows, dim: (rows.orderBy(F.hash("vec_id")), dim))(*of(v, steps)))
    draw = np.random.default_rng(4)
    same = draw.normal(size=32).astype(np.float32)
    vectors = {int(i): same if n < 700 else draw.normal(size=32).astype(np.float32) for n, i in enumerate(draw.permutation(1500))}
    got = found(neighbours.nearest(frame(spark, vectors.items()).repartition(23), F.col("vec_id") % 20 == 0))
    copies = sorted(i for i, v in vectors.items() if v is same)
    asked = [q for q in copies if q % 20 == 0]
    assert asked and all([i for _, i, _ in got[q]] == [i for i in copies if i != q][:10] for q in asked)


class Counted(np.ndarray):
    """Counts the coordinates that a scan picks."""

    read = 0

    def __getitem__(self, key):
        out = np.asarray(self).__getitem__(key)
        Counted.read += out.size
        return out


def test_candidates_far_away_are_abandoned_early():
    """Twenty clusters: most rows are far from a query, and less than half of all coordinates are read."""
    draw = np.random.default_rng(7)
    centres = 2 * draw.normal(size=(20, 64))
    vectors = centres[draw.integers(0, 20, 4000)] + draw.normal(size=(4000, 64))
    turn, ids, right = np.linalg.qr(draw.normal(size=(64, 64)))[0], np.arange(4000), 0
    turned = vectors @ turn
    blocks = [np.ascontiguousarray(turned[:, d:d + 16]).view(Counted) for d in range(0, 64, 16)]
    Counted.read = 0
    for q in range(40):
        places, _ = neighbours.scan(vectors[q], turned[q], vectors, blocks, ids, q, 10)
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        right += len(set(places) & set([i for i in np.argsort(d) if i != q][:10]))
    assert right >= 0.97 * 400 and Counted.read < 0.5 * 40 * 4000 * 64
