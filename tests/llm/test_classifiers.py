import random
import zlib

import numpy as np
import pytest
from giftledger.llm import quality, toxicity
from giftledger.llm.common import Steps
from pyspark.sql import functions as F
from tests.llm.samples import empty, messy, prose, rows

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def area(y, score):
    values, back, counts = np.unique(score, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[back]
    ones = y.sum()
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = tables(spark)
    return {"quality": quality.quality_scores(docs, labels).collect(), "toxic": toxicity.toxicity_scores(docs, labels).collect()}


@pytest.mark.parametrize("name, least, recall", [("quality", 0.99, 0.98), ("toxic", 0.95, 0.85)])
def test_held_out_accuracy(spark, scored, name, least, recall):
    rows_, labels = scored[name], {r.doc_id: r[name] for r in tables(spark)[1].collect()}
    assert all(r.held_out == held(r.doc_id) for r in rows_)
    tested = [r for r in rows_ if r.held_out and r.doc_id in labels]
    y, score, said = (np.array(c) for c in zip(*((labels[r.doc_id], r.score, r.predicted) for r in tested)))
    assert area(y, score) > least
    assert (said[y == 1] == 1).mean() > recall and (y[said == 1] == 1).mean() > 0.97
    assert (score >= 0).all() and (score <= 1).all()


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_only_learned_rows_and_texts_count(spark, scored, name):
    """Other labels of held-out rows, other languages, sources and ids of the same fold do not change a score."""
    docs, labels = tables(spark)
    is_held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    turned = labels.withColumn(name, F.when(is_held, 1 - F.col(name)).otherwise(F.col(name)))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    run = quality.quality_scores if name == "quality" else toxicity.toxicity_scores
    again = {r.doc_id: r.score for r in run(other, turned).collect()}
    assert max(abs(again[r.doc_id] - r.score) for r in scored[name]) < 1e-9


@pytest.mark.parametrize("run, name", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_messy_rows(spark, run, name):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows())] + [(None, 1), (11, None), (10, 0)], f"doc_id long, {name} int")
    found = run(messy(spark), labels).collect()
    assert len(found) == len(rows())
    assert all(0 <= r.score <= 1 and r.held_out is not None and r.predicted in (0, 1) for r in found)
    assert run(empty(spark), labels).collect() == []
    nothing = run(messy(spark), labels.where("false")).collect()
    assert {r.score for r in nothing} == ({0.5} if name == "quality" else {0.0})
    ones = run(messy(spark), labels.withColumn(name, F.lit(1))).collect()
    assert all(r.score > 0.99 for r in ones)


def test_good_documents_keep_their_columns(spark):
    docs, labels = tables(spark)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.quality_scores(docs, labels).where("score >= 0.5").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want
    assert quality.good_documents(messy(spark), labels).columns == messy(spark).columns
    assert quality.good_documents(empty(spark), labels).collect() == []


def test_isotonic_regression_against_brute_force():
    draw = np.random.default_rng(0)
    for _ in range(20):
        y, w = draw.integers(0, 6, 7).astype(float), draw.integers(1, 4, 7).astype(float)
        got = quality.pool_adjacent_violators(y, w)
        means = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
        want = [max(min(means(a, b) for b in range(i + 1, 8)) for a in range(i + 1)) for i in range(7)]  # max-min formula
        assert got == pytest.approx(want)


def test_sums_over_partitions_do_not_depend_on_them(spark):
    docs, labels = tables(spark)
    some = docs.where("doc_id < 1500")
    a = quality.fit(quality.statistics_of(some.repartition(2)), labels, "quality", Steps(spark, "a"))
    b = quality.fit(quality.statistics_of(some.repartition(9)), labels, "quality", Steps(spark, "b"))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.steps[1], b.steps[1])


def test_the_machine_learns_a_pair(spark):
    """Neither word alone is toxic, both together are: a linear model cannot tell."""
    machine = toxicity.Machine([toxicity.bucket("insult"), toxicity.bucket("group")], 0.25)
    kinds = [("a b c", 0), ("insult b c", 0), ("group b c", 0), ("insult group c", 1)] * 200
    machine.linear[:] = 0
    machine.vectors[:] = np.random.default_rng(0).normal(0, 0.3, machine.vectors.shape)
    machine.train([machine.row(t) for t, _ in kinds], np.array([float(y) for _, y in kinds]))
    got = {t: machine.score(*machine.row(t)) for t, _ in kinds[:4]}
    assert got["insult group c"] > 0.7 and max(v for t, v in got.items() if t != "insult group c") < 0.3


def test_the_sample_is_bounded(spark):
    docs, labels = tables(spark)
    few = toxicity.fit(docs, labels, "toxic", Steps(spark, "few"), train_rows=300)
    assert len(few.place) < 2000
    assert toxicity.terms_of("é" * 9) and prose(1, 3)


def pair_documents(n=6000):
    """Toxic when both of two words occur, each of them harmless alone and hardly more frequent in toxic rows than chance allows."""
    draw, vocabulary = random.Random(3), [f"w{i:03d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(800)]
    docs, labels = [], []
    for i in range(n):
        words, insult, group = draw.choices(vocabulary, k=draw.randrange(10, 60)), draw.random() < 0.22, draw.random() < 0.22
        words += ["insult"] * insult + ["group"] * group
        draw.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    return docs, labels


def test_a_pair_is_learned_through_fit(spark, monkeypatch):
    """Also when no term may be kept for what it tells alone."""
    docs, labels = pair_documents()
    truth = dict(labels)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    for alone in (toxicity.MIN_Z, 1e9):
        monkeypatch.setattr(toxicity, "MIN_Z", alone)
        held = [r for r in toxicity.toxicity_scores(*frames).collect() if r.held_out]
        caught = [r.predicted for r in held if truth[r.doc_id]]
        assert len(caught) > 50 and sum(caught) >= 0.9 * len(caught)
        assert sum(r.predicted for r in held if not truth[r.doc_id]) <= 0.01 * len(held)


def test_no_pairs_are_found_in_noise():
    draw = np.random.default_rng(4)
    sizes = draw.integers(5, 20, 500)
    at = np.concatenate([draw.choice(60, n, replace=False) for n in sizes])
    sample = toxicity.Sample(at, np.ones(len(at)), sizes, draw.integers(0, 2, 500).astype(float), 60)
    dense = np.zeros((500, 60))
    dense[sample.row, at] = 1
    residual = sample.y - sample.y.mean()
    matrix = dense.T @ (dense * residual[:, None])
    np.fill_diagonal(matrix, 0)
    u = draw.normal(size=60)
    assert np.allclose(sample.together(residual, u), matrix @ u)
    assert toxicity.directions(sample, residual)[0][0] == pytest.approx(np.linalg.eigvalsh(matrix)[-1], rel=0.02)
    assert len(toxicity.pairs(sample, residual)[0]) == 0


def test_sums_of_many_tasks_are_added_in_two_steps(spark):
    """Rows of 30 tasks in parts of four tasks, against one sum."""
    draw = np.random.default_rng(4)
    rows = [(f, i, draw.integers(-10**9, 10**9, 3).tolist()) for _ in range(30) for f in (0, 1) for i in (0, 1, 2)]
    partial = spark.createDataFrame(rows, "fold int, i int, v array<long>").repartition(30)
    found = {(r.fold, r.i): r.v for r in quality._added(partial, 16).collect()}
    assert found == {(f, i): np.sum([v for a, b, v in rows if (a, b) == (f, i)], axis=0).tolist() for f in (0, 1) for i in (0, 1, 2)}
