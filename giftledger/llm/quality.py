"""Quality classifier: document statistics, random Fourier features, ridge scores, isotonic calibration.

Each text is reduced to `statistics` of its bytes, words and lines. Standardized, they go through random Fourier
features whose inner products approximate a Gaussian kernel. The normal equations of a ridge regression on the labels
are sums over rows, so each task sums its own rows and only sums are shuffled. Features are rounded to 1/4096 before,
which makes all sums exact integers: the order of rows, a retry or a lost executor cannot change the model.

The equations are summed for two folds apart. Each fold is scored by the model of the other, and those scores, in bins
of 1/1000, are calibrated by pooling adjacent violators; the final model uses both folds. Only sums of fixed size and
the bins reach the driver.

Only rows that are not held out and have a label are learned from. Labels, language, source and id are no inputs.

Defined results: a null text is scored as an empty one; ids with several labels take their majority; rows that repeat
are each scored; without any label to learn from every score is 0.5, with labels of one kind it is that label; an
empty table gives no rows. A null id is scored and is not held out.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Steps, held_out, label_of, read

FEATURES, GAMMA, RIDGE, SEED = 256, 0.02, 10.0, 7
SCALE, BIN = 4096, 1000
#: Weight of the raw score in the final one; it only orders documents inside one step of the calibration.
TIE = 1e-3
N_STATISTICS = 24
#: Tasks that sum the normal equations at most; each sends FEATURES + 2 rows of as many numbers for each fold, 1 MB.
SUM_TASKS = 4096


def statistics(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "surrogatepass")
    size, words, lines = len(data), data.split(), data.split(b"\n")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    each, n = Counter(words), max(len(words), 1)
    most = max(each.values(), default=0)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    share = counts[counts > 0] / max(size, 1)
    pairs = len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) > 1 else 1.0
    of = lambda chars: counts[list(chars)].sum()
    return [
        math.log1p(size), math.log1p(len(words)), math.log1p(len(lines)), len(words) / len(lines),
        lengths.mean(), lengths.std(), math.log1p(lengths.max()),
        counts[65:91].sum() / max(size, 1), counts[97:123].sum() / max(size, 1), counts[48:58].sum() / max(size, 1),
        counts[128:].sum() / max(size, 1), -(share * np.log2(share)).sum(),
        counts[33] / n, counts[124] / n, of(b"#$%&*") / n, counts[44] / n, counts[46] / n, counts[10] / n, of(b"@/=<>{}") / n,
        len(each) / n, most / n, pairs, math.log1p(most), len(set(lines)) / len(lines),
    ]


def statistics_of(docs: DataFrame) -> DataFrame:
    """doc_id and x (the statistics) of each row."""

    def of(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, N_STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(x)], ["doc_id", "x"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(of, "doc_id long, x array<double>")


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


class Model:
    """Standardization, random features, weights and calibration; small, and sent to the tasks as it is."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, deviation
        self.directions = draw.normal(size=(len(mean), FEATURES)) * math.sqrt(GAMMA / 2)
        self.phases = draw.uniform(0, 2 * math.pi, FEATURES)
        self.weights, self.steps, self.tie = np.zeros(FEATURES + 1), ([0.0], [0.5]), 0.0

    def features(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers: features times `SCALE`, rounded, and a constant."""
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2)
        return np.rint(np.hstack([waves, np.ones((len(x), 1))]) * SCALE)

    def raw(self, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.features(x) @ weights / SCALE

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x, self.weights)
        calibrated = np.interp(raw, *self.steps)
        return np.clip((1 - self.tie) * calibrated + self.tie * np.clip(raw, 0, 1), 0, 1)


def _sums(model: Model):
    """For a partition of (fold, x, y): one row of whole-number sums for each fold and feature."""

    def of(batches):
        sums = {}
        for batch in batches:
            fold, x, y = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy()
            for f in np.unique(fold):
                rows = model.features(x[fold == f])
                rows = np.hstack([rows, y[fold == f][:, None]])
                sums[f] = sums.get(f, 0) + (rows.T @ rows).astype(np.int64)
        for f, total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays([pa.array([int(f)] * n, pa.int32()), pa.array(range(n), pa.int32()), _lists(total)], ["fold", "i", "v"])

    return of


def _add(frame):
    total = np.sum(np.stack(frame["v"].to_numpy()), axis=0)
    return frame.iloc[:1].assign(v=[total])


def _added(partial: DataFrame, tasks: int) -> DataFrame:
    """The sum of the rows of each fold and feature, by way of sums of about the square root of ``tasks`` rows each."""
    kind = "part int, fold int, i int, v array<long>"
    first = partial.withColumn("part", F.floor(F.spark_partition_id() / math.ceil(math.sqrt(tasks))).cast("int"))
    return first.groupBy("part", "fold", "i").applyInPandas(_add, kind).groupBy("fold", "i").applyInPandas(_add, kind)


def _solve(total: np.ndarray) -> np.ndarray:
    a, b = total[:-1, :-1] / SCALE**2, total[:-1, -1] / SCALE
    return np.linalg.solve(a + RIDGE * np.eye(len(a)), b)


def pool_adjacent_violators(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing values closest to ``y`` in weighted squares."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, label: str, steps: Steps) -> Model:
    """Learn from the rows of ``stats`` that are not held out and have a label."""
    known = stats.where(~held_out(F.col("doc_id"))).join(label_of(labels, label), "doc_id")
    fold = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 2).cast("int")
    train = steps.keep(known.select(fold.alias("fold"), "x", F.col("y").cast("double").alias("y")), "train")
    moments = train.agg(F.count("*"), F.avg("y"), *[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(N_STATISTICS)]).first()
    n, share = moments[0], moments[1]
    if not n:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS))
    rounded = np.array([float(f"{v:.3g}") for v in moments[2:]])  # the order of rows moves only later digits
    model = Model(rounded[:N_STATISTICS], np.maximum(rounded[N_STATISTICS:], 1e-6))
    if share in (0.0, 1.0):
        model.steps = ([0.0], [share])
        model.weights[-1] = share
        return model
    partial = train.coalesce(SUM_TASKS).mapInArrow(_sums(model), "fold int, i int, v array<long>")
    rows = _added(partial, SUM_TASKS).collect()  # two folds of FEATURES + 2 rows
    totals = np.zeros((2, FEATURES + 2, FEATURES + 2), np.int64)
    for r in rows:
        totals[r["fold"], r["i"]] = r["v"]
    model.weights, model.tie = _solve(totals.sum(axis=0)), TIE
    others = [_solve(totals[1]), _solve(totals[0])]

    def crossed(batches):
        for batch in batches:
            fold, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            raw = np.where(fold == 0, model.raw(x, others[0]), model.raw(x, others[1]))
            bins = np.rint(np.clip(raw, -1, 2) * BIN).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(2)], ["bin", "y"])

    bins = train.mapInArrow(crossed, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
    found = sorted((r["bin"], r["y"], r["n"]) for r in bins.collect())  # at most 3 * BIN + 1 rows
    at, y, n = (np.array(c, float) for c in zip(*found))
    model.steps = (at / BIN, pool_adjacent_violators(y / n, n))
    return model


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """row (all columns of ``docs``) and score."""

    def of(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, N_STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    steps = Steps(docs.sparkSession, "quality")
    stats = steps.keep(statistics_of(docs), "statistics")
    model = fit(stats, labels, label, steps)

    def of(batches):
        for batch in batches:
            scores = model.score(_matrix(batch.column(1))) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = stats.mapInArrow(of, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    steps = Steps(docs.sparkSession, "good")
    ids = label_of(labels, label).select("doc_id").where(~held_out(F.col("doc_id")))
    model = fit(statistics_of(docs).join(ids, "doc_id", "left_semi"), labels, label, steps)
    return with_scores(docs, model).where(F.col("score") >= least).select("row.*")


def op3_quality(spark, sf_dir):
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
