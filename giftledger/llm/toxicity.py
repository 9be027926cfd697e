"""Toxicity: a factorization machine over hashed terms.

The terms of a text are its lower-cased runs of letters and the first six letters of longer ones, hashed into
2^18 buckets. Their values are densities: log(1 + occurrences per hundred words). The machine adds a linear weight for
each term and, for each pair of terms in a document, the inner product of two learned vectors: that is what a pair
such as an insult and a group it is aimed at adds beyond the two words.

It learns from labelled rows that are not held out, at most `TRAIN_ROWS` of them (the smallest hashes of the id) with at
most `ENTRIES` terms in all. Every term that at least `MIN_ROWS` of those rows have takes part. Terms whose share of toxic
rows differs from the overall one by `MIN_Z` standard errors are learned first. What that machine leaves unexplained is
then searched for pairs among all terms, also those that tell nothing alone: the leading eigenvectors of the matrix
that adds up, for each two terms, the residuals of the documents with both. A direction stronger than any that shuffled
residuals give (`SHUFFLES` times) is a pair or group of terms; they join, and the machine is trained again with
vectors that start from it. The sample is trained on the driver, in packed arrays; every document is then scored whole,
in tasks that hold the machine and nothing else.

Labels, language, source and id are no inputs.

Defined results: a null text is scored as an empty one, by the overall share; ids with several labels take their
majority; rows that repeat are each scored; of rows that repeat an id one is learned from; without labels every
score is 0.0, with toxic labels only 1.0; an empty table gives no rows. A null id is scored and is not held out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Steps, held_out, label_of, read, text_key

TRAIN_ROWS, BUCKETS, PREFIX = 20_000, 2**18, 6
MIN_ROWS, MIN_Z, ENTRIES = 8, 3.0, 12_000_000
#: Search for pairs: steps of the eigenvector search, shuffles, margin over them, and the least part of a term in a direction.
STEPS, SHUFFLES, MARGIN, PART = 24, 3, 1.1, 0.2
RANK, EPOCHS, BATCH, RATE, SEED = 4, 30, 128, 0.05, 1
LINEAR_DECAY, PAIR_DECAY, LEAST = 1e-4, 1e-3, 0.7

LETTERS = re.compile(r"[^\W\d_]+")
#: Distinct words whose terms a task remembers; it forgets them all when there are more.
REMEMBERED = 500_000


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % BUCKETS


def terms_of(word: str) -> tuple[int, ...]:
    return (bucket(word), bucket(word[:PREFIX] + "*")) if len(word) >= PREFIX else (bucket(word),)


def density(count: float, words: int) -> float:
    return math.log1p(100 * count / max(words, 10))


class Machine:
    """Kept buckets with their linear weights and vectors."""

    def __init__(self, buckets: list[int], share: float):
        draw = np.random.default_rng(SEED)
        self.place = {b: i for i, b in enumerate(buckets)}
        self.constant = None if 0 < share < 1 else float(share)  # rows of one kind only teach nothing but that
        self.bias = math.log(share / (1 - share)) if self.constant is None else 0.0
        self.linear = np.zeros(len(buckets))
        self.vectors = draw.normal(0, 0.01, (len(buckets), RANK))
        self._seen: dict[str, tuple[int, ...]] = {}

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the kept terms of a text and their values."""
        words = Counter(LETTERS.findall((text or "").lower()))
        found: dict[int, int] = {}
        if len(self._seen) > REMEMBERED:
            self._seen.clear()
        for word, n in words.items():
            places = self._seen.get(word)
            if places is None:
                places = self._seen[word] = tuple(self.place[b] for b in terms_of(word) if b in self.place)
            for p in places:
                found[p] = found.get(p, 0) + n
        total = sum(words.values())
        at = sorted(found)
        return np.array(at, np.int64), np.array([density(found[p], total) for p in at])

    def score(self, at: np.ndarray, values: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        parts = self.vectors[at] * values[:, None]
        pairs = 0.5 * (parts.sum(axis=0) ** 2 - (parts**2).sum(axis=0)).sum()
        z = float(self.bias + self.linear[at] @ values + pairs)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.array([self.score(at, x) for at, x in rows])

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
        """Logistic loss by mini-batches with adaptive moments; rows and their order are fixed, so the result is too."""
        if not len(self.linear) or not 0 < y.mean() < 1:
            return
        draw, step = np.random.default_rng(SEED), 0
        state = [np.zeros_like(self.linear), np.zeros_like(self.linear), np.zeros_like(self.vectors), np.zeros_like(self.vectors)]
        for _ in range(EPOCHS):
            order = draw.permutation(len(rows))
            for start in range(0, len(order), BATCH):
                chosen = order[start:start + BATCH]
                sizes = np.array([len(rows[i][0]) for i in chosen])
                chosen, every = chosen[sizes > 0], len(chosen)
                if not len(chosen):
                    continue
                sizes = sizes[sizes > 0]
                at, x = (np.concatenate([rows[i][k] for i in chosen]) for k in (0, 1))
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                parts = self.vectors[at] * x[:, None]
                sums = np.add.reduceat(parts, starts)
                z = self.bias + np.add.reduceat(self.linear[at] * x, starts)
                z = z + 0.5 * (sums**2 - np.add.reduceat(parts**2, starts)).sum(axis=1)
                error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[chosen]) / every
                self.bias -= RATE * error.sum()
                slope = np.repeat(error, sizes) * x
                used, back = np.unique(at, return_inverse=True)
                linear = np.bincount(back, slope, len(used)) + LINEAR_DECAY * self.linear[used]
                pair = PAIR_DECAY * self.vectors[used]
                np.add.at(pair, back, slope[:, None] * (np.repeat(sums, sizes, axis=0) - parts))
                step += 1
                for values, slopes, first, second in ((self.linear, linear, *state[:2]), (self.vectors, pair, *state[2:])):
                    first[used] = 0.9 * first[used] + 0.1 * slopes
                    second[used] = 0.999 * second[used] + 0.001 * slopes**2
                    move = first[used] / (1 - 0.9**step) / (np.sqrt(second[used] / (1 - 0.999**step)) + 1e-8)
                    values[used] -= RATE * move


class Sample:
    """Labelled rows as packed arrays: the terms of all rows one after the other, their values, and where rows begin."""

    def __init__(self, at: np.ndarray, values: np.ndarray, sizes: np.ndarray, y: np.ndarray, terms: int):
        self.at, self.values, self.sizes, self.y, self.terms = at, values, sizes, y, terms
        self.ends = np.cumsum(sizes)
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def rows(self, place: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The rows with the terms that have a place (not -1), under that place."""
        new = place[self.at]
        kept = new >= 0
        sizes = np.bincount(self.row[kept], minlength=len(self.sizes))
        parts = np.cumsum(sizes)[:-1]
        return list(zip(np.split(new[kept], parts), np.split(self.values[kept], parts)))

    def together(self, residual: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The matrix of pairs times a vector: sums of residual * value * value over the documents with both terms."""
        sums = np.bincount(self.row, self.values * u[self.at], len(self.sizes))
        own = np.bincount(self.at, self.values * self.values * residual[self.row], self.terms)
        return np.bincount(self.at, self.values * (residual * sums)[self.row], self.terms) - own * u


def directions(sample: Sample, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of the matrix of pairs and their eigenvectors, by the Lanczos method."""
    n = sample.terms
    basis, alpha, beta = np.zeros((min(STEPS, n), n)), [], []
    q = np.random.default_rng(SEED).normal(size=n)
    for j in range(len(basis)):
        basis[j] = q / np.linalg.norm(q)
        q = sample.together(residual, basis[j])
        alpha.append(basis[j] @ q)
        for _ in range(2):
            q -= basis[:j + 1].T @ (basis[:j + 1] @ q)
        beta.append(np.linalg.norm(q))
        if beta[-1] <= 1e-12 * max(1e-300, np.abs(alpha).max()):
            break
    m = len(alpha)
    values, inner = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:m - 1], 1) + np.diag(beta[:m - 1], -1))
    return values[::-1][:RANK], basis[:m].T @ inner[:, ::-1][:, :RANK]


def pairs(sample: Sample, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms that stand out in directions stronger than chance, and their parts in each (0 elsewhere)."""
    draw = np.random.default_rng(SEED)
    chance = max(directions(sample, draw.permutation(residual))[0][0] for _ in range(SHUFFLES))
    values, vectors = directions(sample, residual)
    vectors = vectors / np.abs(vectors).max(axis=0)
    vectors = np.where((np.abs(vectors) >= PART) & (values > MARGIN * chance), vectors, 0.0)
    return np.flatnonzero(vectors.any(axis=1)), vectors


def _buckets(batches):
    for batch in batches:
        rows = []
        for text in batch.column(3):
            found: Counter = Counter()
            words = Counter(LETTERS.findall((text.as_py() or "").lower()))
            for word, n in words.items():
                for b in terms_of(word):
                    found[b] += n
            rows.append((list(found), list(found.values()), sum(words.values())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
             pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.int64())],
            ["doc_id", "y", "key", "b", "n", "words"])


def fit(docs: DataFrame, labels: DataFrame, label: str, steps: Steps, train_rows: int = TRAIN_ROWS) -> Machine:
    known = label_of(labels, label).where(~held_out(F.col("doc_id")))
    sample = steps.keep(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id")  # at most train_rows rows of an id and a label
    vectors = joined.select("doc_id", "y", text_key(F.col("text")).alias("key"), "text").mapInArrow(
        _buckets, "doc_id long, y int, key string, b array<int>, n array<int>, words long")
    one = vectors.groupBy("doc_id").agg(F.min("y").alias("y"), F.min_by(F.struct("b", "n", "words"), "key").alias("x"))
    rows = steps.keep(one.select("doc_id", "y", "x.*"), "rows")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    share = total["toxic"] / total["n"] if total["n"] else 0.0
    seen = rows.select("y", F.explode("b").alias("b")).groupBy("b").agg(F.count("*").alias("n"), F.sum("y").alias("toxic"))
    expected = F.col("n") * F.lit(share)
    spread = F.sqrt(expected * (1 - share) * (1 - F.col("n") / max(total["n"], 1)) + 0.25)
    telling = (F.abs(F.col("toxic") - expected) >= MIN_Z * spread).alias("telling")
    kept = seen.where(F.col("n") >= MIN_ROWS).select("b", telling).toArrow()  # at most BUCKETS rows
    if not kept.num_rows or not 0 < share < 1:
        return Machine([], share)
    order = np.argsort(kept.column("b").to_numpy())
    buckets, alone = kept.column("b").to_numpy()[order], np.flatnonzero(kept.column("telling").to_numpy(zero_copy_only=False)[order])
    sample = _packed(rows, buckets)
    machine, data = _trained(sample, buckets, alone, share)
    more, vectors = pairs(sample, sample.y - machine.margins(data))
    if len(more):
        machine, _ = _trained(sample, buckets, np.union1d(alone, more), share, vectors)
    return machine


def _trained(sample: Sample, buckets: np.ndarray, terms: np.ndarray, share: float, start: np.ndarray | None = None):
    """A machine over some of the terms, and the sample's rows in its places."""
    place = np.full(len(buckets), -1, np.int64)
    place[terms] = np.arange(len(terms))
    machine, data = Machine(buckets[terms].tolist(), share), sample.rows(place)
    if start is not None:
        machine.vectors[:, :start.shape[1]] += 0.3 * start[terms]
    machine.train(data, sample.y)
    return machine, data


def _packed(rows: DataFrame, buckets: np.ndarray) -> Sample:
    """The sample's rows with the given terms, from the smallest hash until `ENTRIES` terms are reached."""
    sizes = rows.select(F.xxhash64("doc_id").alias("h"), F.size("b").alias("terms")).toArrow().sort_by("h")  # at most TRAIN_ROWS rows
    fits = np.flatnonzero(np.cumsum(sizes.column("terms").to_numpy()) <= ENTRIES)
    last = int(sizes.column("h").to_numpy()[fits[-1]]) if len(fits) else int(sizes.column("h").to_numpy()[0])

    def chosen(batches):
        for batch in batches:
            at, x, held = [], [], []
            for b, n, words in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist()):
                b, n = b.values.to_numpy(), n.values.to_numpy()
                where = np.searchsorted(buckets, b).clip(max=len(buckets) - 1)
                known = buckets[where] == b
                order = np.argsort(where[known])
                at.append(where[known][order].astype(np.int32))
                x.append(np.log1p(100 * n[known][order] / max(words, 10)).astype(np.float32))
                held.append(len(at[-1]))
            offsets = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(p) if p else np.empty(0, t))) for p, t in ((at, np.int32), (x, np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc_id", "y", "at", "x"])

    small = rows.where(F.xxhash64("doc_id") <= last).select("doc_id", "y", "b", "n", "words")
    small = small.mapInArrow(chosen, "doc_id long, y int, at array<int>, x array<float>").toArrow().sort_by("doc_id").combine_chunks()
    at, x = (small.column(c).combine_chunks() if small.column(c).num_chunks != 1 else small.column(c).chunk(0) for c in ("at", "x"))
    sizes = np.diff(at.offsets.to_numpy()).astype(np.int64)
    return Sample(at.flatten().to_numpy(), x.flatten().to_numpy().astype(np.float64), sizes, small.column("y").to_numpy().astype(float), len(buckets))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    machine = fit(docs, labels, label, Steps(docs.sparkSession, "toxicity"), train_rows)

    def of(batches):
        for batch in batches:
            scores = [machine.score(*machine.row(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(of, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir):
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
