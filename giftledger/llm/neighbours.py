"""Approximate nearest neighbours: probed lists, scanned by an adaptive number of dimensions.

A k-means quantizer, fitted on a bounded sample (`SAMPLE_ROWS` rows with the smallest hashes of their id, fewer where
vectors are very long), deals all vectors into lists. How many lists a query probes is measured on the same sample:
enough to hold `COVER` of its true neighbours there. Every vector is indexed.

Inside a list vectors are rotated by one random orthogonal matrix and stored in blocks of `BLOCK` columns. After a
rotation any d of D coordinates estimate the whole distance, so a candidate is abandoned after a block when the
hypothesis that it is closer than the query's current k-th candidate is rejected: sqrt(D / d) * partial distance >
(1 + EPSILON / sqrt(d)) * that distance. The k-th is tightened after each block, by the exact distances of the `FIRST`
candidates that are nearest so far. What rounding of the stored coordinates can add is allowed for, so that a
candidate as near as the k-th is not abandoned by it. Survivors get their Euclidean distance from the original vectors in
double precision, and that is the score.

Lists are cut into parts of about `PART` vectors and query sets into parts of about `QUERIES`, so neither a list that
holds a third of all vectors nor a popular query lands in one task. Each pair of parts returns at most k rows a query.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
an id or vectors of another than the most frequent dimension (the longer one of a tie); of rows that repeat an id
the smallest vector counts; equal distances go to the smaller id; no vectors, no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Steps, read

K, SAMPLE_ROWS, SAMPLE_VALUES, COVER, TRIALS = 10, 20_000, 8_000_000, 0.985, 256
BLOCK, EPSILON, FIRST = 16, 2.1, 32
#: Bound of the relative error of stored coordinates (single precision: 2^-24, with room for the rotation's own).
ROUNDING = 2.0**-22
PART, QUERIES, MOST_LISTS, ROUNDS, SEED = 16_384, 4_096, 1_024, 8, 5


def usable(vectors: DataFrame, steps: Steps) -> tuple[DataFrame, int]:
    """vec_id and v of the rows that take part, one for each id, and their dimension (0 if there are none)."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), sound.alias("sound"))
    rows = rows.where("vec_id IS NOT NULL AND sound")
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        return steps.keep(rows.select("vec_id", "v"), "vectors"), 0
    dim = sizes["dim"]
    one = rows.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v"))
    return steps.keep(one, "vectors"), dim


def _stack(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, for sets of bounded size."""
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T


def fit_lists(sample: np.ndarray, rows: int) -> tuple[np.ndarray, int]:
    """Centroids, and how many lists to probe."""
    draw = np.random.default_rng(SEED)
    n_lists = max(1, min(MOST_LISTS, len(sample) // 8, round(math.sqrt(rows) / 2)))
    centroids = sample[draw.choice(len(sample), n_lists, replace=False)]
    nearest = lambda x: np.concatenate([_distances(p, centroids).argmin(axis=1) for p in np.array_split(x, len(x) // 4096 + 1)])
    for _ in range(ROUNDS):
        own = nearest(sample)
        sizes = np.bincount(own, minlength=n_lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    own = nearest(sample)
    trial = sample[draw.choice(len(sample), min(TRIALS, len(sample)), replace=False)]
    true = np.argsort(_distances(trial, sample), axis=1)[:, : K + 1]
    order = np.argsort(np.argsort(_distances(trial, centroids), axis=1), axis=1)
    ranks = np.sort(np.take_along_axis(order, own[true], axis=1).ravel())
    return centroids, int(ranks[min(len(ranks) - 1, math.ceil(COVER * len(ranks)))]) + 1


def scan(query: np.ndarray, turned: np.ndarray, originals: np.ndarray, blocks: list[np.ndarray], ids: np.ndarray, own: int, k: int):
    """The k nearest of a list part to one query: places and distances, nearest first, ties to the smaller id."""
    rows = np.flatnonzero(ids != own)
    exact = lambda at: np.sqrt(((originals[at] - query) ** 2).sum(axis=1))
    dim, d, rest, first, scores = len(query), 0, rows, rows[:0], np.empty(0)
    partial = np.zeros(len(rest))
    for block in blocks:
        piece = turned[d:d + block.shape[1]]
        partial = partial + ((block[rest] - piece) ** 2).sum(axis=1)
        d += len(piece)
        near = np.zeros(len(rest), bool)
        near[np.argpartition(partial, FIRST)[:FIRST] if len(rest) > FIRST else slice(None)] = True
        first, scores = np.concatenate([first, rest[near]]), np.concatenate([scores, exact(rest[near])])
        rest, partial = rest[~near], partial[~near]
        limit = np.partition(scores, k - 1)[k - 1] if len(scores) >= k else np.inf
        rounding = ROUNDING * (2 * math.sqrt((query**2).sum()) + limit)  # what is within the limit is no longer than query + limit
        slack = 1 + EPSILON / math.sqrt(d) if d < dim else 1
        alive = np.sqrt(partial * (dim / d)) <= slack * limit + rounding * math.sqrt(dim / d)
        rest, partial = rest[alive], partial[alive]
    first, scores = np.concatenate([first, rest]), np.concatenate([scores, exact(rest)])
    best = np.lexsort((ids[first], scores))[:k]
    return first[best], scores[best]


def nearest(vectors: DataFrame, queries, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of every vector that the condition ``queries`` picks."""
    spark = vectors.sparkSession
    steps = Steps(spark, "neighbours")
    found = "query_id long, vec_id long, score double"
    rows, dim = usable(vectors, steps)
    if dim == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = rows.count()
    size = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // dim))
    sample = _stack(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("v").toArrow().column(0))
    centroids, probes = fit_lists(sample, count)
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))[0]

    def assign(n):
        def of(batches):
            for batch in batches:
                if not len(batch):
                    continue
                near = np.argsort(_distances(_stack(batch.column(1)), centroids), axis=1)[:, :n]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * near.shape[1]), pa.array(near.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "v", "lists"])
        return of

    kind = rows.schema["v"].dataType.simpleString()
    schema = f"vec_id long, v {kind}, lists array<int>"
    indexed = steps.keep(rows.mapInArrow(assign(1), schema).select("vec_id", "v", F.col("lists")[0].alias("list")), "indexed")
    asked = steps.keep(rows.where(queries).mapInArrow(assign(probes), schema).select("vec_id", "v", F.explode("lists").alias("list")), "asked")
    sizes = indexed.groupBy("list").count().select("list", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    wanted = asked.groupBy("list").count().select("list", F.ceil(F.col("count") / QUERIES).cast("int").alias("qparts"))
    plan = steps.keep(sizes.join(wanted, "list"), "plan")  # one row for each list
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("vec_id")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(F.broadcast(plan), "list").withColumn("q", part("qparts", 1)).withColumn("p", every("parts"))
    right = indexed.join(F.broadcast(plan), "list").withColumn("p", part("parts", 2)).withColumn("q", every("qparts"))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        at, ids, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if len(asked) and len(held):
            held = held.sort_by("vec_id")  # a shuffle brings rows in any order
            originals, names = _stack(held.column("v")), held.column("vec_id").to_numpy()
            turned = (originals @ rotation).astype(np.float32)
            blocks = [np.ascontiguousarray(turned[:, d:d + BLOCK]) for d in range(0, dim, BLOCK)]
            points = _stack(asked.column("v"))
            for own, point, spun in zip(asked.column("vec_id").to_numpy(), points, points @ rotation):
                places, near = scan(point, spun, originals, blocks, names, own, k)
                at.append(np.full(len(places), own))
                ids.append(names[places])
                scores.append(near)
        return pa.table({"query_id": np.concatenate(at), "vec_id": np.concatenate(ids), "score": np.concatenate(scores)})

    cell = ["list", "p", "q"]
    hits = left.select(*cell, "vec_id", "v").groupBy(*cell).cogroup(right.select(*cell, "vec_id", "v").groupBy(*cell)).applyInArrow(search, found)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest_neighbours(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
