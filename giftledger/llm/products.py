"""Exact top-k inner products: vectors by descending length, partial sums along singular vectors, residual bounds.

Vectors are whole numbers (floor(1024 * component)), so scores are exact. They are ordered by descending length by a
distributed sort and cut into chunks of at most `CHUNK_VALUES` numbers, and searched in waves of 1, 4, 16, ... chunks from the longest on. After a
wave each query knows the k-th best score so far; a chunk whose longest vector times the query's length stays below
it cannot hold a better one, nor can any later chunk, so the query is done when that is the next. When no query is left the search ends.

Within a chunk both sides are rotated by the right singular vectors of a sample (`SAMPLE_ROWS` rows with the smallest hashes;
any rotation gives the same results, this one puts most of the length into the first coordinates). Products are summed
over a growing share of coordinates; what the others can add is at most the product of the residual lengths
(Cauchy-Schwarz), and pairs that cannot reach the k-th score are dropped. The rest get their score in integers.
Bounds allow for rounding, and ties with the k-th score are kept, so results are exact.

Chunks and query parts are blocks of bounded size however many vectors are equal or equally long; each pair of blocks
returns at most k rows a query.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without an id;
zero vectors do; shorter vectors count as followed by zeros; of rows that repeat an id the smallest vector counts;
equal scores go to the smaller id; no vectors, no rows. Scores that might not fit into 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Steps, read
from .vectors import padded, stacked, whole_vectors, width

K, SCALE = 10, 1024
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 8_000_000
#: Numbers in a chunk of vectors or a part of the queries, and in how many chunks a table is cut at least.
CHUNK_VALUES, LEAST_CHUNKS, LEAST_ROWS, WAVE = 4_194_304, 32, 1_024, 4
#: Pairs compared at once, and numbers gathered at once.
TILE_QUERIES, TILE_ROWS, GATHERED = 256, 2_048, 4_194_304
SHARES, SLACK, LARGEST = (0.125, 0.25, 0.5), 1e-9, 2.0**62


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the sample, by falling singular value."""
    size = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // dim))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("x").toArrow().column(0)
    sample = stacked(sample, dim).astype(np.float64)
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1].copy()


def ordered(rows: DataFrame, steps: Steps, size: int) -> DataFrame:
    """Rows by falling squared length with the number of their chunk; equal lengths go by id."""
    sort = steps.keep(rows.orderBy(F.desc("n2"), "vec_id").withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, within = F.shiftright("at", 33), F.expr(f"(at & {2**33 - 1}) div {size}")
    pieces = sort.groupBy(part.alias("part"), within.alias("within")).agg(F.max("n2").alias("longest"))
    # One row for each chunk: vectors / size and partitions of the sort at most.
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("part", "within")) - 1
    pieces = steps.keep(pieces.withColumn("chunk", number), "chunks")
    rows = sort.withColumns({"part": part, "within": within}).join(F.broadcast(pieces.select("part", "within", "chunk")), ["part", "within"])
    return rows.select("chunk", "vec_id", "x")


def _dots(a, b, left, right):
    """Products of paired rows, a bounded number of values at once."""
    step, out = max(1, GATHERED // max(1, left.shape[1])), []
    for i in range(0, len(a), step):
        out.append((left[a[i:i + step]] * right[b[i:i + step]]).sum(axis=1))
    return np.concatenate(out) if out else np.empty(0, left.dtype)


def _best(query, score, ids, k):
    """Places of the k best rows of each query: by score, then the smaller id; and their rank from 0."""
    order = np.lexsort((ids, -score, query))
    first = np.concatenate([[True], query[order][1:] != query[order][:-1]])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[rank < k], rank[rank < k]


def search(points, names, limits, vectors, ids, turn, k):
    """Exact k best of a block of vectors for each query of a block: place of the query, id, score.

    ``limits``: a score for each query below which nothing counts (-inf where there is none yet). Also tells how many
    coordinates of pairs were read.
    """
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    order = np.lexsort((ids, -length(vectors.astype(np.float64))))
    vectors, ids = vectors[order], ids[order]
    q, v, dim = points.astype(np.float64) @ turn, vectors.astype(np.float64) @ turn, points.shape[1]
    cuts = sorted({max(1, round(dim * s)) for s in SHARES} | {dim})
    q_rest, v_rest = ([length(m[:, c:]) for c in cuts] for m in (q, v))
    q_all, v_all = length(q), length(v)
    out, read_values = [[np.empty(0, np.int64)] * 3], 0
    for i in range(0, len(points), TILE_QUERIES):
        live = np.arange(i, min(i + TILE_QUERIES, len(points)))
        limit = limits.copy()
        held = [np.empty(0, np.int64)] * 3
        for j in range(0, len(v), TILE_ROWS):
            live = live[q_all[live] * v_all[j] * (1 + SLACK) >= limit[live]]
            if not len(live):
                break  # all that follow are no longer
            tile = slice(j, j + TILE_ROWS)
            partial = q[live, :cuts[0]] @ v[tile, :cuts[0]].T
            reach = np.outer(q_rest[0][live], v_rest[0][tile]) + SLACK * np.outer(q_all[live], v_all[tile])
            read_values += partial.size * cuts[0]
            a, b = np.nonzero((partial + reach >= limit[live][:, None]) & (names[live][:, None] != ids[tile][None]))
            partial, a, b = partial[a, b], live[a], b + j
            for n in range(1, len(cuts) - 1):
                read_values += len(a) * (cuts[n] - cuts[n - 1])
                partial = partial + _dots(a, b, q[:, cuts[n - 1]:cuts[n]], v[:, cuts[n - 1]:cuts[n]])
                alive = partial + q_rest[n][a] * v_rest[n][b] + SLACK * q_all[a] * v_all[b] >= limit[a]
                partial, a, b = partial[alive], a[alive], b[alive]
            read_values += len(a) * (dim - cuts[-2] if len(cuts) > 1 else 0)
            score = _dots(a, b, points, vectors)
            alive = score >= limit[a]
            held = [np.concatenate(p) for p in zip(held, (a[alive], ids[b[alive]], score[alive]))]
            if len(held[0]):
                kept, rank = _best(held[0], held[2], held[1], k)
                held = [p[kept] for p in held]
                full = rank == k - 1
                limit[held[0][full]] = np.maximum(limit[held[0][full]], held[2][full])
        out.append(held)
    return *(np.concatenate(p) for p in zip(*out)), read_values


def largest_products(vectors: DataFrame, queries: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` largest inner products of every vector that ``queries`` picks."""
    spark = vectors.sparkSession
    steps, schema = Steps(spark, "products"), "query_id long, rank int, vec_id long, score long"
    rows = whole_vectors(vectors, scale).where("vec_id IS NOT NULL")
    dim = max(1, width(rows))
    rows = rows.select("vec_id", padded(dim).alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    rows = steps.keep(rows.withColumn("n2", square), "vectors")
    count, longest = rows.agg(F.count("*"), F.max("n2")).first()
    if not count:
        return spark.createDataFrame([], schema)
    if longest >= LARGEST:
        raise ValueError("components are too large for scores of 64 bits")
    size = max(1, min(CHUNK_VALUES // dim, max(LEAST_ROWS, -(-count // LEAST_CHUNKS))))
    turn = rotation(rows, dim)
    chunked = steps.keep(ordered(rows, steps, size), "chunked")
    chunks = spark.read.parquet(f"{steps.folder}/chunks")
    # Lengths of the longest vector of each chunk, in order: one number for size vectors.
    reach = np.sqrt(np.array([r.longest for r in chunks.orderBy("chunk").select("longest").collect()]))
    asked = steps.keep(rows.where(queries).select(F.col("vec_id").alias("query_id"), "x", F.sqrt("n2").alias("length")), "asked")
    parts = max(1, -(-asked.count() // max(1, CHUNK_VALUES // dim)))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    best = spark.createDataFrame([], schema)

    def found(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = asked.column("query_id").to_numpy()
        at, ids, score = (np.empty(0, np.int64),) * 3
        if len(asked) and len(held):
            limits = asked.column("limit").to_numpy()
            at, ids, score, _ = search(stacked(asked.column("x"), dim), names, limits, stacked(held.column("x"), dim), held.column("vec_id").to_numpy(), turn, k)
        return pa.table({"query_id": names[at], "vec_id": ids, "score": score})

    start, wave, order = 0, 1, Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while start < len(reach):
        end = min(start + wave, len(reach))
        limits = best.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("limit"))
        known = asked.join(limits, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("-inf"))))
        # How many chunks of the wave may hold a better one; whoever can do without one can do without all later ones.
        able = F.filter(F.lit(reach[start:end] * (1 + SLACK)), lambda longest: longest * F.col("length") >= F.col("limit"))
        active = known.withColumn("needed", F.size(able)).where("needed > 0")
        if start and active.isEmpty():
            break
        every = F.explode(F.sequence(F.lit(start), F.lit(start - 1) + F.col("needed")))
        left = active.withColumn("part", part).withColumn("chunk", every)
        right = chunked.where(F.col("chunk").between(start, end - 1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        cell = ["chunk", "part"]
        hits = left.select(*cell, "query_id", "x", "limit").groupBy(*cell).cogroup(right.select(*cell, "vec_id", "x").groupBy(*cell))
        hits = hits.applyInArrow(found, "query_id long, vec_id long, score long").unionByName(best.drop("rank"))
        hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = steps.keep(hits.select("query_id", "rank", "vec_id", "score"), f"best-{start}")
        start, wave = end, wave * WAVE
    return best


def op12_largest_products(spark, sf_dir):
    return largest_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
    FROM whole q JOIN whole v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM pairs
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
"""
