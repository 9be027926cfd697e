"""Whitening of embeddings: centred covariance, its leading eigenvectors, and a broadcast projection.

Vectors are whole numbers x = floor(256 * component). The covariance is that of the distinct vectors, so copies do not pull
the axes: one pass sums them exactly, a second sums the products of centred components. Tasks send one partial
matrix each, and its cells are added in as many groups as there are cells. The driver holds that one matrix
(`MOST_DIMENSIONS` wide at most), brings it to tridiagonal form by Householder reflections, finds the leading eigenvalues by bisection
on Sturm counts and their vectors by inverse iteration, made orthogonal again within clusters of close
eigenvalues, and turns them back. All rows are then projected in tasks that hold the mean and the components only.

Defined results: null vectors and those with null or non-finite components are left out; shorter vectors count as
followed by zeros; rows that repeat an id are each projected, also a null one; directions in which the vectors do not differ
have no component, so there are fewer than asked for, or none, when the vectors span less (one distinct
vector: none); no vectors, no rows. `deviation` is null where it needs more than 64 bits, `deviation_exact` has it
then too, up to 38 digits.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Steps, read
from .vectors import padded, stacked, whole_vectors, width

SCALE, COMPONENTS = 256, 4
#: Eigenvalues closer than this share of the largest are a cluster, whose vectors are made orthogonal to each other.
CLUSTER, SOLVES, EPS = 1e-3, 5, np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, second diagonal and reflection vectors of a symmetric matrix brought to tridiagonal form."""
    a, n, turned = matrix.copy(), len(matrix), []
    for i in range(n - 2):
        below = a[i + 1:, i]
        v, size = below.copy(), np.linalg.norm(below)
        v[0] += size if v[0] >= 0 else -size
        weight = v @ v
        if weight > 0:
            v /= np.sqrt(weight)
            rest = a[i + 1:, i + 1:]
            p = rest @ v
            p -= (v @ p) * v
            rest -= 2 * (np.outer(v, p) + np.outer(p, v))
            a[i + 1:, i] -= 2 * (v @ below) * v
        turned.append(v)
    return a.diagonal().copy(), a.diagonal(-1).copy(), turned


def sturm_count(diagonal: np.ndarray, second: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each of the values: negative pivots of the shifted matrix."""
    least = EPS * EPS * max(1e-300, np.abs(diagonal).max(), np.abs(second).max(initial=0))
    below, pivot = np.zeros(len(at), int), np.ones(len(at))
    for i, d in enumerate(diagonal):
        pivot = d - at - (second[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, second: np.ndarray, m: int) -> np.ndarray:
    """The m largest eigenvalues, falling, each bisected until its interval cannot be halved."""
    n = len(diagonal)
    reach = np.abs(np.append(second, 0)) + np.abs(np.append(0, second))
    low, high = np.full(m, (diagonal - reach).min()), np.full(m, (diagonal + reach).max())
    high += EPS * n * np.abs(np.append(low, high)).max()
    wanted = n - 1 - np.arange(m)
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        above = sturm_count(diagonal, second, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve(diagonal: np.ndarray, second: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - shift) y = b by elimination with row exchanges; vanishing pivots become ``least``."""
    n, b = len(diagonal), b.copy()
    first, next_, third = diagonal - shift, np.append(second, 0.0), np.zeros(n)
    for i in range(n - 1):
        row, following, further = second[i], first[i + 1], next_[i + 1]
        if abs(row) > abs(first[i]):
            factor = first[i] / row
            first[i + 1], next_[i + 1] = next_[i] - factor * following, -factor * further
            first[i], next_[i], third[i] = row, following, further
            b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
        else:
            first[i] = first[i] if abs(first[i]) > least else least
            factor = row / first[i]
            first[i + 1] -= factor * next_[i]
            b[i + 1] -= factor * b[i]
    y = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        pivot = first[i] if abs(first[i]) > least else least
        y[i] = (b[i] - next_[i] * y[i + 1] - third[i] * y[i + 2]) / pivot
    return y[:n]


def leading_vectors(matrix: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The m largest eigenvalues of a symmetric matrix and their unit eigenvectors, as columns."""
    diagonal, second, turned = tridiagonal(matrix)
    values = leading_values(diagonal, second, m)
    norm = max(np.abs(diagonal).max(), np.abs(second).max(initial=0))
    draw, vectors, shift = np.random.default_rng(7), np.zeros((len(matrix), m)), np.inf
    for j, value in enumerate(values):
        close = [i for i in range(j) if values[i] - value <= CLUSTER * norm]
        shift = min(value, shift - 10 * EPS * norm) if close else value  # equal eigenvalues need shifts that differ
        y = draw.normal(size=len(matrix))
        for _ in range(SOLVES):
            y = _solve(diagonal, second, shift, y / np.linalg.norm(y), EPS * norm)
            for _ in range(2):
                for i in close:
                    y = y - (vectors[:, i] @ y) * vectors[:, i]
                y = y / np.linalg.norm(y)
        vectors[:, j] = y
    for i in range(len(turned) - 1, -1, -1):
        vectors[i + 1:] -= 2 * np.outer(turned[i], turned[i] @ vectors[i + 1:])
    return values, vectors / np.linalg.norm(vectors, axis=0)


def _cells(work, kind: str):
    """One partial sum a task, cell by cell: (cell, value)."""

    def of(batches):
        total = None
        for batch in batches:
            if len(batch):
                part = work(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            total = total.ravel()
            for i in range(0, len(total), 100_000):
                piece = total[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(i, i + len(piece))), pa.array(piece)], ["cell", "value"])

    return of, f"cell long, value {kind}"


def _summed(rows: DataFrame, work, kind: str, cells: int) -> np.ndarray:
    of, schema = _cells(work, kind)
    total = rows.mapInArrow(of, schema).groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(cells, np.int64 if kind == "long" else np.float64)
    out[total.column("cell").to_numpy()] = total.column("value").to_numpy()
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted projection: distinct vectors, their sums, mean, components as columns, eigenvalues, shares, largest error."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.axes / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n * x - sum) squared, one for each row."""
        most = self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))
        if most * most * len(self.sums) < 2**63:
            return ((self.n * x - self.sums) ** 2).sum(axis=1).tolist()
        wide = self.n * x.astype(object) - self.sums.astype(object)
        return (wide * wide).sum(axis=1).tolist()


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (x: whole numbers, ``dim`` of them); None where they do not differ."""
    distinct = Steps(rows.sparkSession, "whitening").keep(rows.distinct(), "distinct")
    n = distinct.count()
    if n < 2 or not dim:
        return None
    sums = _summed(distinct, lambda column: stacked(column, dim).sum(axis=0), "long", dim)
    mean = sums / n

    def products(column):
        centred = stacked(column, dim) - mean
        return centred.T @ centred

    covariance = _summed(distinct, products, "double", dim * dim).reshape(dim, dim) / n
    covariance = (covariance + covariance.T) / 2
    trace = covariance.trace()
    values, axes = leading_vectors(covariance, min(components, dim))
    real = values > trace * dim * EPS * 4
    if not real.any():
        return None
    made = Whitening(n, sums, mean, axes[:, real], values[real], values[real] / trace, 0.0)
    m = int(real.sum())

    def whitened(column):
        w = made.project(stacked(column, dim))
        return w.T @ w

    error = np.abs(_summed(distinct, whitened, "double", m * m).reshape(m, m) / n - np.eye(m)).max()
    return Whitening(n, sums, mean, made.axes, made.values, made.explained, float(error))


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each vector and component; see `Whitening`."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_exact decimal(38,0)")
    rows = whole_vectors(vectors, scale)
    dim = width(rows)
    rows = Steps(vectors.sparkSession, "whitening").keep(rows.select(padded(dim).alias("x"), "vec_id"), "vectors")
    made = fit(rows.select("x"), dim, components)
    if made is None:
        return vectors.sparkSession.createDataFrame([], schema)
    m = len(made.values)

    def project(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = stacked(batch.column(0), dim)
            exact, each = made.deviation(x), np.repeat(np.arange(len(x)), m)
            fits = [d if d < 2**63 else None for d in exact]
            table = {
                "vec_id": batch.column(1).take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(each), made.n)),
                "deviation": pa.array(fits, pa.int64()).take(pa.array(each)),
                "whitened": pa.array(made.project(x).ravel()),
                "explained": pa.array(np.tile(made.explained, len(x))),
                "identity_error": pa.array(np.full(len(each), made.identity_error)),
                "deviation_exact": pa.array([Decimal(d) for d in exact], pa.decimal128(38, 0)).take(pa.array(each)),
            }
            yield pa.RecordBatch.from_pydict(table)

    return rows.mapInArrow(project, schema)


def op13_whitening(spark, sf_dir):
    return whiten(read(spark, sf_dir, "embeddings"))
