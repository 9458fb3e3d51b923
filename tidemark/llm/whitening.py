"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Components are scaled to integers ``x = floor(SCALE * c) + SHIFT``.  Every task sums its vectors, then, with the sums of all
known, the products of the centred vectors; Spark adds both by row of the matrix.  The scatter, as many numbers as a vector
has components squared, is factored by Cholesky with pivoting, and Jacobi rotations are applied from one side to the columns
of the triangular factor itself, never to a product of it: the norms of the rotated columns give the eigenvalues, the
normalised columns the components.  All vectors are then projected, and once more the products of what comes out are summed,
to say how far their covariance is from the identity.

Sums and deviations are exact integers; the shift cancels in everything that is centred and is left out of the arithmetic.
Only components whose eigenvalue stands out from rounding are kept, so vectors that are all equal have none.

Rows whose vector is null or holds null or non-finite entries, or entries beyond LARGEST, whose integers do not fit, take no
part.  Vectors of different lengths are whitened apart; one without entries has no components.  Every one of several equal rows
counts and is returned; a null id stays; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**56  # SCALE times that still is a long
ROWS = 1024  # vectors worked on at a time
SWEEPS = 60
LONG = 2**63


@dataclass(frozen=True)
class Model:
    """What whitens the vectors of one length."""

    n: int
    sums: list[int]  # of the integers without SHIFT
    directions: np.ndarray  # components as columns, by falling eigenvalue, over the roots of their eigenvalues
    explained: np.ndarray
    error: float | None = None


# ---- the eigenproblem

def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``order`` and lower trapezoidal ``factor`` with ``matrix[order][:, order] = factor @ factor.T`` up to rounding."""
    size = len(matrix)
    order, left = np.arange(size), matrix.diagonal().copy()
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(size):
        pivot = k + int(np.argmax(left[k:]))
        if not left[pivot] > least:
            return order, factor[:, :k]
        for array in (order, left, factor):
            array[[k, pivot]] = array[[pivot, k]]
        factor[k, k] = np.sqrt(left[k])
        below = matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return order, factor


def rotated(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` turned by Jacobi rotations until they are orthogonal, as rows.

    A sweep meets every pair once, in rounds of disjoint pairs that turn together.
    """
    rows = factor.T.copy()
    count = len(rows)
    if count < 2:
        return rows
    ring = np.arange(count + count % 2)  # one place stays empty where the number is odd
    for _ in range(SWEEPS):
        turned = False
        for _ in range(ring.size - 1):
            p, q = ring[: ring.size // 2], ring[ring.size // 2 :][::-1]
            both = (p < count) & (q < count)
            turned |= _turn(rows, p[both], q[both])
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if not turned:
            return rows
    raise ArithmeticError("rotations did not settle")


def _turn(rows: np.ndarray, p: np.ndarray, q: np.ndarray) -> bool:
    a, b = rows[p], rows[q]
    aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
    due = np.abs(ab) > np.finfo(float).eps * np.sqrt(aa) * np.sqrt(bb)
    if not due.any():
        return False
    a, b, p, q = a[due], b[due], p[due], q[due]
    slope = (bb[due] - aa[due]) / (2 * ab[due])
    tangent = np.where(slope >= 0, 1.0, -1.0) / (np.abs(slope) + np.hypot(1.0, slope))
    cosine = 1 / np.hypot(1.0, tangent)
    sine = (cosine * tangent)[:, None]
    cosine = cosine[:, None]
    rows[p], rows[q] = cosine * a - sine * b, sine * a + cosine * b
    return True


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter, falling, and unit eigenvectors as columns; those lost in rounding are left out."""
    order, factor = pivoted_cholesky(scatter)
    rows = rotated(factor)
    values = (rows * rows).sum(axis=1)
    keep = np.argsort(-values, kind="stable")
    keep = keep[values[keep] > len(scatter) * np.finfo(float).eps * values.max(initial=0.0)]
    vectors = np.empty((len(scatter), keep.size))
    vectors[order] = (rows[keep] / np.sqrt(values[keep])[:, None]).T
    return values[keep], vectors


# ---- sums over all vectors

def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, x``: vectors as integers without SHIFT; rows that take no part are left out."""
    scaled = F.transform(F.col(embedding), lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    bad = F.exists(F.col(embedding), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= LARGEST))
    fit = F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.size(embedding) > 0)
    return vectors.where(fit).select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer matrix of vectors of one length, a bounded number of rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            ids, lists = part.column("vec_id"), part.column("x")
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                yield ids.take(pa.array(own)), flat[starts[own][:, None] + np.arange(size)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: as longs, or as Python integers where longs are too small."""
    peak = max(int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0), 0)
    if peak < LONG:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(deviation: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where it is no long."""
    peak = int(np.abs(deviation).max(initial=0))
    if peak * peak * deviation.shape[1] < LONG:
        return (deviation.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = (deviation.astype(object) ** 2).sum(axis=1).tolist()
    return [value if value < LONG else None for value in exact]


def _sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact sums of each length: a number per length and component reaches the driver."""

    def run(batches):
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for _, x in _matrices(batches):
            size = x.shape[1]
            n, own = totals.get(size, (0, np.zeros(size, object)))
            wide = int(np.abs(x).max()) * len(x) >= LONG
            totals[size] = n + len(x), own + (x.astype(object) if wide else x).sum(axis=0).astype(object)
        for size, (n, own) in totals.items():
            rows = [[size] * size, list(range(size)), [n] * size, [str(v) for v in own]]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["size", "i", "n", "total"])

    parts = vectors.mapInArrow(run, "size long, i long, n long, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    out: dict[int, tuple[int, list[int]]] = {}
    for row in parts.groupBy("size", "i").agg(F.sum("n").alias("n"), total).orderBy("size", "i").collect():
        out.setdefault(row["size"], (row["n"], []))[1].append(int(row["total"]))
    return out


def _products(vectors: DataFrame, points: Callable[[np.ndarray], np.ndarray | None]) -> dict[int, np.ndarray]:
    """Sum of outer products of the ``points`` a task makes of vectors, by vector length.

    Tasks' matrices are added row by row in the order of the tasks, so a rerun gives the same digits.
    """

    def run(batches):
        release()
        totals: dict[int, np.ndarray] = {}
        for _, x in _matrices(batches):
            centred = points(x)
            if centred is not None:
                totals[x.shape[1]] = totals.get(x.shape[1], 0.0) + centred.T @ centred
        task = TaskContext.get().partitionId()
        for size, matrix in totals.items():
            n = len(matrix)
            rows = [pa.array([size] * n), pa.array(range(n)), pa.array([task] * n), pa.array(matrix.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, ["size", "i", "task", "row"])

    def added(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        row = np.zeros(len(group.column("row")[0]))
        for part in group.column("row"):
            row += np.array(part.as_py())
        kept = [group.column("size")[:1].combine_chunks(), group.column("i")[:1].combine_chunks()]
        return pa.Table.from_arrays([*kept, pa.array([row.tolist()])], ["size", "i", "row"])

    parts = vectors.mapInArrow(run, "size long, i long, task long, row array<double>")
    rows = parts.groupBy("size", "i").applyInArrow(added, "size long, i long, row array<double>")
    out: dict[int, list] = {}
    for row in rows.orderBy("size", "i").collect():
        out.setdefault(row["size"], []).append(row["row"])
    return {size: np.array(matrix) for size, matrix in out.items()}


# ---- the operator

def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each vector length among ``integers``."""
    sums = _sums(vectors)

    def centred(x: np.ndarray) -> np.ndarray:
        n, own = sums[x.shape[1]]
        return _deviations(x, n, own).astype(float) / n

    models = {}
    for size, scatter in _products(vectors, centred).items():
        n, own = sums[size]
        trace = scatter.diagonal().sum()
        values, directions = eigen(scatter)
        values, directions = values[:components], directions[:, :components]
        models[size] = Model(n, own, directions / np.sqrt(values / n), values / trace)

    def projected(x: np.ndarray) -> np.ndarray | None:
        model = models[x.shape[1]]
        if not model.explained.size:
            return None
        # A column of ones brings the sums along, to centre by.
        return np.hstack([whitened(x, model), np.ones((len(x), 1))])

    for size, products in _products(vectors, projected).items():
        model = models[size]
        mean = products[-1, :-1] / model.n
        covariance = products[:-1, :-1] / model.n - np.outer(mean, mean)
        error = float(np.abs(covariance - np.eye(len(covariance))).max())
        models[size] = Model(model.n, model.sums, model.directions, model.explained, error)
    return models


def whitened(x: np.ndarray, model: Model) -> np.ndarray:
    """Coordinates of integer vectors: rows by component."""
    return (_deviations(x, model.n, model.sums).astype(float) / model.n) @ model.directions


def transform(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``vec_id, whitened`` (an array) of each vector of ``integers``."""

    def run(batches):
        for ids, x in _matrices(batches):
            values = whitened(x, models[x.shape[1]])
            yield pa.RecordBatch.from_arrays([ids, pa.array(values.tolist(), pa.list_(pa.float64()))], ["vec_id", "whitened"])

    return vectors.mapInArrow(run, "vec_id long, whitened array<double>")


def report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, with the exact deviation of the vector (null where it is no long)."""
    vectors = integers(embeddings)
    models = fit(vectors, components)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for ids, x in _matrices(batches):
            model = models[x.shape[1]]
            count, rows = model.explained.size, len(x)
            if not count:
                continue
            each = np.repeat(np.arange(rows), count)
            squares = pa.array(_squares(_deviations(x, model.n, model.sums)), pa.int64())
            columns = [
                ids.take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * count, model.n, np.int64)),
                squares.take(pa.array(each)),
                pa.array(whitened(x, model).ravel()),
                pa.array(np.tile(model.explained, rows)),
                pa.array(np.full(rows * count, model.error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.mapInArrow(run, schema)
