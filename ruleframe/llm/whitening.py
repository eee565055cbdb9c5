"""Whitened embeddings: principal components of a distributed covariance, found step by step."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.session import stage

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this, times SCALE, count as this.
LARGEST = 1 << 40
#: Vector entries handled at once.
TILE = 1 << 20
EPS = float(np.finfo(np.float64).eps)


# --- leading eigenpairs of a symmetric matrix ------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of Q' A Q = T; vector k acts on the entries from k + 1."""
    a = np.array(matrix, np.float64)
    size = len(a)
    reflectors = []
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        x[0] += np.copysign(length, x[0])
        norm = np.linalg.norm(x)
        u = x / norm if norm > 0 else x
        reflectors.append(u)
        if norm > 0:
            inner = a[k + 1 :, k + 1 :]
            p = inner @ u
            w = 2 * (p - (u @ p) * u)
            inner -= np.outer(u, w) + np.outer(w, u)
            a[k + 1, k] = a[k, k + 1] = -np.copysign(length, a[k + 1, k])
            a[k + 2 :, k] = a[k, k + 2 :] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each shift."""
    tiny = np.finfo(np.float64).tiny / EPS
    below = np.zeros(len(shifts), np.int64)
    q = diagonal[0] - shifts
    for k, e in enumerate(np.append(off, 0.0)):
        q = np.where(np.abs(q) < tiny, -tiny, q)  # a zero counts as below, and is divided by
        below += q < 0
        if k + 1 < len(diagonal):
            q = diagonal[k + 1] - shifts - e * e / q
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected to the last bit that the counts can tell."""
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(count, float((diagonal - around).min()))
    high = np.full(count, float((diagonal + around).max()))
    width = max(abs(low[0]), abs(high[0]), np.finfo(np.float64).tiny) * EPS
    low, high = low - width, high + width
    wanted = len(diagonal) - np.arange(count)  # so many eigenvalues lie below all shifts above the value
    for _ in range(1200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = count_below(diagonal, off, middle) >= wanted
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; a pivot of zero becomes ``tiny``."""
    size = len(diagonal)
    d, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(size)
    x = b.copy()
    for i in range(size - 1):
        if abs(off[i]) > abs(d[i]):
            factor = d[i] / off[i]
            below = d[i + 1], up[i + 1]
            d[i + 1], up[i + 1] = up[i] - factor * below[0], -factor * below[1]
            d[i], up[i], up2[i] = off[i], below[0], below[1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            d[i] = d[i] if d[i] else tiny
            factor = off[i] / d[i]
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    d[-1] = d[-1] if d[-1] else tiny
    for i in range(size - 1, -1, -1):
        x[i] -= (up[i] * x[i + 1] if i + 1 < size else 0) + (up2[i] * x[i + 2] if i + 2 < size else 0)
        x[i] /= d[i]
        if abs(x[i]) > 1e150:  # keep the rest in range; the direction is all that counts
            x *= 1e-150
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors by inverse iteration; those of a cluster of close values are kept orthogonal to each other."""
    size = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if len(off) else 0.0, np.finfo(np.float64).tiny)
    random = np.random.default_rng(0)
    vectors: list[np.ndarray] = []
    cluster = 0
    before = np.inf
    for k, value in enumerate(values):
        if before - value > 1e-3 * norm:
            cluster = k
        shift = min(value, before - 10 * EPS * norm) if k > cluster else value  # equal values need shifts of their own
        before = shift
        x = random.standard_normal(size)
        for _ in range(6):
            for other in vectors[cluster:k]:
                x -= (other @ x) * other
            x /= np.linalg.norm(x)
            x = _solve(diagonal, off, shift, x, EPS * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in vectors[cluster:k]:
                x -= (other @ x) * other
            x /= np.linalg.norm(x)
        vectors.append(x)
    return np.array(vectors).reshape(len(values), size)


def principal_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    Values that rounding cannot tell from zero have no component. Of each vector the largest entry is positive.
    """
    size = len(matrix)
    count = min(count, size)
    if not count:
        return np.zeros(0), np.zeros((0, size))
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, count)
    values = values[values > 32 * size * EPS * max(values[0], 0.0)]
    vectors = leading_vectors(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        part = vectors[:, k + 1 :]
        part -= 2 * np.outer(part @ reflectors[k], reflectors[k])
    if len(vectors):
        largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
        vectors *= np.sign(largest)[:, None]
    return values, vectors


# --- sums over all vectors -------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with the sums ``sums``, exact; eigenvalues and vectors of their covariance."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as exact integers."""
        if self.n * (int(np.abs(x).max(initial=0)) + 1) >= 1 << 62:
            x = x.astype(object)
        return x * self.n - np.array(self.sums, x.dtype)

    def deviation(self, centred: np.ndarray) -> np.ndarray | list[int | None]:
        """The sum of the squares of each row; None if no long holds it."""
        if centred.dtype != object and float(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 2.0**62:
            return (centred * centred).sum(axis=1)
        exact = [sum(int(v) ** 2 for v in row) for row in centred]
        return [v if v < 1 << 63 else None for v in exact]

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.vectors.T / np.sqrt(self.values)


def _finite(vector: str) -> Column:
    entries = F.col(vector).cast("array<double>")
    return F.coalesce(F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def _tiles(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of all batches with their vectors as integers, some ``TILE`` entries at a time."""
    step = max(1, TILE // size)
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            tile = batch.slice(first, step)
            entries = tile.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield tile, np.clip(np.floor(entries * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _summed(rows: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` of all tiles, a matrix of doubles: one matrix per task, added up entry by entry in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _tiles(batches, "vector", size):
            now = part(x)
            total = now if total is None else total + now
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "s"])

    sums = rows.select("vector").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(size * size)
    out[sums["at"].to_numpy()] = sums["s"].to_numpy()
    return out.reshape(size, size)


def fit_whitening(rows: DataFrame, size: int, components: int) -> Whitening:
    """Exact sums, then the covariance of centred vectors, then its leading components.

    The vectors are centred at the whole number next to their mean, so that products of usual entries are
    exact whatever order they are added in; what is left of the mean, at most a half, is taken off the covariance.
    The driver sees the number of rows, the sums and one matrix of ``size`` by ``size``.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _tiles(batches, "vector", size):
            total = pa.array(x.sum(axis=0)).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), total, pa.array(np.full(size, len(x)))], ["dim", "s", "n"])

    added = rows.select("vector").mapInArrow(sums, "dim long, s decimal(38,0), n long").groupBy("dim")
    found = added.agg(F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    if not found:
        return Whitening(0, (0,) * size, 0.0, np.zeros(0), np.zeros((0, size)))
    n, total = found[0]["n"], tuple(int(r["s"]) for r in found)
    middle = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    rest = np.array([s - n * int(m) for s, m in zip(total, middle)], np.float64) / n

    def products(x: np.ndarray) -> np.ndarray:
        y = (x - middle).astype(np.float64)
        return y.T @ y

    covariance = _summed(rows, size, products) / n - np.outer(rest, rest)
    values, vectors = principal_components(covariance, components)
    return Whitening(n, total, float(np.trace(covariance)), values, vectors)


def _identity_error(rows: DataFrame, size: int) -> float:
    """The largest entry of the covariance of ``z``, minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            z = batch.column("z").flatten().to_numpy().reshape(-1, size)
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "s"])

    sums = rows.select("z").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").toArrow()
    total = sums["s"].to_numpy().reshape(size + 1, size + 1)
    mean = total[size, :size] / total[size, size]
    return float(np.abs(total[:size, :size] / total[size, size] - np.outer(mean, mean) - np.eye(size)).max())


def whiten_embeddings(
    table: DataFrame, *, id: str = "vec_id", vector: str = "embedding", components: int = 32
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): each vector along the leading components.

    An entry c counts as floor(64 c) + 1000000. The covariance of all usable vectors is added up in Spark, made
    tridiagonal by Householder reflections, its leading eigenvalues are found by Sturm counts and bisection, the
    vectors by inverse iteration, and every vector is projected on them in its own task. ``identity_error`` is
    measured on the projected rows.

    Vectors that are null or hold null or non-finite entries take no part, nor do those of another length than
    the most frequent one (the longer one if two are as frequent), nor empty ones. Entries beyond 2**34 count as that.
    Components whose variance rounding cannot tell from zero are left out, so that equal vectors, or a single one, give
    no rows. A null id is kept; rows that repeat count each; ``deviation`` is null where no long holds it.
    An empty table gives no rows. The matrix, ``size`` squared, is all that the driver holds.
    """
    spark = table.sparkSession
    kind = table.schema[id].dataType.simpleString()
    usable = table.where(_finite(vector)).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    lengths = usable.groupBy(F.size("vector").alias("size")).count().where("size > 0")
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    empty = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if most is None:
        return spark.createDataFrame([], empty)
    size = most["size"]
    rows = usable.where(F.size("vector") == size)
    model = fit_whitening(rows, size, components)
    found = len(model.values)
    if not found:
        return spark.createDataFrame([], empty)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, x in _tiles(batches, "vector", size):
            centred = model.centred(x)
            z = model.whiten(centred)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * found), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([tile.column("id"), pa.array(model.deviation(centred), pa.int64()), lists], ["id", "deviation", "z"])

    projected = stage(rows.mapInArrow(project, f"id {kind}, deviation long, z array<double>"), "whitened")
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    each = projected.select("id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        "id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(_identity_error(projected, found)).alias("identity_error"),
    )
