"""Whitened embeddings from mixed-precision eigenvectors.

Every entry ``c`` becomes the integer ``floor(1024 * c) + 100000``. Counts and sums
are exact. The covariance is summed over the tasks from entries centred at the
nearest integers below their means, with the remaining fractions of the means taken
off at the end: nothing large cancels, and while the sums stay below 2**53 they are
exact, so every order of tasks gives the same matrix. Only that matrix, the square of
the dimension, reaches the driver.

Its eigenvectors are computed in float32 and corrected by the iteration of Ogita and
Aishima in extended precision: matrix products give the residuals of orthogonality and
of diagonality, and their quotients by the gaps of the eigenvalues give a correction
whose error is squared in every step. Eigenvalues closer than the residual can separate
form a cluster; the matrix is projected on its vectors, shifted by its centre, and that
small problem is solved and refined by the same method before the iteration goes on.

Cases: rows whose vector is null, or holds a null or an entry that is not finite, are
left out. The dimension is the most common length among the others (of equally common
ones the longest); rows of another length are left out, and so are vectors of length 0.
Entries beyond 2**43 in size count as 2**43. Every row counts, also repeated ones; a
null id is carried along. ``whitened`` is null for a component without variance, and
``deviation`` where 64 bits do not hold it. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import stored

# The integer form of an entry.
FACTOR, OFFSET = 1024, 100_000
COMPONENTS = 8
_LARGEST = float(1 << 53)
_WIDE = np.longdouble
_STEPS = 60
_LONG = 1 << 63
_RESULT = ("vec_id LONG, component INT, n LONG, deviation LONG, whitened DOUBLE, "
           "explained DOUBLE, identity_error DOUBLE")


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix.

    Starts in float32 and returns extended precision; see the module text.
    """
    wide = np.asarray(matrix, _WIDE)
    size = float(np.abs(wide).max(initial=0.0))
    if not size:
        return np.zeros(len(wide), _WIDE), np.eye(len(wide), dtype=_WIDE)
    wide = wide / size
    _, start = np.linalg.eigh(wide.astype(np.float32))
    values, vectors = _refined(wide, start.astype(_WIDE))
    order = np.argsort(-values, kind="stable")
    return values[order] * size, vectors[:, order]


def _refined(matrix: np.ndarray, vectors: np.ndarray, depth: int = 0
             ) -> tuple[np.ndarray, np.ndarray]:
    """The iteration, until the corrections are as small as rounding."""
    n = len(matrix)
    norm = np.sqrt((matrix ** 2).sum())
    least = 8 * n * np.finfo(_WIDE).eps
    before = np.inf
    for _ in range(_STEPS):
        residual = np.eye(n, dtype=_WIDE) - vectors.T @ vectors
        projected = vectors.T @ matrix @ vectors
        projected = (projected + projected.T) / 2
        values = np.diag(projected) / (1 - np.diag(residual))
        off = projected - np.diag(values)
        bound = 2 * (np.sqrt((off ** 2).sum()) + norm * np.sqrt((residual ** 2).sum()))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > bound
        step = np.where(apart, (projected + values[None, :] * residual)
                        / np.where(apart, gaps, 1), residual / 2)
        np.fill_diagonal(step, np.diag(residual) / 2)
        vectors = vectors + vectors @ step
        clusters = _clusters(values, bound)
        for cluster in clusters:
            vectors[:, cluster] = vectors[:, cluster] @ _turned(
                matrix, vectors[:, cluster], norm * n * np.finfo(_WIDE).eps, depth)
        change = np.abs(step).max()
        # Within a cluster the off-diagonal part tells whether it is solved.
        for cluster in clusters:
            inner = vectors[:, cluster].T @ matrix @ vectors[:, cluster]
            np.fill_diagonal(inner, 0)
            change = max(change, np.abs(inner).max() / norm)
        if change <= least or change >= before / 2 and change < 1e-12:
            break
        before = change
    for _ in range(2):
        vectors = vectors + vectors @ (np.eye(n, dtype=_WIDE) - vectors.T @ vectors) / 2
    return ((matrix @ vectors) * vectors).sum(0), vectors


def _clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Groups of two and more eigenvalues that follow each other within ``bound``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _turned(matrix: np.ndarray, basis: np.ndarray, least: float, depth: int) -> np.ndarray:
    """Rotation of a cluster's basis to the eigenvectors of the projected matrix.

    Shifted by its mean and scaled to its own spread, the cluster has relative gaps
    that the whole matrix hides. A spread up to ``least`` is rounding.
    """
    k = basis.shape[1]
    centre = np.trace(basis.T @ matrix @ basis) / k
    inner = basis.T @ (matrix @ basis - centre * basis)
    inner = (inner + inner.T) / 2
    spread = np.abs(inner).max()
    if spread <= least:
        return np.eye(k, dtype=_WIDE)
    inner = inner / spread
    _, turn = np.linalg.eigh(inner.astype(np.float32))
    turn = turn.astype(_WIDE)
    # The scaled problem is solved to the same precision; a cluster in it goes down again.
    return _refined(inner, turn, depth + 1)[1] if depth < 3 else turn


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives; ``basis`` holds components over root variance."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    explained: np.ndarray
    varying: np.ndarray


def _rows(table: DataFrame, vector: str) -> DataFrame:
    """``vec_id`` and the vectors without a null or not finite entry, as doubles."""
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (
        F.abs(c) < F.lit(float("inf"))))
    return table.filter(F.col(vector).isNotNull() & finite & (F.size(vector) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"))


def _integers(vectors: pa.Array) -> np.ndarray:
    """Integer forms of the entries of all vectors, one after the other."""
    scaled = np.floor(FACTOR * vectors.flatten().to_numpy(zero_copy_only=False))
    return np.clip(scaled, -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _sums(rows: DataFrame) -> DataFrame:
    """``size, place, total`` per task: sums per length and place; place -1 counts rows."""
    schema = pa.schema([("size", pa.int32()), ("place", pa.int32()),
                        ("total", pa.decimal128(38, 0))])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat, owner = _integers(vectors), np.repeat(sizes, sizes)
            for size in np.unique(sizes).tolist():
                x = flat[owner == size].reshape(-1, size)
                # Two halves, so that sums of long batches stay within 64 bits.
                low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)
                part = [len(x), *(int(a) + (int(b) << 32) for a, b in
                                  zip(low, high, strict=True))]
                old = totals.get(size)
                totals[size] = part if old is None else [
                    a + b for a, b in zip(old, part, strict=True)]
        for size, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], schema=schema)
    parts = rows.mapInArrow(summed, "size INT, place INT, total DECIMAL(38,0)")
    return parts.groupBy("size", "place").agg(F.sum("total").alias("total"))


def _centred(batch: pa.RecordBatch, whole: np.ndarray) -> np.ndarray:
    """Entries less the integer parts of the means."""
    return _integers(batch.column("vector")).reshape(-1, len(whole)) - whole


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor ``n``; the upper triangle is summed by Spark."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], _WIDE) / n
    d = len(whole)
    up = np.triu_indices(d)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            y = _centred(batch, whole).astype(np.float64)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(up[0])), pa.int32()), pa.array(total[up])],
            names=["cell", "total"])
    cells = rows.mapInArrow(summed, "cell INT, total DOUBLE").groupBy("cell").agg(
        F.sum("total").alias("total")).toPandas()
    flat = np.zeros(len(up[0]))
    flat[cells["cell"].to_numpy()] = cells["total"].to_numpy()
    products = np.zeros((d, d), _WIDE)
    products[up] = flat
    products = products + np.triu(products, 1).T
    return products / n - np.outer(rest, rest)


def fit(rows: DataFrame, components: int) -> tuple[DataFrame, Whitening] | None:
    """The rows of the common length, and their whitening; ``None`` without rows."""
    totals = stored(_sums(rows), "sums")
    count = totals.filter("place = -1").orderBy(F.col("total").desc(), F.col("size").desc()).first()
    if count is None:
        return None
    n, d = int(count["total"]), count["size"]
    found = {r["place"]: int(r["total"]) for r in
             totals.filter((F.col("size") == d) & (F.col("place") >= 0)).collect()}
    sums = [found[place] for place in range(d)]
    rows = rows.filter(F.size("vector") == d)
    covariance = _covariance(rows, n, sums)
    values, vectors = eigenvectors(covariance)
    trace = np.trace(covariance)
    values, vectors = values[:components], vectors[:, :components]
    varying = values > d * np.finfo(np.float64).eps * max(values.max(initial=0), 0)
    basis = vectors / np.sqrt(np.where(varying, values, 1))
    explained = np.where(trace > 0, np.maximum(values, 0) / (trace if trace > 0 else 1), np.nan)
    return rows, Whitening(n, tuple(sums), basis.astype(np.float64),
                           explained.astype(np.float64), varying)


def _projected(batch: pa.RecordBatch, model: Whitening) -> np.ndarray:
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([s % model.n for s in model.sums], np.float64) / model.n
    return (_centred(batch, whole) - rest) @ model.basis


def _deviations(batch: pa.RecordBatch, model: Whitening) -> list[int | None]:
    """Exact sums of squares of ``n * x - S``, null beyond 64 bits."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = [s % model.n for s in model.sums]
    y = _centred(batch, whole)
    largest = (int(np.abs(y).max(initial=0)) + 1) * model.n
    if largest ** 2 * len(rest) < _LONG:
        return ((model.n * y - np.array(rest, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((model.n * a - r) ** 2 for a, r in zip(row, rest, strict=True))
             for row in y.tolist()]
    return [value if value < _LONG else None for value in exact]


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows less the identity."""
    k = len(model.varying)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = _projected(batch, model)
            total[:k] += z.T @ z
            total[k] += z.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())],
            names=["cell", "total"])
    cells = rows.mapInArrow(summed, "cell INT, total DOUBLE").groupBy("cell").agg(
        F.sum("total").alias("total")).toPandas()
    total = np.zeros((k + 1) * k)
    total[cells["cell"].to_numpy()] = cells["total"].to_numpy()
    total = total.reshape(k + 1, k) / model.n
    seen = total[:k] - np.outer(total[k], total[k]) - np.eye(k)
    return float(np.abs(seen[np.ix_(model.varying, model.varying)]).max(initial=0.0))


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, numbered from 1 by falling variance.

    ``whitened`` is the projection of the centred vector over the root of the variance,
    ``explained`` the component's share of all variance, ``deviation`` the exact sum of
    squares of ``n * x - S``, ``identity_error`` what the whitened rows, measured again,
    lack of an identity covariance.
    """
    rows = _rows(table, vector)
    fitted = fit(rows, components)
    if fitted is None:
        return table.sparkSession.createDataFrame([], _RESULT)
    rows, model = fitted
    error = _identity_error(rows, model)
    k = len(model.varying)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _projected(batch, model)
            m = len(z)
            ids = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(ids)),
                 pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, model.n), pa.int64()),
                 pa.array(_deviations(batch, model), pa.int64()).take(pa.array(ids)),
                 pa.array(z.ravel(), mask=np.tile(~model.varying, m)),
                 pa.array(np.tile(model.explained, m), from_pandas=True),
                 pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])
    return rows.mapInArrow(made, _RESULT)
