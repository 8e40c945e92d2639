"""Embedding whitening: pivoted Cholesky of the centred scatter, then
one-sided Jacobi on the triangular factor.

Entries become whole numbers x = floor(scale * c) + shift, so counts and sums
are exact. A second pass over the vectors subtracts the mean and sums the
products of what is left; a task sends one triangle of dimension^2 / 2 cells,
which Spark adds up cell by cell. The driver holds only that matrix. It is
factored as L L' with the largest remaining pivot first, which also gives its
rank; Jacobi rotations then make the columns of L orthogonal. The norm of a
rotated column is the root of an eigenvalue (times n), and the column over
its norm the component, so the scatter is never multiplied by itself and
small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors that are worked at once.
ROWS = 2048
#: Numbers from here on do not become a long.
LIMIT = 2.0 ** 61


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learnt: ``floors`` and ``rest`` are the whole part of the
    mean and n times what is left of it, ``components`` the columns."""

    n: int
    dim: int
    scale: int
    shift: int
    floors: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def _whole(lists: pa.Array, dim: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their x): vectors of ``dim`` finite entries
    whose x are longs."""
    taking = np.asarray(lists.is_valid()) & (np.asarray(lists.value_lengths().fill_null(-1)) == dim)
    values = lists.filter(pa.array(taking)).flatten().cast(pa.float64()).fill_null(np.nan)
    x = np.floor(values.to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
    good = (np.abs(x) < LIMIT).all(axis=1)
    return np.flatnonzero(taking)[good], x[good].astype(np.int64) + shift


def _blocks(batches: Iterator[pa.RecordBatch], vec_col: str, dim: int, scale: int,
            shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            rows, x = _whole(part.column(vec_col), dim, scale, shift)
            if len(rows):
                yield part.take(pa.array(rows)), x


def _dimension(df: DataFrame, vec_col: str, scale: int) -> int:
    """The commonest length of the vectors that take part, the smaller one
    of a tie; 0 if there are none."""
    usable = F.forall(vec_col, lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < LIMIT))
    top = df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & usable) \
        .groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return top[0]["d"] if top else 0


def _cells(matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The upper triangle, row by row, as (i, j, value)."""
    for i, row in enumerate(matrix):
        js = np.arange(i, len(row))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(js), i, np.int32)), pa.array(js.astype(np.int32)), pa.array(row[i:])],
            names=["i", "j", "value"])


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    """The symmetric matrix of the summed cells (size^2 / 2 numbers)."""
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.floors) - model.rest / model.n


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L' and as many columns as ``a`` has rank. Its rows are in
    the order of ``a``; in the order of the pivots it is lower triangular."""
    size = len(a)
    diagonal = np.diag(a).astype(np.float64).copy()
    factor = np.zeros((size, size))
    order = np.arange(size)
    least = size * np.finfo(np.float64).eps * max(diagonal.max(initial=0), 0.0)
    for k in range(size):
        best = k + int(np.argmax(diagonal[order[k:]]))
        order[[k, best]] = order[[best, k]]
        p = order[k]
        if diagonal[p] <= least:
            return factor[:, :k]
        factor[p, k] = np.sqrt(diagonal[p])
        below = order[k + 1:]
        factor[below, k] = (a[below, p] - factor[below, :k] @ factor[p, :k]) / factor[p, k]
        diagonal[below] -= factor[below, k] ** 2
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated in pairs until all are orthogonal to
    working precision, longest first. A sweep meets every pair once, in
    rounds of disjoint pairs that are rotated together."""
    size = factor.shape[1]
    columns = np.ascontiguousarray(factor.T)
    if size % 2:
        columns = np.vstack([columns, np.zeros(factor.shape[0])])
    seats = np.arange(len(columns))
    close = np.finfo(np.float64).eps * np.sqrt(max(1, factor.shape[0]))
    for _ in range(sweeps if size > 1 else 0):
        turned = False
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[:len(seats) // 2 - 1:-1]
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            now = np.abs(ab) > close * np.sqrt(aa * bb)
            if now.any():
                turned = True
                a, b, p, q = a[now], b[now], p[now], q[now]
                zeta = (bb[now] - aa[now]) / (2 * ab[now])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = (1 / np.hypot(1, t))[:, None]
                s = c * t[:, None]
                columns[p], columns[q] = c * a - s * b, s * a + c * b
            seats[1:] = np.roll(seats[1:], 1)
        if not turned:
            break
    norms = np.sqrt((columns * columns).sum(axis=1))
    return columns[np.argsort(-norms, kind="stable")][:size].T


def fit(df: DataFrame, vec_col: str, scale: int = 1024, shift: int = 100_000) -> Whitening | None:
    """Learn from all vectors that take part: those of the commonest length
    whose entries are neither null nor non-finite nor so large that x is no
    long. Repeated rows count each. None if there are no such vectors."""
    vectors = df.select(F.col(vec_col).alias("v"))
    dim = _dimension(vectors, "v", scale)
    if not dim:
        return None

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, halves = 0, np.zeros((2, dim), np.int64)
        for _, x in _blocks(batches, "v", dim, scale, shift):
            n += len(x)
            halves[0] += (x >> 32).sum(axis=0)
            halves[1] += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n, np.int64)),
             pa.array(halves[0]), pa.array(halves[1])], names=["j", "n", "high", "low"])

    rows = vectors.mapInArrow(sums, "j int, n long, high long, low long").groupBy("j").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]) \
        .orderBy("j").collect()
    n = rows[0]["n"]
    totals = [(int(r["high"]) << 32) + int(r["low"]) for r in rows]
    floors = np.array([t // n for t in totals], np.int64)
    rest = np.array([t % n for t in totals], np.int64)
    model = Whitening(n, dim, scale, shift, floors, rest, np.zeros((dim, 0)), np.zeros(0), 0.0)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((dim, dim))
        for _, x in _blocks(batches, "v", dim, scale, shift):
            y = _centred(x, model)
            out += y.T @ y
        yield from _cells(out)

    whole = _summed(vectors.mapInArrow(scatter, "i int, j int, value double"), dim)
    rotated = one_sided_jacobi(pivoted_cholesky(whole))
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    components = rotated / norms
    largest = components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])] if len(norms) else norms
    return Whitening(n, dim, scale, shift, floors, rest, components * np.where(largest < 0, -1.0, 1.0),
                     norms ** 2 / n, float(np.trace(whole)) / n)


def identity_error(df: DataFrame, vec_col: str, model: Whitening, components: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity, over all vectors that take part."""
    k = min(components, len(model.eigenvalues))
    turn = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k + 1, k + 1))
        for _, x in _blocks(batches, "v", model.dim, model.scale, model.shift):
            w = np.column_stack([np.ones(len(x)), _centred(x, model) @ turn])
            out += w.T @ w
        yield from _cells(out)

    vectors = df.select(F.col(vec_col).alias("v"))
    m = _summed(vectors.mapInArrow(moments, "i int, j int, value double"), k + 1) / model.n
    return float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max(initial=0.0))


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Exact sums over the dimensions of (n * x - S)^2, as n^2 a - 2 n b + c
    from the distances to the whole part of the mean."""
    n, rest = model.n, [int(r) for r in model.rest]
    most = max(-int(x.min()), int(x.max())) + max(-int(model.floors.min()), int(model.floors.max()))
    if most * most * model.dim >= 1 << 63 or most * sum(rest) >= 1 << 63:
        return [sum((n * (a - f) - r) ** 2 for a, f, r in zip(row, model.floors.tolist(), rest)) for row in x.tolist()]
    y = x - model.floors
    squares, products, last = (y * y).sum(axis=1), y @ model.rest, sum(r * r for r in rest)
    return [n * n * a - 2 * n * b + last for a, b in zip(squares.tolist(), products.tolist())]


def transform(df: DataFrame, id_col: str, vec_col: str, model: Whitening, components: int = 8) -> DataFrame:
    """One row per vector that takes part and component: id, component (from
    1), n, deviation decimal(38,0) (null beyond 38 digits), whitened,
    explained and identity_error. Rows with a null id are kept, repeated ones
    too; other columns are ignored. Components beyond the rank of the scatter
    have no eigenvalue to divide by and are left out."""
    k = min(components, len(model.eigenvalues))
    error = identity_error(df, vec_col, model, k)
    turn = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])
    explained = model.eigenvalues[:k] / model.trace if k else np.zeros(0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    exact = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, "v", model.dim, model.scale, model.shift):
            n = len(x)
            deviation = pa.array([d if d < 10 ** 38 else None for d in _deviations(x, model)], exact)
            each = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, model.n, np.int64)), deviation.take(each),
                 pa.array((_centred(x, model) @ turn).ravel()), pa.array(np.tile(explained, n)),
                 pa.array(np.full(n * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "id long, component int, n long, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double").withColumnRenamed("id", id_col)


def whiten(df: DataFrame, id_col: str, vec_col: str, components: int = 8, scale: int = 1024,
           shift: int = 100_000) -> DataFrame:
    """``fit`` on all rows and ``transform`` of all rows; no rows if no
    vector takes part or if all are equal."""
    model = fit(df, vec_col, scale, shift)
    if model is None:
        one = np.zeros(1, np.int64)
        model = Whitening(1, 1, scale, shift, one, one, np.zeros((1, 0)), np.zeros(0), 0.0)
        df = df.limit(0)
    return transform(df, id_col, vec_col, model, components)
