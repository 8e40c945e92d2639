"""Approximate nearest neighbours by randomly rotated one-bit codes.

The index holds for every vector v = c + r (c the mean of all vectors) the
signs of the rotated unit residual packed into bits, |r|, and the inner
product f of the unit residual with its code; the code divided by f is an
unbiased estimate of the residual's direction, and the estimate of <q, v>
is off by at most eps * |q| |r| sqrt(1 - f^2) / (f sqrt(D - 1)) with high
probability. A search estimates every inner product from the packed bits
and reranks with the original vectors only the candidates whose upper bound
reaches the k-th best exact product found so far in the task.

Every row is indexed; nothing is sampled. The tasks send at most k rows a
query. Queries are sent to the tasks in batches of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import written
from talkmill.llm.vectors import QUERY_ROWS, Best, by_query_batch, chunks, dimension, ranked

EPSILON = 3.0
SEED = 11
PAIRS_AT_ONCE = 1 << 16


class Index:
    """A written index table with its centre and rotation."""

    def __init__(self, table: DataFrame, dim: int, centre: np.ndarray, rotation: np.ndarray) -> None:
        self.table, self.dim, self.centre, self.rotation = table, dim, centre, rotation


def rotation_matrix(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def mean_vector(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> np.ndarray:
    """Mean of the vectors that take part; one row of sums leaves a task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for ids, x in chunks(batches, id_col, vec_col, dim):
            total, n = total + x.sum(axis=0), n + len(ids)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total),
                                          pa.array(np.full(dim, n, np.int64))], names=["i", "s", "n"])

    rows = vectors.select(id_col, vec_col).mapInArrow(sums, "i int, s double, n long") \
        .groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    centre = np.zeros(dim)
    for r in rows:
        centre[r["i"]] = r["s"] / r["n"] if r["n"] else 0.0
    return centre


def build_index(vectors: DataFrame, id_col: str, vec_col: str, seed: int = SEED) -> Index:
    """Codes and correction scalars of every vector that takes part (not
    null, zero, or holding null or non-finite components, of the commonest
    length, with an id)."""
    dim = dimension(vectors, vec_col)
    centre = mean_vector(vectors, id_col, vec_col, dim)
    rotation = rotation_matrix(dim, seed) if dim else np.zeros((0, 0))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches, id_col, vec_col, dim):
            some = x.any(axis=1)
            ids, x = ids[some], x[some]
            residual = (x - centre) @ rotation
            norm = np.linalg.norm(residual, axis=1)
            unit = residual / np.where(norm > 0, norm, 1)[:, None]
            factor = np.abs(unit).sum(axis=1) / np.sqrt(dim)
            codes = np.packbits(unit > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(list(x), pa.list_(pa.float64())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(factor)],
                names=["id", "vector", "code", "norm", "factor"])

    table = vectors.select(id_col, vec_col).mapInArrow(
        encode, "id long, vector array<double>, code binary, norm double, factor double")
    return Index(written(table, "rabitq"), dim, centre, rotation)


def search(index: Index, queries: DataFrame, k: int, id_col: str, vec_col: str,
           epsilon: float = EPSILON) -> DataFrame:
    """The ``k`` nearest found by inner product for every query: query_id,
    rank (from 1), vec_id, score double (exact on the original vectors).

    Candidates with the query's own id take no part, nor do queries that
    would not be indexed. Rows that repeat an id are candidates each; of
    queries that repeat an id the smallest vector counts. Fewer than k
    candidates give all; an empty table gives no rows. Ties go to the
    smaller id. Other columns are ignored."""
    dim, centre, rotation = index.dim, index.centre, index.rotation

    def one(ids: np.ndarray, vectors: np.ndarray) -> DataFrame:
        some = vectors.any(axis=1)
        ids, vectors = ids[some], vectors[some]
        rotated, base = vectors @ rotation, vectors @ centre
        # each query by a power of two, so single precision holds any of them
        unit = np.exp2(np.ceil(np.log2(np.maximum(np.abs(rotated).max(axis=1, initial=0), 1e-300))))
        rotated = (rotated / unit[:, None]).astype(np.float32)
        length = np.linalg.norm(vectors, axis=1)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(len(ids), k)
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    block(batch.slice(at, 2048), best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[best.q]), pa.array(best.v), pa.array(best.s)],
                names=["query_id", "vec_id", "score"])

        def block(part: pa.RecordBatch, best: Best) -> None:
            own = np.asarray(part.column("id"))
            exact = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            packed = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(own), -1)
            signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
            norm, factor = (np.asarray(part.column(c)) for c in ("norm", "factor"))
            safe = np.where(factor > 0, factor, 1)
            scale = norm / (safe * np.sqrt(dim))
            spread = epsilon * norm * np.sqrt(np.maximum(0, 1 - factor ** 2)) / (safe * np.sqrt(max(dim - 1, 1)))
            for start in range(0, len(ids), QUERY_ROWS):
                rows = slice(start, start + QUERY_ROWS)
                estimate = (rotated[rows] @ signs.T) * unit[rows, None] * scale[None, :] + base[rows, None]
                # rounding of single-precision sums counts as error too
                error = length[rows, None] * (spread + 1e-5 * norm)[None, :]
                estimate[ids[rows, None] == own[None, :]] = -np.inf
                if np.isneginf(best.floor[rows]).any() and len(own) > k:
                    # a first floor: the exact products of the best estimates
                    top = np.argpartition(-estimate, k, axis=1)[:, :k]
                    q, c = np.repeat(np.arange(len(top)), top.shape[1]), top.ravel()
                    floors = np.sort(np.where(np.isfinite(estimate[q, c]), _dots(vectors[rows], exact, q, c), -np.inf)
                                     .reshape(len(top), -1), axis=1)[:, 0]
                else:
                    floors = np.full(len(estimate), -np.inf)
                floors = np.maximum(floors, best.floor[rows])
                q, c = np.nonzero((estimate + error >= floors[:, None]) & np.isfinite(estimate))
                if len(q):
                    s = _dots(vectors[rows], exact, q, c)
                    reach = s >= floors[q]
                    best.add(q[reach] + start, s[reach], own[c[reach]])

        found = index.table.mapInArrow(scan, "query_id long, vec_id long, score double")
        return ranked(found, k)

    return by_query_batch(queries, id_col, vec_col, dim,
                          "query_id long, rank int, vec_id long, score double", "neighbours", one)


def _dots(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products in double precision of the pairs (q, c)."""
    out = np.empty(len(q))
    for at in range(0, len(q), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        out[part] = np.einsum("ij,ij->i", queries[q[part]], vectors[c[part]])
    return out
