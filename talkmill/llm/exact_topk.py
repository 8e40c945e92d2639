"""Exact top-k search by distributed histogram selection.

Scores are integer inner products of vectors scaled to whole numbers. For a
batch of queries all candidates are scored and counted in 1024 score bins a
query; the summed histograms say in which bin each query's k-th score lies.
Bins that hold too many are cut into 1024 again (with another scoring pass)
until few candidates reach the bin or it is one score wide. Then one pass
keeps what reaches the bin, and ties go to the smaller id.

A task reports only its topmost bins down to its own k-th score (the global
k-th is never lower), so at most k rows a query leave a task, and at most k
candidates a query in the last pass, however many rows tie. Scores are
never gathered. Queries are sent to the tasks in batches of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.vectors import QUERY_ROWS, Best, by_query_batch, chunks, dimension, ranked

BINS_LOG2 = 10
BINS = 1 << BINS_LOG2
SLACK = 4


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str,
               scale: int = 1024) -> DataFrame:
    """The ``k`` highest integer inner products of floor(scale * x) vectors
    for every query: query_id, rank (from 1), vec_id, score long.

    Candidates with the query's own id take no part. Vectors that are null
    or hold null or non-finite components, vectors of another than the
    commonest length, and rows with a null id take no part. Rows that repeat
    an id are candidates each; of queries that repeat an id the smallest
    vector counts. Fewer than k candidates give all; an empty table gives no
    rows. Scores from 2**53 on raise an error, since sums of doubles would
    no longer be exact. Other columns are ignored."""
    dim = dimension(candidates, vec_col)
    candidates = candidates.select(F.col(id_col), F.col(vec_col))
    scaled = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    finite = F.forall(vec_col, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    largest = candidates.where(finite & (F.size(vec_col) == dim)).select(F.max(F.aggregate(
        scaled, F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0

    def search(ids: np.ndarray, vectors: np.ndarray) -> DataFrame:
        q = np.floor(vectors * scale)
        norms = np.sqrt((q * q).sum(axis=1) * largest) if dim else np.zeros(len(ids))
        if len(ids) and dim * norms.max() >= 2.0 ** 53:
            raise ValueError("scaled inner products would pass 2**53")
        bits = int(np.ceil(np.log2(max(norms.max(initial=0) + 2, 2)))) + 1  # scores are in +-2**(bits-1)
        low = np.full(len(ids), -(2.0 ** (bits - 1)))  # lowest score of the bin that is being cut
        above = np.zeros(len(ids), np.int64)  # candidates above that bin
        floor, open_, width = low.copy(), np.arange(len(ids)), 2.0 ** max(0, bits - BINS_LOG2)
        while len(open_):
            cuts = _bins(candidates, id_col, vec_col, dim, scale, ids[open_], q[open_], low[open_],
                         width, k - above[open_])
            still = []
            for at, i in enumerate(open_):
                if at not in cuts:  # fewer than k candidates in all: everything is wanted
                    continue
                b, upto, n = cuts[at]
                low[i] += b * width
                above[i] += upto - n
                floor[i] = low[i]
                if width > 1 and above[i] + n > SLACK * k:
                    still.append(i)
            open_, width = np.array(still, np.int64), max(1.0, width / BINS)
        return _reaching(candidates, id_col, vec_col, dim, scale, ids, q, floor, k)

    return by_query_batch(queries, id_col, vec_col, dim,
                          "query_id long, rank int, vec_id long, score long", "topk", search)


def _scores(batches: Iterator[pa.RecordBatch], id_col: str, vec_col: str, dim: int, scale: int,
            ids: np.ndarray, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first query, candidate ids, scores) of every block; -inf is the
    query itself."""
    for own, vectors in chunks(batches, id_col, vec_col, dim):
        c = np.floor(vectors * scale)
        for start in range(0, len(ids), QUERY_ROWS):
            s = q[start:start + QUERY_ROWS] @ c.T
            s[ids[start:start + QUERY_ROWS, None] == own[None, :]] = -np.inf
            yield start, own, s


def _bins(candidates: DataFrame, id_col: str, vec_col: str, dim: int, scale: int, ids: np.ndarray,
          q: np.ndarray, low: np.ndarray, width: float, wanted: np.ndarray) -> dict:
    """For each query the bin that holds its wanted-th score: {query: (bin,
    candidates in and above it, candidates in it)}."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((len(ids), BINS), np.int32)
        for start, _, s in _scores(batches, id_col, vec_col, dim, scale, ids, q):
            n = len(s)
            b = np.floor((s - low[start:start + n, None]) / width)
            row, col = np.nonzero((b >= 0) & (b < BINS))
            flat = row * BINS + b[row, col].astype(np.int64)
            hist[start:start + n] += np.bincount(flat, minlength=n * BINS).reshape(n, BINS).astype(np.int32)
        for start in range(0, len(ids), QUERY_ROWS):  # from the top down to the task's own wanted-th score
            h = hist[start:start + QUERY_ROWS]
            higher = h[:, ::-1].cumsum(axis=1)[:, ::-1] - h
            row, col = np.nonzero((h > 0) & (higher < wanted[start:start + QUERY_ROWS, None]))
            yield pa.RecordBatch.from_arrays(
                [pa.array((row + start).astype(np.int32)), pa.array(col.astype(np.int32)),
                 pa.array(wanted[row + start]), pa.array(h[row, col].astype(np.int64))],
                names=["q", "b", "wanted", "n"])

    order = Window.partitionBy("q").orderBy(F.desc("b"))
    summed = candidates.mapInArrow(count, "q int, b int, wanted long, n long") \
        .groupBy("q", "b", "wanted").agg(F.sum("n").alias("n"))
    cut = summed.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") >= F.col("wanted")) \
        .groupBy("q").agg(F.max(F.struct("b", "upto", "n")).alias("x"))
    return {r["q"]: tuple(r["x"]) for r in cut.collect()}  # one row a query of the batch


def _reaching(candidates: DataFrame, id_col: str, vec_col: str, dim: int, scale: int, ids: np.ndarray,
              q: np.ndarray, floor: np.ndarray, k: int) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        for start, own, s in _scores(batches, id_col, vec_col, dim, scale, ids, q):
            least = np.maximum(floor[start:start + len(s)], best.floor[start:start + len(s)])
            row, col = np.nonzero(s >= least[:, None])
            if len(row):
                best.add(row + start, s[row, col], own[col])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[best.q]), pa.array(best.v), pa.array(best.s.astype(np.int64))],
            names=["query_id", "vec_id", "score"])

    return ranked(candidates.mapInArrow(keep, "query_id long, vec_id long, score long"), k)
