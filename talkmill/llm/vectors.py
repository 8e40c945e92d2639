"""Helpers of the vector searches: matrices from Arrow lists, query batches
of a bounded size, and running per-query best lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.common import shared_path

#: Queries that are sent to the tasks at once: 8192 vectors of 64 doubles are 4 MB.
QUERY_BATCH = 8192
#: Rows of a score block: 512 queries against 2048 candidates are 8 MB.
QUERY_ROWS, CANDIDATE_ROWS = 512, 2048


def dimension(df: DataFrame, vec: str) -> int:
    """The commonest vector length (the smaller one of a tie); 0 if there
    are no vectors."""
    top = df.where(F.col(vec).isNotNull() & (F.size(vec) > 0)).groupBy(F.size(vec).alias("d")).count() \
        .orderBy(F.desc("count"), "d").limit(1).collect()
    return top[0]["d"] if top else 0


def matrix(batch: pa.RecordBatch, id_col: str, vec_col: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, double matrix) of the rows that take part: an id, and a vector
    of ``dim`` finite components."""
    ids, lists = batch.column(id_col), batch.column(vec_col)
    keep = np.asarray(ids.is_valid()) & np.asarray(lists.is_valid())
    sizes = np.asarray(lists.value_lengths().fill_null(-1))
    keep &= sizes == dim
    rows = lists.filter(pa.array(keep))
    values = rows.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    vectors = values.reshape(-1, dim) if dim else np.zeros((0, 0))
    good = np.isfinite(vectors).all(axis=1)
    return np.asarray(ids.filter(pa.array(keep)).cast(pa.int64()))[good], vectors[good]


def chunks(batches: Iterator[pa.RecordBatch], id_col: str, vec_col: str,
           dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATE_ROWS):
            ids, vectors = matrix(batch.slice(start, CANDIDATE_ROWS), id_col, vec_col, dim)
            if len(ids):
                yield ids, vectors


def by_query_batch(queries: DataFrame, id_col: str, vec_col: str, dim: int, columns: str, name: str,
                   search: Callable[[np.ndarray, np.ndarray], DataFrame]) -> DataFrame:
    """Run ``search(ids, vectors)`` for batches of about QUERY_BATCH queries,
    each against all candidates, and return the written results of all.
    Of queries that repeat an id the smallest vector counts."""
    spark = queries.sparkSession
    asked = queries.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & (F.size("v") == dim))
    n_batches = max(1, -(-asked.count() * 5 // (4 * QUERY_BATCH)))
    path = shared_path(spark, name)
    for b in range(n_batches):
        rows: dict[int, list] = {}
        for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(n_batches)) == b).toLocalIterator():
            v = [np.nan if x is None else x for x in r["v"]]
            if np.isfinite(v).all():
                rows[r["id"]] = min(v, rows.get(r["id"], v))
        ids = np.array(sorted(rows), np.int64)
        found = search(ids, np.array([rows[i] for i in ids], np.float64).reshape(len(ids), dim))
        found.write.parquet(f"{path}/batch={b}")
    return spark.read.schema(columns).option("recursiveFileLookup", "true").parquet(path)


class Best:
    """Running best (score, smaller id first) candidates of each query."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.q, self.s, self.v = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64))
        self.floor = np.full(n_queries, -np.inf)

    def add(self, q: np.ndarray, s: np.ndarray, v: np.ndarray) -> None:
        q, s, v = (np.concatenate(x) for x in ((self.q, q), (self.s, s), (self.v, v)))
        order = np.lexsort((v, -s, q))
        q, s, v = q[order], s[order], v[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.q, self.s, self.v = q[kept], s[kept], v[kept]
        last = rank[kept] == self.k - 1
        self.floor[self.q[last]] = self.s[last]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all tasks: query_id, rank, vec_id, score."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
