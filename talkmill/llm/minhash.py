"""Near-duplicate documents by MinHash, with exact confirmation.

1. One pass over the texts gives each document the distinct 5-word shingles
   (64-bit hashes), ``BANDS * ROWS`` universal hash minima over them, a key
   for each band of minima, and a 128-bit hash of the whole set. Only the
   band keys and the set hash are written.
2. Documents with equal sets are one class; only its smallest document goes
   on, so a group of copies costs one document from here.
3. Documents that share a band key are a bucket. In every bucket all members
   are compared with its smallest member (the hub): a comparison first checks
   the signatures and then the full sets. A hub that has been compared with
   all members leaves the bucket, and buckets whose members are already
   connected are finished.
4. What is left of a bucket is compared within a task, in one pass over all
   buckets, skipping members that are already connected and pairs that an
   earlier band brings together. A bucket of more than ``BUCKET_ROWS`` members
   or ``BUCKET_SHINGLES`` shingles is cut into blocks, and each pair of blocks
   is a task; blocks that lie wholly in the bucket's largest group do not meet
   each other. So no pair of a bucket is lost and no group is written out in
   pairs.
5. Components of the confirmed links, by alternating large-star and
   small-star.

With 24 bands of 5 rows a pair of similarity 0.85 meets in no bucket with
probability 8e-7, one of 0.8 with 8e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import among, mix64, release_memory, sliced, text_bytes, word_hashes, written
from talkmill.llm.components import connected_components

WORDS = 5
BANDS = 24
ROWS = 5
#: Signatures may fall this far below the threshold (7 standard errors)
#: before the full sets are no longer compared.
SLACK = 0.25
#: Members and shingles of a block, of which a task compares two at most.
BUCKET_ROWS = 2000
BUCKET_SHINGLES = 1 << 21
#: Members of a small task, and bits of the sets of a large one in memory.
_FEW = 64
_BITS_AT_ONCE = 1 << 28
_SHINGLES_AT_ONCE = 1 << 16

_RNG = np.random.default_rng(7)
_A = (_RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_PLACE = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(16)], np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the texts of a block and their
    offsets. A text of fewer than five words has its whole sequence as its
    only shingle, one without words none."""
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    size = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(size)])
    h = np.zeros(out_at[-1], np.uint64)
    if len(words) >= WORDS:
        full = np.zeros(len(words) - WORDS + 1, np.uint64)
        for k in range(WORDS):
            full += words[k:len(full) + k] * _PLACE[k]
        text = np.repeat(np.arange(len(counts)), np.where(counts >= WORDS, size, 0))
        start = at[:-1][text] + (np.arange(len(text)) - np.searchsorted(text, text))
        h[np.repeat(counts >= WORDS, size)] = full[start]
    for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
        own = words[at[i]:at[i + 1]]
        h[out_at[i]] = np.sum(np.append(own * _PLACE[:len(own)], _PLACE[8 + len(own)]))
    h = mix64(h)
    for a, b in zip(out_at[:-1].tolist(), out_at[1:].tolist()):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[out_at[:-1][size > 0]] = True
    return h[keep], np.concatenate([[0], np.cumsum(keep)])[out_at]


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) hash minima; zeros for texts without shingles."""
    out = np.zeros((len(at) - 1, BANDS * ROWS), np.uint32)
    low = (h ^ (h >> np.uint64(32))).astype(np.uint32)
    some = np.flatnonzero(np.diff(at))
    start = 0
    while start < len(some):
        stop = max(start + 1, int(np.searchsorted(at[some], at[some[start]] + _SHINGLES_AT_ONCE)))
        rows = some[start:stop]
        x = low[at[rows[0]]:at[rows[-1] + 1]]
        first = at[rows] - at[rows[0]]
        v = np.empty_like(x)
        for j in range(BANDS * ROWS):
            np.multiply(x, _A[j], out=v)
            np.add(v, _B[j], out=v)
            out[rows, j] = np.minimum.reduceat(v, first)
        start = stop
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    bands = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    return mix64((bands * _PLACE[:ROWS]).sum(axis=2) + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACE[9])


def _set_hashes(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (_PLACE[10], _PLACE[11]):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h ^ salt))])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in sliced(batches):
        h, at = shingles(data, offsets)
        keys = band_keys(signatures(h, at)).view(np.int64)
        s1, s2 = _set_hashes(h, at)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc").cast(pa.int64()), pa.array(np.diff(at)), pa.array(s1), pa.array(s2), lists],
            names=["doc", "n", "s1", "s2", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in sliced(batches):
        h, at = shingles(data, offsets)
        minima = signatures(h, at)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc").cast(pa.int64()), pa.array(np.diff(at)),
             pa.array([m.tobytes() for m in minima], pa.binary()),
             pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
            names=["doc", "n", "minima", "shingles"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b| for sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose signatures and full sets agree."""
    least = (percent / 100 - SLACK) * BANDS * ROWS
    left = sets.select(F.col("doc").alias("u"), F.col("minima").alias("mu"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc").alias("v"), F.col("minima").alias("mv"), F.col("shingles").alias("sv"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for mu, mv, su, sv in zip(*(batch.column(c) for c in ("mu", "mv", "su", "sv"))):
                same = np.count_nonzero(np.frombuffer(mu.as_buffer(), np.uint32)
                                        == np.frombuffer(mv.as_buffer(), np.uint32))
                good.append(bool(same >= least and linked(
                    np.frombuffer(su.as_buffer(), np.uint64), np.frombuffer(sv.as_buffer(), np.uint64), percent)))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))
        release_memory()

    return pairs.join(left, "u").join(right, "v").select("u", "v", "mu", "mv", "su", "sv") \
        .mapInArrow(check, "u long, v long")


def _tasks(rest: DataFrame, bucket_rows: int, bucket_shingles: int) -> DataFrame:
    """(key, a, b, side, doc, group, n, small): the members of open buckets in
    the tasks that compare them, given (key, doc, group, n). Task (a, b) of a
    bucket compares its block a with its block b (side 0 and 1), or a block
    with itself. The largest group of a bucket has blocks of its own where it
    fills more than one; two of them never meet."""

    def blocks(rows: str, shingles: str) -> Column:
        by_size = F.least(F.col(rows), F.ceil(F.col(shingles) / bucket_shingles))
        return F.greatest(F.ceil(F.col(rows) / bucket_rows), by_size)

    groups = rest.groupBy("key", "group").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    buckets = groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("c").alias("c"), F.sum("n").alias("n"),
        F.max(F.struct("c", "n", "group")).alias("main")).where("groups > 1")
    small = (F.col("c") <= F.least(F.lit(_FEW), F.lit(bucket_rows))) & (F.col("n") <= bucket_shingles // _FEW)
    parted = blocks("main.c", "main.n") > 1
    buckets = buckets.select(
        "key", small.alias("small"), F.when(parted, F.col("main.group")).alias("main"),
        F.when(parted, blocks("main.c", "main.n")).otherwise(0).alias("n_main"),
        F.when(parted, F.col("c") - F.col("main.c")).otherwise(F.col("c")).alias("c"),
        F.when(parted, F.col("n") - F.col("main.n")).otherwise(F.col("n")).alias("n"))
    buckets = buckets.select("key", "small", "main", "n_main", blocks("c", "n").alias("n_rest"))
    in_main = F.coalesce(F.col("group") == F.col("main"), F.lit(False))
    hashed = F.xxhash64("doc")
    block = F.when(in_main, F.col("n_rest") + F.pmod(hashed, "n_main")).otherwise(F.pmod(hashed, "n_rest"))
    last = F.when(in_main, F.col("n_rest")).otherwise(F.col("n_rest") + F.col("n_main")) - 1
    placed = rest.join(buckets, "key").select(
        "key", "doc", "group", "n", "small", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
    return placed.select("key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
                         (F.col("block") > F.col("other")).cast("int").alias("side"), "doc", "group", "n", "small")


class _Sets:
    """The sets of a task's members, to count what some of them share with
    one of them."""

    def __init__(self, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) + np.repeat(begin - np.cumsum(size) + size, size)
        flat, times = np.unique(hashes[at], return_inverse=True, return_counts=True)[1:]
        shared = times > 1  # what only one has, no two share
        width = max(1, -(-int(shared.sum()) // 64)) * 64
        self.size, self.begin, self.bits = size, np.cumsum(size) - size, None
        if len(size) * width <= _BITS_AT_ONCE:
            place, some = np.cumsum(shared) - 1, shared[flat]
            row, column = row[some], place[flat[some]]
            self.bits = np.empty((len(size), width // 64), np.uint64)
            for start in range(0, len(size), 256):
                a, b = np.searchsorted(row, [start, start + 256])
                dense = np.zeros((len(self.bits[start:start + 256]), width), bool)
                dense[row[a:b] - start, column[a:b]] = True
                self.bits[start:start + 256] = np.packbits(dense, axis=1).view(np.uint64)
        else:
            self.flat, self.mine = flat.astype(np.int32), np.zeros(len(times), bool)

    def shared_with(self, i: int, others: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            return np.bitwise_count(self.bits[others] & self.bits[i]).sum(axis=1, dtype=np.int64)
        own, size = self.flat[self.begin[i]:self.begin[i] + self.size[i]], self.size[others]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.begin[others] - ends + size, size)
        self.mine[own] = True
        both = np.add.reduceat(self.mine[self.flat[at]], ends - size, dtype=np.int64)
        self.mine[own] = False
        return both


def _links_of_tasks(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of each task that are not yet connected; a pair
    that shares an earlier band is left to that band's bucket."""
    least = (percent / 100 - SLACK) * BANDS * ROWS
    key, a, b, side, doc, group = (table.column(c).to_numpy() for c in ("key", "a", "b", "side", "doc", "group"))
    order = np.lexsort((doc, side, b, a, key))
    key, a, b, side, doc, group = (x[order] for x in (key, a, b, side, doc, group))
    minima = text_bytes(table.column("minima"))[0].view(np.uint32).reshape(-1, BANDS * ROWS)[order]
    bands = band_keys(minima).view(np.int64)
    data, at = text_bytes(table.column("shingles"))
    hashes, begin, size = data.view(np.uint64), at[:-1][order] // 8, np.diff(at)[order] // 8
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    cuts, found = np.append(np.flatnonzero(new), len(key)), []

    def few(lo: int, hi: int, earlier: np.ndarray) -> None:
        x, y = (lo + i for i in np.triu_indices(hi - lo, 1))
        open_ = (group[x] != group[y]) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
        if a[lo] != b[lo]:
            open_ &= side[x] != side[y]
        x, y = x[open_], y[open_]
        alone = ~(earlier[x - lo] == earlier[y - lo]).any(axis=1)
        x, y = x[alone], y[alone]
        near = (minima[x] == minima[y]).sum(axis=1) >= least
        for i, j in zip(x[near].tolist(), y[near].tolist()):
            if group[i] != group[j] and linked(
                    hashes[begin[i]:begin[i] + size[i]], hashes[begin[j]:begin[j] + size[j]], percent):
                join(lo, hi, i, j)

    def many(lo: int, hi: int, earlier: np.ndarray) -> None:
        ranks = np.empty(earlier.shape[::-1], np.uint32)
        for band, row in enumerate(ranks):
            row[:] = np.unique(earlier[:, band], return_inverse=True)[1]
        sets = _Sets(hashes, begin[lo:hi], size[lo:hi])
        first = lo + int((side[lo:hi] == 0).sum())
        for i in range(lo, first):
            start = first if a[lo] != b[lo] else i + 1
            open_ = (group[start:hi] != group[i]) & ~(ranks[:, start - lo:] == ranks[:, i - lo, None]).any(axis=0)
            near = np.flatnonzero(open_) + start
            near = near[100 * np.minimum(size[near], size[i]) >= percent * np.maximum(size[near], size[i])]
            near = near[(minima[near] == minima[i]).sum(axis=1) >= least]
            if len(near):
                both = sets.shared_with(i - lo, near - lo)
                for j in near[100 * both >= percent * (size[i] + size[near] - both)]:
                    if group[j] != group[i]:
                        join(lo, hi, i, j)

    def join(lo: int, hi: int, i: int, j: int) -> None:
        found.append((doc[i], doc[j]))
        here = group[lo:hi]
        here[here == group[j]] = group[i]

    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        band = np.flatnonzero((bands[lo:hi] == key[lo]).any(axis=0))
        (few if hi - lo <= _FEW else many)(lo, hi, bands[lo:hi, :band[0] if len(band) else 0])
    u, v = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"u": u, "v": v})


def _within_buckets(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of the tasks that are not yet connected. Small
    tasks go to Python some at once, the others one by one."""
    rows, shingles = tasks.where("small").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bins = 1 + max(rows // BUCKET_ROWS, shingles // BUCKET_SHINGLES)
    at_once = F.when(F.col("small"), F.pmod(F.xxhash64("key"), F.lit(bins))).otherwise(F.xxhash64("key", "a", "b"))

    def solve(table: pa.Table) -> pa.Table:
        found = _links_of_tasks(table, percent)
        del table
        release_memory()  # the worker may wait idle beside those of later stages
        return found

    return tasks.withColumn("at_once", at_once).drop("small", "n").join(sets.drop("n"), "doc") \
        .groupBy("at_once").applyInArrow(solve, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, percent: int = 80,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Documents are linked if their sets of distinct 5-word shingles (words
    are runs of non-space bytes, A-Z lower-cased) have a Jaccard similarity
    of at least ``percent`` / 100. component_id is the smallest id reachable
    over links; kept says whether it is the row's own. A null, empty or
    blank text has no shingles and is linked with nothing. Rows that repeat
    an id are one document to the links; rows with a null id are linked with
    nothing, their component_id is null and they are kept. An empty table
    gives no rows. Other columns are ignored."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    described = written(texts.mapInArrow(
        _describe, "doc long, n long, s1 long, s2 long, bands array<long>"), "minhash")
    real = described.where((F.col("n") > 0) & F.col("doc").isNotNull())
    same = ["n", "s1", "s2"]
    classes = written(real.groupBy(*same).agg(F.min("doc").alias("doc")), "minhash-classes")

    leaders = real.join(classes, [*same, "doc"], "left_semi").select(
        "doc", F.explode(F.array_distinct("bands")).alias("key")).distinct()
    leaders = written(leaders, "minhash-bands")
    shared = leaders.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    members = written(leaders.join(shared, "key"), "minhash-members")
    wanted = written(members.select("doc").distinct(), "minhash-wanted")
    sets = written(among(texts, wanted, "doc").mapInArrow(
        _full_sets, "doc long, n long, minima binary, shingles binary").where("n > 0")
        .dropDuplicates(["doc", "shingles"]), "minhash-sets")
    links = _empty(docs, "u long, v long")
    group = members.select("doc", F.col("doc").alias("group")).distinct().limit(0)

    def grouped(m: DataFrame) -> DataFrame:
        return m.join(group, "doc", "left").select(
            "key", "doc", F.coalesce("group", "doc").alias("group"))

    if not members.isEmpty():
        hubs = members.groupBy("key").agg(F.min("doc").alias("hub"))
        for first in (True, False):  # the smallest hub of each document first, then the others where need be
            of_hub = group.select(F.col("doc").alias("hub"), F.col("group").alias("hub_group"))
            pairs = grouped(members).join(hubs, "key").where(F.col("doc") != F.col("hub")) \
                .select("doc", "group", "hub").distinct().join(of_hub, "hub", "left") \
                .where(F.col("group") != F.coalesce("hub_group", "hub"))
            pairs = pairs.groupBy("doc").agg(F.min("hub").alias("hub")) if first else pairs.select("doc", "hub")
            pairs = written(pairs.select(F.col("hub").alias("u"), F.col("doc").alias("v")), "minhash-pairs")
            if not pairs.isEmpty():
                links, group = _merge(links, _confirmed(pairs, sets, percent))
        rest = members.join(hubs, (members["key"] == hubs["key"]) & (members["doc"] == hubs["hub"]), "left_anti")
        sizes = sets.groupBy("doc").agg(F.sum("n").alias("n"))
        rest = written(grouped(rest).join(sizes, "doc"), "minhash-rest")
        tasks = written(_tasks(rest, bucket_rows, BUCKET_SHINGLES), "minhash-tasks")
        if not tasks.isEmpty():
            links, group = _merge(links, _within_buckets(tasks, sets, percent))

    ends = group.select("doc", F.col("group").alias("component"))
    known = classes.join(ends, "doc", "left").select(*same, F.coalesce("component", "doc").alias("component"))
    out = described.join(known, same, "left")
    component = F.when(F.col("doc").isNull(), F.col("doc")).otherwise(F.coalesce("component", "doc"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def _merge(links: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far and the group of every document on one."""
    links = written(links.union(found), "minhash-links")
    nodes = connected_components(links)
    return links, written(nodes.select(F.col("node").alias("doc"), F.col("component").alias("group")), "minhash-groups")
