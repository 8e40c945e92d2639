"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of token ids, its documents in table order. The
output is one stream of tokens, cut into sequences of ``length`` and into
windows of ``window`` tokens. A window is one round: each queue that still
has tokens is given its quantum (share times window) plus the deficit that
earlier rounds left it, in whole tokens. After n tokens' worth of rounds a
queue has thus been given floor(n * share) tokens: its deficit stays below
one token, and what a window takes from a queue follows from the window's
number alone. Tasks need no state from each other, and deficits carry across
windows and partitions alike. When a queue runs dry, the next mixture starts
with the remaining ones. With more than ``MAX_QUEUES`` sources, the smallest
ones, packed whole like all others, lie one after another in one shared queue,
and the share that every window meets is that of the shared queue.

Steps: (1) tokenise once into a written table, each row with its place in
its queue within the task's block; (2) sum the blocks (a narrow table) for
the offsets of blocks and the totals of queues; (3) cut every document at
window, sequence and mixture borders from its place in the queue alone. No
window function runs over documents, and ids are not shuffled unless the
block table outgrows Spark's own broadcast threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.common import sliced, written
from talkmill.llm.subwords import BytePairEncoder

SEQUENCE = 1024
#: Tokens of a window in which the shares are met: 64 sequences.
WINDOW = 64 * SEQUENCE
#: Queues whose totals pass through the driver; sources beyond the largest
#: ones share the last queue.
MAX_QUEUES = 10_000
#: The shared queue; the others are "" or start with "=".
SHARED = "*"


def tokenised(docs: DataFrame, id_col: str, text_col: str, queue_col: str | None, tokenizer: str,
              end_id: int | None) -> DataFrame:
    """Written table: doc_id, queue, block, place (of the document's first
    id among its queue's ids in the block), n, ids (32-bit little-endian).
    A null source is a queue of its own."""
    queue = F.lit("") if queue_col is None else F.when(F.col(queue_col).isNull(), F.lit("")) \
        .otherwise(F.concat(F.lit("="), F.col(queue_col).cast("string")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), queue.alias("queue"))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder.of(tokenizer)
        block = TaskContext.get().partitionId()
        given: dict[str, int] = {}
        for part, _, _ in sliced(batches):
            ids = [encoder.encode(t or "").astype("<u4").tobytes() + tail for t in part.column("text").to_pylist()]
            queues = part.column("queue").to_pylist()
            places = []
            for q, x in zip(queues, ids):
                at = given.get(q, 0)
                places.append(at)
                given[q] = at + len(x) // 4
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("queue").cast(pa.string()),
                 pa.array([block] * len(ids), pa.int32()),
                 pa.array(places, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "queue", "block", "place", "n", "ids"])

    return written(rows.mapInArrow(
        run, "doc_id long, queue string, block int, place long, n long, ids binary"), "packing-ids")


class Mixture:
    """A stretch of the stream in which a fixed set of queues is served.
    After ``n`` tokens' worth of rounds a queue has been given floor(n *
    share) tokens."""

    def __init__(self, start: int, length: int, weights: dict[str, int], taken: dict[str, int], window: int) -> None:
        self.start, self.length, self.window = start, length, window
        self.weights, self.total = weights, sum(weights.values())
        self.index = {q: i for i, q in enumerate(weights)}
        self.first = {q: taken.get(q, 0) for q in weights}
        self._rounds: dict[int, tuple[int, list[int], list[int]]] = {}

    def taken(self, q: str, n: int) -> int:
        return n * self.weights[q] // self.total

    def _round(self, w: int) -> tuple[int, list[int], list[int]]:
        """Of window ``w``: its first place, and by queue the place within
        it and the tokens that the queue was given before."""
        if w not in self._rounds:
            if len(self._rounds) * len(self.weights) > 1 << 20:
                self._rounds.clear()
            a, z = w * self.window, min((w + 1) * self.window, self.length)
            before = [a * x // self.total for x in self.weights.values()]
            places = [0]
            for x, n in zip(self.weights.values(), before):
                places.append(places[-1] + z * x // self.total - n)
            self._rounds[w] = (self.start + sum(before), places, before)
        return self._rounds[w]

    def runs(self, q: str, at: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(queue place, stream place, length) of the queue's tokens from
        ``at`` to ``stop`` that this mixture serves."""
        if q not in self.index:
            return
        i, base = self.index[q], self.first[q]
        at, end = max(at, base), min(stop, base + self.taken(q, self.length))
        while at < end:
            w = (at - base) * self.total // (self.weights[q] * self.window)
            while self.taken(q, min((w + 1) * self.window, self.length)) <= at - base:
                w += 1
            place, places, before = self._round(w)
            offset = at - base - before[i]
            n = min(end - at, places[i + 1] - places[i] - offset)
            yield at, place + places[i] + offset, n
            at += n


def mixtures(totals: dict[str, int], shares: dict[str, float] | None, window: int) -> list[Mixture]:
    """The mixtures of the stream. ``shares``: wanted proportions (queues
    that it does not name get their share of all tokens); None: every
    queue's share of all tokens, so that all run dry together. Each mixture
    lasts until one of its queues is dry."""
    left = {q: n for q, n in sorted(totals.items()) if n > 0}
    all_ = sum(left.values())
    exact = {q: Fraction(n, all_) if shares is None or q not in shares
             else Fraction(shares[q]).limit_denominator(10 ** 6) for q, n in left.items()}
    out, start, taken = [], 0, {}
    while left:
        served = [q for q in left if exact[q] > 0] or list(left)
        parts = {q: exact[q] or Fraction(left[q], all_) for q in served}
        common = lcm(*(p.denominator for p in parts.values()))
        weights = {q: int(p * common) for q, p in parts.items()}
        total = sum(weights.values())
        length = min(-(-left[q] * total // w) for q, w in weights.items())
        mixture = Mixture(start, length, weights, taken, window)
        out.append(mixture)
        for q in served:
            n = mixture.taken(q, length)
            taken[q] = taken.get(q, 0) + n
            start += n
            left[q] -= n
            if not left[q]:
                del left[q]
    return out


def _lanes(blocks: DataFrame, named: set[str]) -> DataFrame:
    """``blocks`` with the queue that each source is served from: its own,
    or the shared one for the smallest sources beyond MAX_QUEUES."""
    totals = blocks.groupBy("queue").agg(F.sum("n").alias("n"))
    largest = [r["queue"] for r in totals.orderBy(F.desc("n"), "queue").limit(MAX_QUEUES + 1).collect()]
    if len(largest) <= MAX_QUEUES:
        return blocks.withColumn("lane", F.col("queue"))
    own = sorted(named | set(largest[:MAX_QUEUES - 1]))
    kept = blocks.sparkSession.createDataFrame([(q,) for q in own], "queue string").withColumn("own", F.lit(True))
    return written(blocks.join(F.broadcast(kept), "queue", "left").select(
        "queue", "block", "n", F.when(F.col("own"), F.col("queue")).otherwise(F.lit(SHARED)).alias("lane")),
        "packing-lanes")


def _offsets(lanes: DataFrame) -> DataFrame:
    """Place of a block's first id of a source in the source's lane: behind
    the lane's earlier blocks and the block's earlier sources of the lane.
    No window holds more than a lane's blocks or a block's sources."""
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_block = lanes.groupBy("lane", "block").agg(F.sum("n").alias("n")).select(
        "lane", "block", upto(Window.partitionBy("lane").orderBy("block")).alias("behind"))
    inner = lanes.select("queue", "block", "lane",
                         upto(Window.partitionBy("lane", "block").orderBy("queue")).alias("within"))
    return inner.join(by_block, ["lane", "block"]).select(
        "queue", "block", "lane", (F.col("behind") + F.col("within")).alias("base"))


def pack(docs: DataFrame, id_col: str, text_col: str, queue_col: str | None, tokenizer: str,
         end_id: int | None = 0, shares: dict[str, float] | None = None, length: int = SEQUENCE,
         window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of ``length`` tokens: one row per
    piece with doc_id, source, start (the document's ids before the piece),
    length, ids_crc32 (of the piece's ids as little-endian 32-bit numbers),
    doc_tokens, sequence_id, offset, and with ``with_ids`` the ids.

    Sources named in ``shares`` always have queues of their own. Only the
    last sequence can be short. A null text is empty and still has
    its end id; without an end id empty documents give no piece. A null
    source is a queue of its own; repeated rows are packed each; null ids
    are kept. An empty table gives no rows. Other columns are ignored."""
    ids = tokenised(docs, id_col, text_col, queue_col, tokenizer, end_id)
    blocks = written(ids.groupBy("queue", "block").agg(F.sum("n").alias("n")), "packing-blocks")
    wanted = None if shares is None else {f"={q}": s for q, s in shares.items()}
    lanes = _lanes(blocks, set(wanted or ()))
    totals = {r["lane"]: r["n"] for r in lanes.groupBy("lane").agg(F.sum("n").alias("n")).collect()}
    plan = mixtures(totals, wanted, window)
    offsets = written(_offsets(lanes), "packing-offsets")
    placed = ids.join(offsets, on=["queue", "block"], how="inner").select(
        "doc_id", "queue", "lane", (F.col("base") + F.col("place")).alias("place"), "n", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in sliced(iter([batch]), "ids"):
                yield pieces(part)

    def pieces(part: pa.RecordBatch) -> pa.RecordBatch:
        names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        out: list[list] = [[] for _ in range(len(names) + with_ids)]
        for doc, q, lane, place, n, data in zip(*(part.column(c).to_pylist() for c in (
                "doc_id", "queue", "lane", "place", "n", "ids"))):
            source = q[1:] if q else None
            for mixture in plan:
                for at, to, count in mixture.runs(lane, place, place + n):
                    while count:
                        m = min(count, length - to % length)
                        own = data[4 * (at - place):4 * (at - place + m)]
                        row = (doc, source, at - place, m, zlib.crc32(own), n, to // length, to % length)
                        for values, x in zip(out, row + (own,) * with_ids):
                            values.append(x)
                        at, to, count = at + m, to + m, count - m
        kinds = [pa.int64(), pa.string()] + [pa.int64()] * 6 + [pa.binary()] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                          names=names + ["ids"] * with_ids)

    return placed.mapInArrow(
        cut, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long" + (", ids binary" if with_ids else ""))
