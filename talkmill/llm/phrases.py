"""Phrase mining on a weighted de Bruijn graph of words.

An edge is a phrase of the longest kind (m words); it joins the node of its
first m - 1 words to the node of its last m - 1 words, which overlap in all
but one. Every word of a piece starts one edge; near the piece's end the
missing words are filled with an end mark, and these short edges are the
piece-end corrections.

1. Blocks of text are cut into words with array operations on the bytes; the
   distinct edges of some blocks, with their counts, are dealt by a hash of
   the edge into buckets and travel as packed columns. A task sums a bucket
   at a time, so a hot phrase is one row for some blocks of text, and no
   phrase's continuations meet in one task.
2. The count of a shorter phrase is the flow out of it: the sum of the counts
   of its continuations, end marks included. Node counts are summed from
   edges in the same way, the next shorter ones from nodes, and so on; texts
   are not read again.
3. A node whose whole flow comes in by one edge and leaves by one edge is an
   inner point of an unary path. Such paths are compacted (pointer doubling
   along the path, so rounds grow with the logarithm of its length) to one
   row of words and one count: that of all its edges and inner nodes. Only
   nodes at the ends of paths are looked up. A path lies within one piece of
   a document, which bounds its row.
4. Inner nodes are always contained in a longer phrase of the same count and
   drop out; other phrases are held against their strongest extension.

Words are known by 64-bit hashes seeded with their language. The dictionary
of all words is written first; should two words share a hash, all is done
with another seed, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.common import BLOCK_BYTES, FOLDED_VALUES, POWERS, mix64, prefix_sums, sliced, written

#: Bytes that end a piece, and bytes between words.
PIECE_END = np.zeros(256, bool)
PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True
GAP = PIECE_END.copy()
GAP[list(b" \t")] = True
#: Rows of counted phrases that a task sums at once.
CHUNK = 1 << 20
#: Bytes of text whose phrases make a bucket, and the most buckets; beyond
#: them buckets grow (a task sums one bucket at a time, and holds its distinct
#: phrases once).
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 1 << 16
#: Words whose dictionary entry a task remembers to have sent.
REMEMBERED = 1 << 20
#: Groups that a language's phrases are ranked in before the last ranking.
RANK_GROUPS = 256


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Blocks of (languages, bytes, offsets); a long text is cut at piece ends."""
    for rows, data, offsets in sliced(batches):
        langs = rows.column("lang").to_pylist()
        if len(langs) > 1 or len(data) <= BLOCK_BYTES:
            yield langs, data, offsets
            continue
        a = 0
        while a < len(data):
            z, step = a + BLOCK_BYTES, BLOCK_BYTES
            while z < len(data):
                end = np.flatnonzero(PIECE_END[data[z:z + step]])
                z += int(end[0]) if len(end) else step
                if len(end):
                    break
            z = min(z, len(data))
            yield langs, data[a:z], np.array([0, z - a])
            a = z


def _seed(lang: str, seed: int) -> int:
    return int.from_bytes(blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


def _words(langs: list[str], data: np.ndarray, offsets: np.ndarray,
           seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, rows, whether the next word is in the same
    piece) of a block's words; no hash is 0."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~GAP[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:]
    starts = np.flatnonzero(start)
    stop = np.zeros(n + 1, bool)
    stop[1:] = inside[:-1] & (~inside[1:] | edge[1:])
    ends = np.flatnonzero(stop)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    s = prefix_sums(data, FOLDED_VALUES)
    _, down = POWERS.get(n + 1)
    seeds = {x: _seed(x, seed) for x in set(langs)}
    own = np.array([seeds[x] for x in langs], np.uint64)[rows]
    hashes = mix64(mix64((s[ends] - s[starts]) * down[starts] + (ends - starts).astype(np.uint64)) ^ own)
    hashes[hashes == 0] = 1
    piece = np.cumsum(PIECE_END[data])[starts] if len(starts) else starts
    same = np.zeros(len(starts), bool)
    same[:-1] = (piece[1:] == piece[:-1]) & (rows[1:] == rows[:-1])
    return hashes, starts, ends, rows, same


class Counts:
    """Counted phrases of k words: ``ids`` (k rows) are places in the sorted
    distinct word hashes ``words``, in which 0 is the end mark."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, f: np.ndarray) -> None:
        self.words, self.ids, self.f = words, ids, f

    @classmethod
    def edges(cls, hashes: np.ndarray, same: np.ndarray, m: int) -> "Counts":
        """One edge a word of a block."""
        words, first = np.unique(hashes, return_inverse=True)
        ids = np.zeros((m, len(hashes)), np.int32)
        ids[0] = first + 1
        goes_on = np.ones(len(hashes), bool)
        for j in range(1, min(m, len(hashes))):
            goes_on[:len(same) - j + 1] &= same[j - 1:]
            goes_on[len(same) - j:] = False
            at = np.flatnonzero(goes_on)
            ids[j, at] = ids[0, at + j]
        return cls(np.concatenate([np.zeros(1, np.uint64), words]), ids, np.ones(len(hashes), np.int64))

    @classmethod
    def combined(cls, parts: list["Counts"]) -> "Counts":
        """All parts summed, in the order of their words."""
        words = np.unique(np.concatenate([p.words for p in parts]))
        ids = np.concatenate([np.searchsorted(words, p.words).astype(np.int32)[p.ids] for p in parts], axis=1)
        f = np.concatenate([p.f for p in parts])
        if not len(f):
            return cls(words, ids, f)
        if len(words) ** len(ids) < 1 << 62:
            key = ids[0].astype(np.int64)
            for column in ids[1:]:
                key = key * len(words) + column
            order = np.argsort(key)
            new = np.diff(key[order]) != 0
        else:
            order = np.lexsort(ids[::-1])
            new = (np.diff(ids[:, order], axis=1) != 0).any(axis=0)
        first = np.flatnonzero(np.concatenate([[True], new]))
        return cls(words, ids[:, order[first]], np.add.reduceat(f[order], first))

    def shorter(self) -> "Counts":
        """The flow out of every node: counts without the last word."""
        return Counts.combined([Counts(self.words, self.ids[:-1], self.f)])

    def buckets(self, n: int) -> Iterator[tuple[int, bytes]]:
        """The phrases dealt by a hash of all their words, packed."""
        spread = mix64(self.words)
        key = np.zeros(len(self.f), np.uint64)
        for column in self.ids:
            key = mix64(key + spread[column])
        bucket = (key % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(rows):
                yield int(bucket[rows[0]]), self._packed(rows)

    def _packed(self, rows: np.ndarray) -> bytes:
        own = np.unique(self.ids[:, rows])
        ids, f = np.searchsorted(own, self.ids[:, rows]), self.f[rows]
        kinds = [np.min_scalar_type(int(x.max())) for x in (ids, f)]
        head = np.array([len(self.ids), len(own), len(rows), *(k.itemsize for k in kinds)], np.int64)
        columns = [x.astype(k).view(np.uint8).reshape(-1, k.itemsize).T for x, k in zip((ids.ravel(), f), kinds)]
        return zstandard.compress(b"".join(x.tobytes() for x in (head, self.words[own], *columns)), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> "Counts":
        raw = zstandard.decompress(data)
        k, n_words, n, *sizes = np.frombuffer(raw, np.int64, 5).tolist()
        words = np.frombuffer(raw, np.uint64, n_words, 40)
        at, columns = 40 + 8 * n_words, []
        for size, length in zip(sizes, (k * n, n)):
            column = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length).T
            columns.append(np.ascontiguousarray(column).view(f"<u{size}").ravel())
            at += size * length
        return cls(words, columns[0].astype(np.int32).reshape(k, n), columns[1].astype(np.int64))


class Adder:
    """Sums parts as they come; what is not yet summed stays below CHUNK
    rows or below what is."""

    def __init__(self) -> None:
        self.parts: list[Counts] = []
        self.summed = 0

    def add(self, part: Counts) -> int:
        """Add a part; returns the number of summed rows when it has summed."""
        self.parts.append(part)
        if sum(len(p.f) for p in self.parts) < max(CHUNK, 2 * self.summed):
            return 0
        self.parts = [Counts.combined(self.parts)]
        self.summed = len(self.parts[0].f)
        return self.summed

    def take(self) -> Counts | None:
        """The sum of what was added since the last time."""
        out = Counts.combined(self.parts) if self.parts else None
        self.parts, self.summed = [], 0
        return out


def _named(words: list[str]) -> Column:
    return F.struct(*[F.col(w) for w in words])


def dictionary(docs: DataFrame, seed: int) -> DataFrame:
    """Written table of all words: word hash ``h``, lang, word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(0, np.uint64)
        for langs, data, offsets in _parts(batches):
            hashes, starts, ends, rows, _ = _words(langs, data, offsets, seed)
            own, first = np.unique(hashes, return_index=True)
            new = ~np.isin(own, sent, assume_unique=True)
            own, first = own[new], first[new]
            sent = own if len(sent) > REMEMBERED else np.union1d(sent, own)
            raw = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8).tobytes()
            spans = zip(starts[first].tolist(), ends[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.view(np.int64)), pa.array([langs[r] for r in rows[first].tolist()], pa.string()),
                 pa.array([raw[a:z] for a, z in spans], pa.binary()).cast(pa.string())], names=["h", "lang", "word"])

    return written(docs.mapInArrow(run, "h long, lang string, word string").dropDuplicates(), "phrase-words")


def phrase_counts(docs: DataFrame, m: int, least: int, seed: int) -> dict[int, DataFrame]:
    """Written tables of the phrases of 1 to m words: w1 ..., count f. Those
    of two or more words are kept from a count of ``least`` on."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_BUCKETS, 1 + size // BUCKET_BYTES)
    words = [f"w{i + 1}" for i in range(m)]
    kinds = "level int, bucket int, data binary, " + ", ".join(f"{w} long" for w in words) + ", f long"
    names = ["level", "bucket", "data", *words, "f"]

    def sent(counts: Counts) -> Iterator[pa.RecordBatch]:
        for bucket, data in counts.buckets(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(counts.ids)], pa.int32()), pa.array([bucket], pa.int32()), pa.array([data], pa.binary()),
                 *[pa.nulls(1, pa.int64())] * (m + 1)], names=names)

    def kept(counts: Counts) -> Iterator[pa.RecordBatch]:
        k = len(counts.ids)
        rows = np.flatnonzero((counts.words[counts.ids[-1]] != 0) & (counts.f >= (least if k > 1 else 1)))
        columns = [pa.array(counts.words[column[rows]].view(np.int64)) for column in counts.ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(rows), k, np.int32)), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary()),
             *columns, *[pa.nulls(len(rows), pa.int64())] * (m - k), pa.array(counts.f[rows])], names=names)

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adder = Adder()
        for langs, data, offsets in _parts(batches):
            hashes, _, _, _, same = _words(langs, data, offsets, seed)
            if adder.add(Counts.combined([Counts.edges(hashes, same, m)])) > CHUNK // 2:
                yield from sent(adder.take())
        if rest := adder.take():
            yield from sent(rest)

    def of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adder, flow, at = Adder(), Adder(), None

        def done() -> Iterator[pa.RecordBatch]:
            whole = adder.take()
            yield from kept(whole)
            if len(whole.ids) > 1 and flow.add(whole.shorter()) > CHUNK // 2:
                yield from sent(flow.take())

        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
                if at is not None and bucket != at:
                    yield from done()
                at = bucket
                adder.add(Counts.unpacked(data.as_py()))
        if at is not None:
            yield from done()
        if rest := flow.take():
            yield from sent(rest)

    table, out = docs.mapInArrow(of_texts, kinds), {}
    for k in range(m, 0, -1):
        dealt = table.where((F.col("level") == k) & F.col("bucket").isNotNull()).select("bucket", "data")
        table = written(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(of_buckets, kinds),
                        f"phrase-counts-{k}")
        out[k] = table.where("bucket is null").select(*words[:k], "f")
    return out


def with_extensions(shorter: DataFrame, longer: DataFrame, k: int) -> DataFrame:
    """Phrases of k words with the counts ``out`` and ``into`` of their
    strongest extensions to the right and the left (0: none), and the words
    ``next`` and ``prev`` of those that take all of their flow."""
    words = [f"w{i + 1}" for i in range(k)]
    for name, word, own in (("out", f"w{k + 1}", words), ("into", "w1", [f"w{i + 2}" for i in range(k)])):
        side = longer.groupBy(*[F.col(c).alias(w) for c, w in zip(own, words)]).agg(
            F.max("f").alias(name), F.max(word).alias("word"))
        shorter = shorter.join(side, words, "left").withColumn(
            "next" if name == "out" else "prev", F.when(F.col(name) == F.col("f"), F.col("word"))) \
            .withColumn(name, F.coalesce(name, F.lit(0))).drop("word")
    return shorter


def compact(nodes: DataFrame, edges: DataFrame, m: int) -> DataFrame:
    """Unary paths of the graph: written table of ``words`` (array, at least
    m of them) and the count f that all edges and inner nodes share. Every
    edge lies in exactly one path. ``nodes`` as ``with_extensions`` gives them."""
    words = [f"w{i + 1}" for i in range(m - 1)]
    unary = written(nodes.where("prev is not null and next is not null").select(*words, "prev", "next", "f"),
                    "phrase-unary")
    node = _named(words)
    before = F.struct(F.col("prev").alias("w1"), *[F.col(f"w{i + 1}").alias(f"w{i + 2}") for i in range(m - 2)])
    heads = unary.select(node.alias("at"), F.lit(1).alias("found"))
    state = written(unary.select(node.alias("node"), before.alias("at")).join(heads, "at", "left").select(
        "node", F.when(F.col("found") == 1, F.col("at")).otherwise(F.col("node")).alias("at"),
        F.coalesce("found", F.lit(0)).cast("long").alias("d")), "phrase-links")
    while True:
        ahead = state.where("d > 0").select(F.col("node").alias("at"), F.col("at").alias("to"), F.col("d").alias("more"))
        if state.where("d > 0").join(ahead, "at", "left_semi").isEmpty():
            break
        state = written(state.join(ahead, "at", "left").select(
            "node", F.coalesce("to", "at").alias("at"),
            (F.col("d") + F.coalesce("more", F.lit(0))).alias("d")), "phrase-links")
    chained = unary.withColumn("node", node).join(state, "node")
    paths = chained.groupBy("at").agg(
        F.max("f").alias("f"), F.max(F.when(F.col("d") == 0, F.col("prev"))).alias("prev"),
        F.sort_array(F.collect_list(F.struct("d", "next"))).alias("steps")).select(
        F.concat(F.array("prev", *[F.col("at")[w] for w in words]), F.col("steps.next")).alias("words"), "f")
    tails = unary.select(*[F.col(f"w{i + 1}").alias(f"w{i + 2}") for i in range(m - 1)])
    single = edges.join(unary.select(*words), words, "left_anti") \
        .join(tails, [f"w{i + 2}" for i in range(m - 1)], "left_anti") \
        .select(F.array(*[f"w{i + 1}" for i in range(m)]).alias("words"), "f")
    return written(paths.union(single), "phrase-paths")


def _lookup(rows: DataFrame, table: DataFrame, at: list[str], name: str) -> DataFrame:
    """Add the count ``name`` of the phrase in the columns ``at``."""
    return rows.join(table.select(*[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(at)],
                                  F.col("f").alias(name)), at)


def cohesion(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a^2 / (left * right)) in whole numbers of 38 digits."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def _scored(rows: DataFrame, k: int) -> DataFrame:
    """Rows of w1 ... wk, a and the counts l1, r1 ... with the lowest cut."""
    cuts = F.array_min(F.array(*[F.struct(
        cohesion(F.col("a"), F.col(f"l{c}"), F.col(f"r{c}")).alias("score"), F.lit(c).alias("cut"),
        F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]))
    return rows.select(*[f"w{i + 1}" for i in range(k)], "a", cuts.alias("x")).select(
        *[f"w{i + 1}" for i in range(k)], "a", "x.l", "x.r", "x.score")


def mine(docs: DataFrame, text_col: str, lang_col: str | None = None, longest: int = 3, least: int = 10,
         share: int = 50, top: int | None = 2000) -> DataFrame:
    """Phrases of 2 to ``longest`` words that stand together, by language:
    lang, rank (from 1), phrase, a (its count), l and r (of the two parts of
    its lowest-scoring cut), n (words of the language) and score = floor(10^6
    a^2 / (l r)); all numbers are longs.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]``
    and those into words at spaces and tabs. A phrase occurs ``least`` times
    at least; it is dropped where a longer one that contains it has ``share``
    per cent of its count or more. ``top`` phrases a language are returned,
    None: all. A null text is empty, a null language is ``und``; repeated
    rows count each; other columns are ignored. An empty table, or one
    without phrases, gives no rows."""
    if longest < 2 or least < 1 or not 0 < share <= 100:
        raise ValueError("longest must be 2 or more, least 1 or more, share 1 to 100")
    m = longest
    lang = F.lit("und") if lang_col is None else F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    docs = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    seed = 0
    known = dictionary(docs, seed)
    while not known.groupBy("h").count().where("count > 1").isEmpty():
        seed += 1
        known = dictionary(docs, seed)
    level = phrase_counts(docs, m, least, seed)
    vocabulary = written(known.join(level[1].select(F.col("w1").alias("h"), "f"), "h"), "phrase-vocabulary")
    sizes = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    inner = {k: with_extensions(level[k], level[k + 1], k) for k in range(1 if m == 2 else 2, m)}
    paths = compact(inner[m - 1], level[m], m)

    first, last = [f"s{i}" for i in range(m - 1)], [f"e{i}" for i in range(m - 1)]
    ends = paths.select("words", "f", *[F.col("words")[i].alias(c) for i, c in enumerate(first)],
                        *[F.element_at("words", i - m + 1).alias(c) for i, c in enumerate(last)])
    ends = _lookup(_lookup(ends, level[m - 1], first, "f_first"), level[m - 1], last, "f_last")
    place = F.posexplode(F.sequence(F.lit(1), F.size("words") - (m - 1))).alias("p", "at")
    found = ends.select("*", place).select(
        *[F.element_at("words", F.col("at") + i).alias(f"w{i + 1}") for i in range(m)], F.col("f").alias("a"),
        F.when(F.col("p") == 0, F.col("f_first")).otherwise(F.col("f")).alias(f"l{m - 1}"),
        F.when(F.col("at") == F.size("words") - (m - 1), F.col("f_last")).otherwise(F.col("f")).alias("r1"))
    scored = []
    for k in range(m, 1, -1):
        if k < m:
            strongest = F.greatest("out", "into")
            found = inner[k].where("prev is null or next is null" if k == m - 1 else "true") \
                .where(100 * strongest < share * F.col("f")) \
                .select(*[f"w{i + 1}" for i in range(k)], F.col("f").alias("a"))
        for c in range(1, k):
            if f"l{c}" not in found.columns:
                found = _lookup(found, level[c], [f"w{i + 1}" for i in range(c)], f"l{c}")
            if f"r{c}" not in found.columns:
                found = _lookup(found, level[k - c], [f"w{i + 1}" for i in range(c, k)], f"r{c}")
        out = _scored(found, k)
        for i in range(k):
            name = vocabulary.select(F.col("h").alias(f"w{i + 1}"), F.col("word").alias(f"t{i + 1}"),
                                     *([F.col("lang")] if i == 0 else []))
            out = out.join(name, f"w{i + 1}")
        scored.append(out.select("lang", F.concat_ws(" ", *[f"t{i + 1}" for i in range(k)]).alias("phrase"),
                                 "a", "l", "r", "score"))
    every = scored[0]
    for more in scored[1:]:
        every = every.union(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # the best of each group, so that no task ranks all phrases of a language
        group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
        every = every.withColumn("g", group).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang", "g").orderBy(*order))).where(F.col("rank") <= top)
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
