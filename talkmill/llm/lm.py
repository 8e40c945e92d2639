"""Language-model scores of whole texts.

The model factors a subword: a causal self-attention model (attention.py)
gives the next token's *class* from the tokens so far, as a correction of
the class counts after the last token, and corpus counts give the token
within its class after the last token. Classes hold about
equal shares of the training tokens; the commonest tokens have one each.
All counts cover every training document:

1. One pass tokenises the texts into written blocks, with the distinct words
   of each block (64-bit hashes), their training counts, and each word's place
   among them.
2. Word counts meet in buckets of the hash and go back to their blocks, so a
   word is sent once a block, not once a document; a second look at the words
   needs their places only.
3. Subword counts and pair counts are summed within tasks first; both are
   bounded by the vocabulary.
4. The attention model starts from a few passes over a bounded sample of
   training windows; then it trains on all of them: the windows of a training
   document follow each other and cover it whole, and each is in one of the
   rounds. The tasks train copies over their windows, and the copies'
   average, weighted by tokens, starts the next round.
5. One pass scores every token once, with overlapping context windows, where
   the ids lie; by block only a few numbers a document are joined to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm import attention
from talkmill.llm.common import (BYTE_VALUES, MASK64, POWERS, mix64, prefix_sums, release_memory, sliced, word_hashes,
                                   written)
from talkmill.llm.subwords import BytePairEncoder

INPUTS = 1024  # classes of past tokens: the commonest tokens one each, the rest together
OUTPUTS = 64
SMOOTH = 20.0
#: Texts of a block, in slices of common.BLOCK_BYTES.
SLICES = 8
WARM_UP = 4096
WARM_UP_PASSES = 4
#: Every training window is in one round.
ROUNDS = 2
BATCH = 64
#: Longer units are not looked up among others.
UNIT_BYTES = 512


def _slice_bucket(key: np.ndarray, n: int) -> np.ndarray:
    """Buckets in the order of the hashes."""
    return ((key >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), kind)


#: Bytes that may stand before and behind a space where texts are cut: no
#: whitespace character ends or begins with one of them.
_BEFORE, _BEHIND = np.zeros((2, 256), bool)
_BEFORE[33:127] = _BEFORE[128:] = True
_BEFORE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
_BEHIND[33:127] = _BEHIND[0xC3:] = True
_BEHIND[[0xE1, 0xE2, 0xE3]] = False


def _spread(values: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs ``values[at[i]:at[i + 1]]`` of the ``chosen`` i, one after another."""
    sizes = np.diff(at)[chosen]
    upto = np.cumsum(sizes)
    return values[np.repeat(at[:-1][chosen] - (upto - sizes), sizes) + np.arange(int(sizes.sum()))]


def _tokenised(data: np.ndarray, offsets: np.ndarray, encoder: BytePairEncoder) -> tuple[np.ndarray, ...]:
    """(ids, number of ids by text, distinct word hashes, places of the words
    among them, number of words by text) of the texts in a block.

    Texts are cut before single spaces between other characters: no token
    reaches over such a cut. Of the units between the cuts, known by 64-bit
    hashes, the distinct ones are encoded (longer ones each)."""
    none = np.zeros(len(offsets) - 1, np.int64)
    if not len(data):
        return np.zeros(0, np.uint32), none, np.zeros(0, np.uint64), np.zeros(0, np.int32), none
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-2] = (data[1:-1] == 32) & _BEFORE[data[:-2]] & _BEHIND[data[2:]]
    cut[offsets] = cut[[0, -1]] = True
    cuts = np.flatnonzero(cut)
    of_text, start, size = np.searchsorted(cuts, offsets), cuts[:-1], np.diff(cuts)
    sums, (_, down) = prefix_sums(data, BYTE_VALUES), POWERS.get(len(data) + 1)
    keys = (sums[cuts[1:]] - sums[start]) * down[start] + size.astype(np.uint64)
    # sums of powers modulo 2**64 don't tell some made-up texts of 1024 bytes apart
    keys = np.where(size > UNIT_BYTES, mix64(start.astype(np.uint64)), keys)
    found, unit = np.unique(keys, return_inverse=True)
    some = np.empty(len(found), np.int64)
    some[unit] = np.arange(len(unit))  # a place of each
    start, size = start[some], size[some]
    # units that begin and end at a cut can be encoded in one text, the others alone
    joins = (size > 1) & (data[start] == 32) & _BEHIND[data[np.minimum(start + 1, len(data) - 1)]] & _BEFORE[data[start + size - 1]]
    order = np.argsort(~joins, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    unit, bounds, n = place[unit], np.concatenate([[0], np.cumsum(size[order])]), int(joins.sum())
    units = _spread(data, cuts, some[order])
    together = encoder.encode(units[:bounds[n]].tobytes().decode())
    upto = np.concatenate([[0], np.cumsum(encoder.lengths[together])])
    at = np.searchsorted(upto, bounds[:n + 1])
    if not np.array_equal(upto[at], bounds[:n + 1]):
        raise ValueError("a token goes over a cut between words")
    alone = [encoder.encode(units[a:b].tobytes().decode()) for a, b in zip(bounds[n:-1].tolist(), bounds[n + 1:].tolist())]
    at = np.concatenate([at, at[-1] + np.cumsum([len(x) for x in alone], dtype=np.int64)])
    words, word_at = word_hashes(units, bounds)
    keys, places = np.unique(words, return_inverse=True)
    by_text = lambda at: np.diff(np.concatenate([[0], np.cumsum(np.diff(at)[unit])])[of_text])
    return (_spread(np.concatenate([together, *alone]), at, unit), by_text(at), keys,
            _spread(places.astype(np.int32), word_at, unit), by_text(word_at))


def _blocks(rows: DataFrame, tokenizer: str, n_buckets: int) -> DataFrame:
    """doc ids, training flags, subword ids and counts by document, and the
    training counts of the ids; words: their number in training, the distinct
    ones by bucket with training counts, and each word's place among the
    distinct ones, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder.of(tokenizer)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        learnt = np.zeros(encoder.size + 1, np.int64)
        for part, data, offsets in sliced(batches):
            trains = np.asarray(part.column("trains")).astype(bool)
            ids, sizes, keys, places, lengths = _tokenised(data, offsets, encoder)
            learnt += np.bincount(ids[np.repeat(trains, sizes)], minlength=len(learnt))
            learnt[encoder.size] += int(trains.sum())
            counted = np.repeat(trains, lengths)
            held.append((part.column("doc").cast(pa.int64()), trains, ids, sizes, keys,
                         np.bincount(places, counted, minlength=len(keys)).astype(np.int64), int(counted.sum()),
                         places, lengths))
            if len(held) == SLICES:
                yield block(number, held, learnt)
                number, held = number + 1, []
                learnt[:] = 0
        if held:
            yield block(number, held, learnt)

    def block(number: int, held: list[tuple], learnt: np.ndarray) -> pa.RecordBatch:
        docs, trains, ids, sizes, keys, times, counted, places, lengths = zip(*held)
        all_, place = np.unique(np.concatenate(keys), return_inverse=True)
        of_slice = np.split(place.astype(np.uint32), np.cumsum([len(k) for k in keys])[:-1])
        total = np.bincount(place, np.concatenate(times), minlength=len(all_)).astype(np.int64)
        buckets, at = np.unique(_slice_bucket(all_, n_buckets), return_index=True)
        found = [{"bucket": int(b), "keys": k.tobytes(), "times": t.tobytes()}
                 for b, k, t in zip(buckets, np.split(all_, at[1:]), np.split(total, at[1:]))]
        doc, some = pa.concat_arrays(docs), np.flatnonzero(learnt).astype(np.int32)
        tokens = pa.StructArray.from_arrays([pa.array(some), pa.array(learnt[some])], names=["i", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([doc.to_pylist()], pa.list_(pa.int64())),
             pa.array([np.concatenate(trains).astype(np.uint8).tobytes()], pa.binary()),
             pa.array([np.concatenate(sizes).astype(np.int64).tobytes()], pa.binary()),
             pa.array([np.array([len(x) for x in sizes], np.int64).tobytes()], pa.binary()),
             pa.array([_packed(np.concatenate(ids).astype(np.uint32))], pa.binary()),
             pa.array([sum(counted)], pa.int64()),
             pa.array([_packed(np.concatenate([own[p] for own, p in zip(of_slice, places)]))], pa.binary()),
             pa.array([np.concatenate(lengths).astype(np.int64).tobytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), tokens),
             pa.array([found], pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary()),
                                                   ("times", pa.binary())])))],
            names=["block", "docs", "trains", "sizes", "slices", "ids", "words", "places", "lengths", "learnt", "found"])

    return written(rows.mapInArrow(
        run, "block long, docs array<long>, trains binary, sizes binary, slices binary, ids binary, "
             "words long, places binary, lengths binary, learnt array<struct<i:int,n:long>>, "
             "found array<struct<bucket:int,keys:binary,times:binary>>"), "lm-blocks")


class Slice:
    """Documents of a slice of a block and their subword ids."""

    def __init__(self, docs: list, trains: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs, self.trains, self.sizes, self.ids = docs, trains, sizes, ids.astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)])

    def framed(self, end: int, more: int = 0) -> np.ndarray:
        """The ids with the end token before the first text and behind each,
        and ``more`` of them at the end."""
        out = np.full(len(self.ids) + len(self.sizes) + 1 + more, end, np.int64)
        inner = np.ones(len(self.ids) + len(self.sizes), bool)
        inner[self.at[1:] + np.arange(len(self.sizes))] = False
        out[1:len(inner) + 1][inner] = self.ids
        return out

    def pairs(self, end: int, only_training: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(last token, token, tokens by document): each text starts after
        and finishes with the end token."""
        counts, tokens = self.sizes + 1, self.framed(end)
        last, nxt = tokens[:-1], tokens[1:]
        if only_training:
            keep = np.repeat(self.trains, counts)
            return last[keep], nxt[keep], counts[self.trains]
        return last, nxt, counts


def _slices(part: pa.RecordBatch, row: int) -> Iterator[Slice]:
    """The slices of a written block, the same as when it was written; only
    one at a time is widened to 64 bits."""
    at = lambda c: part.column(c)[row].as_py()
    docs = at("docs")
    trains = np.frombuffer(at("trains"), np.uint8).astype(bool)
    sizes = np.frombuffer(at("sizes"), np.int64)
    ids = _unpacked(at("ids"), int(sizes.sum()), np.uint32)
    upto, done = np.concatenate([[0], np.cumsum(sizes)]), 0
    for n in np.frombuffer(at("slices"), np.int64).tolist():
        own = slice(done, done + n)
        yield Slice(docs[own], trains[own], sizes[own], ids[upto[done]:upto[done + n]])
        done += n


def _each(run: Callable[[Slice], None], batches: Iterator[pa.RecordBatch]) -> None:
    """Work through the slices; at the end of the task its Python worker
    gives unused memory back, since it may wait idle beside later ones."""
    for batch in batches:
        for row in range(batch.num_rows):
            for part in _slices(batch, row):
                run(part)
    release_memory()


_CONTENT = ("docs", "trains", "sizes", "slices", "ids")


def _token_counts(blocks: DataFrame, size: int) -> np.ndarray:
    rows = blocks.select(F.explode("learnt").alias("t")).groupBy("t.i").agg(F.sum("t.n").alias("n"))
    out = np.zeros(size + 1, np.int64)
    for r in rows.collect():  # at most one row a vocabulary entry
        out[r["i"]] = r["n"]
    return out


class Classes:
    """Classes of the tokens by their training counts."""

    def __init__(self, counts: np.ndarray) -> None:
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        self.input = np.minimum(rank, INPUTS - 1)
        self.output = np.zeros(len(counts), np.int64)
        left, free, i = int(counts.sum()), OUTPUTS, 0
        while free > 1 and i < len(order) and counts[order[i]] * free >= max(left, 1):
            self.output[order[i]] = OUTPUTS - free
            left, free, i = left - int(counts[order[i]]), free - 1, i + 1
        rest = order[i:]
        upto = np.cumsum(counts[rest])
        self.output[rest] = OUTPUTS - free + np.clip((upto - 1) * free // max(left, 1), 0, free - 1)
        self.small_input, self.small_output = self.input.astype(np.int16), self.output.astype(np.int16)
        self.used = np.full(len(counts), int((counts > 0).sum()), np.int64)  # unseen tokens share the last column
        self.used[order[:int((counts > 0).sum())]] = np.arange(int((counts > 0).sum()))


class PairTable:
    """log10 probability of a token within its class after a last token of
    an input class. Only pairs that occur are held, sorted: a pair that does
    not occur has the token's own probability, less what the pairs of its
    row and class take."""

    def __init__(self, counts: np.ndarray, classes: Classes, keys: np.ndarray, times: np.ndarray) -> None:
        """``keys``: input class * columns + column, sorted; columns are
        those of ``classes.used``."""
        self.columns = int((counts > 0).sum()) + 1
        of_class = np.bincount(classes.output, counts, minlength=OUTPUTS)
        members = np.bincount(classes.output, minlength=OUTPUTS)
        self.output = np.zeros(self.columns, np.int64)  # unseen tokens are in the last class
        alone = np.zeros(self.columns)
        self.output[classes.used] = classes.output
        alone[classes.used] = ((counts + 0.01) / (of_class + 0.01 * members)[classes.output])
        row, column = np.divmod(keys, self.columns)
        in_class = np.bincount(row * OUTPUTS + self.output[column], times, minlength=INPUTS * OUTPUTS)
        in_class = in_class.reshape(INPUTS, OUTPUTS)
        alone_class = (of_class + 0.5) / (of_class + 0.5).sum()
        #: Natural log-probability of the output class after the input class.
        self.prior = np.log((in_class + SMOOTH * alone_class)
                            / (in_class.sum(axis=1, keepdims=True) + SMOOTH)).astype(np.float32)
        self.bits = max(1, len(keys).bit_length())
        bucket = self._bucket(keys.astype(np.uint32))
        order = np.argsort(bucket, kind="stable")
        #: In the order of their buckets; the last one stands for pairs that do not occur.
        self.keys = np.append(keys[order], 0xFFFFFFFF).astype(np.uint32)
        self.gain = np.append(np.log10(1 + times / (SMOOTH * alone[column]))[order], 0).astype(np.float32)
        self.alone = np.log10(np.maximum(SMOOTH * alone, 1e-300)).astype(np.float32)
        self.total = np.log10(in_class + SMOOTH).astype(np.float32)
        self.starts: np.ndarray | None = None

    def _bucket(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)

    def log10(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        if self.starts is None:  # made where it is used, not sent
            held = np.bincount(self._bucket(self.keys[:-1]), minlength=1 << self.bits)
            self.starts = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
        out = self.alone[column] - self.total[row, self.output[column]]
        key = (row * self.columns + column).astype(np.uint32)
        bucket = self._bucket(key)
        at = self.starts[bucket]
        left = np.flatnonzero(self.keys[at] != key)
        while len(left):  # a bucket holds one pair or none, mostly
            at[left] += 1
            end = at[left] >= self.starts[bucket[left] + 1]
            at[left[end]] = len(self.keys) - 1
            left = left[~end]
            left = left[self.keys[at[left]] != key[left]]
        out += self.gain[at]
        return out


def _pair_table(blocks: DataFrame, counts: np.ndarray, classes: Classes) -> PairTable:
    """The pairs of all training tokens: at most INPUTS times the vocabulary
    of them, 12 bytes each on their way to the driver."""
    end, n_used = len(counts) - 1, int((counts > 0).sum())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(INPUTS * (n_used + 1), np.int32)

        def add(b: Slice) -> None:
            last, nxt, _ = b.pairs(end, True)
            keys, n = np.unique(classes.input[last] * (n_used + 1) + classes.used[nxt], return_counts=True)
            total[keys] += n.astype(np.int32)

        _each(add, batches)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))],
                                         names=["i", "n"])

    rows = blocks.select(*_CONTENT).mapInArrow(count, "i int, n long").groupBy("i") \
        .agg(F.sum("n").alias("n")).toArrow()
    keys, times = rows.column("i").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(keys, kind="stable")
    return PairTable(counts, classes, keys[order], times[order])


def _windows(b: Slice, end: int, classes: Classes, choose: Callable[[np.ndarray], np.ndarray] = lambda draw:
             np.arange(len(draw))) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, outputs, real tokens, draw) of the training windows of a
    slice: they follow each other through each training document, the last
    one padded; the draw is a hash of the document's id, the text's start and
    length, and the place, so copies have draws of their own. ``choose``
    gives the places of those that are wanted from the draws of all."""
    w, mine = attention.WINDOW, np.flatnonzero(b.trains)
    counts = b.sizes[mine] + 1
    number = -(-counts // w)
    doc = np.repeat(np.arange(len(counts)), number)
    if not len(doc):
        return np.zeros((0, w), np.int16), np.zeros((0, w), np.int16), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    tokens = b.framed(end, w)
    first = b.at[mine] + mine  # the end token before each
    j = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    ids = mix64(np.array([d or 0 for d, t in zip(b.docs, b.trains) if t], np.int64).view(np.uint64))
    draw = mix64((tokens[first + 1][doc] + 7919 * counts[doc] + 104729 * j).astype(np.uint64) + ids[doc])
    some = choose(draw)
    doc, j, draw = doc[some], j[some], draw[some]
    real = np.minimum(w, counts[doc] - j * w)
    rows = np.lib.stride_tricks.sliding_window_view(tokens, w + 1)[first[doc] + j * w]
    x, y = classes.small_input[rows[:, :-1]], classes.small_output[rows[:, 1:]]
    short = np.flatnonzero(real < w)
    upto = np.minimum(np.arange(w)[None, :], real[short, None] - 1)
    x[short], y[short] = (np.take_along_axis(t[short], upto, axis=1) for t in (x, y))
    return x, y, real, draw


def _warm_up_draws(counts: np.ndarray) -> np.uint64:
    """Windows with a draw up to this are two to four times WARM_UP, or all
    if they are fewer, however many tasks there are."""
    least = max(int(counts.sum()) // attention.WINDOW, int(counts[-1]), 1)
    return np.uint64(min(MASK64, 2 * WARM_UP * (MASK64 + 1) // least))


def _train(blocks: DataFrame, counts: np.ndarray, classes: Classes, prior: np.ndarray) -> attention.Parameters:
    start, end, upto = attention.initial(INPUTS, OUTPUTS), len(counts) - 1, _warm_up_draws(counts)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []

        def first(draw: np.ndarray) -> np.ndarray:
            some = np.flatnonzero(draw <= upto)
            return some[np.argsort(draw[some], kind="stable")[:WARM_UP]]

        def add(b: Slice) -> None:
            x, y, real, draw = _windows(b, end, classes, first)
            xyn = np.concatenate([x, y, real[:, None]], axis=1).astype(np.int16)
            kept.extend((int(d) >> 1, row.tobytes()) for d, row in zip(draw, xyn))
            kept.sort()
            del kept[WARM_UP:]

        _each(add, batches)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.int64()),
                                          pa.array([d for _, d in kept], pa.binary())], names=["draw", "xyn"])

    rows = blocks.select(*_CONTENT).mapInArrow(sample, "draw long, xyn binary") \
        .orderBy("draw", "xyn").limit(WARM_UP).collect()
    if not rows:
        return start
    xyn = np.stack([np.frombuffer(r["xyn"], np.int16) for r in rows]).astype(np.int64)
    x, y, real = xyn[:, :attention.WINDOW], xyn[:, attention.WINDOW:-1], xyn[:, -1]
    adam, rng = attention.Adam(start, prior, 4e-3), np.random.default_rng(9)
    for _ in range(WARM_UP_PASSES):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            own = order[at:at + BATCH]
            adam.step(x[own], y[own], real[own])
    params = adam.p

    for round_ in range(ROUNDS):
        own = blocks.sparkSession.sparkContext.broadcast((params, classes, prior))
        rate = 3e-3 / (1 + 2 * round_)

        def improve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            params, classes, prior = own.value
            adam, seen = attention.Adam(params, prior, rate), [0]

            def of_round(draw: np.ndarray) -> np.ndarray:
                some = np.flatnonzero(draw % np.uint64(ROUNDS) == round_)
                return some[np.argsort(draw[some], kind="stable")]

            def add(b: Slice) -> None:
                x, y, real, _ = _windows(b, end, classes, of_round)
                for at in range(0, len(x), BATCH):
                    adam.step(x[at:at + BATCH], y[at:at + BATCH], real[at:at + BATCH])
                seen[0] += int(real.sum())

            _each(add, batches)
            values = attention.flat(adam.p) * seen[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values),
                 pa.array(np.full(len(values), seen[0], np.int64))], names=["i", "v", "n"])

        sums = blocks.select(*_CONTENT).mapInArrow(improve, "i int, v double, n long") \
            .groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas().sort_values("i")
        if sums["n"].iloc[0]:  # a tiny corpus may have no window in a round
            params = attention.shaped((sums["v"] / sums["n"]).to_numpy(), params)
        own.unpersist()
    return params


def _word_counts(blocks: DataFrame) -> DataFrame:
    """Per block and bucket the training counts of its words; a row with a
    negative block holds the distinct training words of the bucket."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
        all_, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate([np.frombuffer(t, np.int64) for t in rows["times"]])).astype(np.int64)
        bucket = int(rows["bucket"].iloc[0])
        out = [(b, bucket, _packed(total[p]), len(p)) for b, p in
               zip(rows["block"], np.split(place, np.cumsum([len(k) for k in keys])[:-1]))]
        out.append((-1 - bucket, bucket, b"", int((total > 0).sum())))
        return pd.DataFrame(out, columns=["block", "bucket", "counts", "n"])

    entries = blocks.select("block", F.explode("found").alias("f")).select("block", "f.bucket", "f.keys", "f.times")
    return written(entries.groupBy("bucket").applyInPandas(
        meet, "block long, bucket int, counts binary, n long"), "lm-words")


def score(docs: DataFrame, id_col: str, text_col: str, trains: Column, tokenizer: str) -> DataFrame:
    """Scores of every row of ``docs``: doc_id, trains, n_tokens (words and
    one end), n_known, train_tokens, base_score, score (log10).

    Words are runs of non-space bytes with A-Z lower-cased, known by their
    64-bit hashes. base_score is the add-one unigram log10 probability of the
    words and the end; score is the model's log10 probability of the text's
    subwords and the end. ``trains`` says which rows are learnt from (null:
    not). A null text is empty. Repeated rows count and are scored each; null
    ids are kept. Without training rows the model is uniform within classes
    and untrained. An empty table gives no rows. Other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                       F.coalesce(trains, F.lit(False)).alias("trains"))
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(12, total // (32 << 20))
    blocks = _blocks(rows, tokenizer, n_buckets)
    size = BytePairEncoder.of(tokenizer).size
    words = _word_counts(blocks)
    counts = _token_counts(blocks, size)
    classes = Classes(counts)
    table = _pair_table(blocks, counts, classes)
    params = _train(blocks, counts, classes, table.prior)

    n_ends = int(counts[size])
    known = blocks.agg(F.sum("words")).first()[0] or 0
    distinct = words.where("block < 0").agg(F.sum("n")).first()[0] or 0
    n_train, vocabulary = known + n_ends, distinct + (n_ends > 0)
    model = docs.sparkSession.sparkContext.broadcast((params, classes, table))
    base = np.log10(n_train + vocabulary + 1)

    def model_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, classes, table = model.value
        scorer = attention.Scorer(params, table.prior)
        for batch in batches:
            for row in range(batch.num_rows):
                logs = []
                for b in _slices(batch, row):
                    last, nxt, sizes = b.pairs(size, False)
                    before = classes.input[last]
                    own = scorer.log_probabilities(before, classes.output[nxt], sizes).astype(np.float64)
                    own = own / np.log(10) + table.log10(before, classes.used[nxt])
                    upto, stops = np.concatenate([[0], np.cumsum(own)]), np.cumsum(sizes)
                    logs.append(upto[stops] - upto[stops - sizes])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(row, 1) for c in ("block", "docs", "trains")]
                    + [pa.array([np.concatenate(logs).tobytes()], pa.binary())], names=["block", "docs", "trains", "logs"])
        release_memory()

    def base_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = lambda c: batch.column(c)[row].as_py()
                parts = [(p["bucket"], _unpacked(p["counts"], p["n"], np.int64)) for p in at("counts") or []]
                times_of = np.concatenate([np.zeros(0, np.int64), *[x for _, x in sorted(parts, key=lambda p: p[0])]])
                lengths = np.frombuffer(at("lengths"), np.int64)
                place = _unpacked(at("places"), int(lengths.sum()), np.uint32)
                text = np.repeat(np.arange(len(lengths)), lengths)
                value = np.bincount(text, (np.log10(times_of + 1) - base)[place], minlength=len(lengths))
                seen = np.bincount(text, (times_of > 0)[place], minlength=len(lengths)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(row, 1), batch.column("lengths").slice(row, 1),
                     pa.array([(seen + int(n_ends > 0)).tobytes()], pa.binary()),
                     pa.array([(value + np.log10(n_ends + 1) - base).tobytes()], pa.binary())],
                    names=["block", "lengths", "known", "base"])
        release_memory()

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = lambda c, kind: np.frombuffer(batch.column(c)[row].as_py(), kind)
                docs = batch.column("docs")[row].values
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(of("trains", np.uint8).astype(bool)), pa.array(of("lengths", np.int64) + 1),
                     pa.array(of("known", np.int64)), pa.array(np.full(len(docs), n_train)),
                     pa.array(of("base", np.float64)), pa.array(of("logs", np.float64))],
                    names=["doc_id", "trains", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    by_block = words.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("bucket", "counts", "n")).alias("counts"))
    # the ids stay where they are: only places of words, and then a few numbers a document, meet by block
    bases = blocks.select("block", "places", "lengths").join(by_block, "block", "left").select(
        "block", "places", "lengths", "counts").mapInArrow(
        base_logs, "block long, lengths binary, known binary, base binary")
    scores = blocks.select("block", *_CONTENT).mapInArrow(
        model_logs, "block long, docs array<long>, trains binary, logs binary")
    return scores.join(bases, "block").select("docs", "trains", "lengths", "known", "base", "logs").mapInArrow(
        by_document, "doc_id long, trains boolean, n_tokens long, n_known long, train_tokens long, "
                     "base_score double, score double")
