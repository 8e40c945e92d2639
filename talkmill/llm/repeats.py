"""Removal of repeated byte strings by suffix sorting.

Every string of ``LENGTH`` bytes that also starts earlier (in a smaller
document, or earlier in the same one) is removed wherever it is covered.

Equal strings must meet in one task. Each window of LENGTH bytes is given to
its *minimiser*, the smallest hash among the 32-byte strings in it, so equal
windows have equal minimisers; consecutive windows with the same one are a
*run* (at most 69 windows, 35 on average) and travel together.

1. Texts are written in blocks (documents, compressed bytes, and the
   distinct minimisers of the block's runs, as 32-bit numbers by bucket).
2. Per bucket: minimisers that occur in several blocks. Those that only one
   block has, and only once, cannot repeat and go no further.
3. The blocks' runs with repeated minimisers: of equal runs in a block only
   the first is sent on, the others are known to repeat. The same happens
   again where blocks meet, so a group of copies that holds a third of all
   rows sends one run per block and place.
4. Runs meet by minimiser, in sorted order. Different runs of the same
   minimiser are joined to one string, suffix-sorted in two stages
   (suffix_sort.py); adjacent suffixes that have LENGTH bytes in common are
   equal windows, and all but the earliest repeat. A minimiser with more
   than HOT runs is split beforehand into its single windows, which meet by
   their own hash.
5. The repeated stretches return to their blocks, where they are united.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from talkmill.llm.common import BYTE_VALUES, POWERS, mix64, prefix_sums, sliced, written
from talkmill.llm.suffix_sort import share_prefix, suffix_order

LENGTH = 100
GRAM = 32
#: Runs of a minimiser from which it is split into single windows.
HOT = 50_000
#: Distinct minimisers that meet in a bucket, about.
BUCKET = 400_000
#: Bytes that are suffix-sorted at once; a minimiser is never split here.
SORTED_BYTES = 1 << 20
NULL_ID = -(1 << 63)


class Runs:
    """Runs of a block: first window, number of windows, minimiser hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        n = len(data)
        self.first = np.zeros(0, np.int64)
        self.count, self.key = self.first.copy(), np.zeros(0, np.uint64)
        self.prefix = prefix_sums(data, BYTE_VALUES)
        sizes = np.diff(offsets)
        if n < length or not (sizes >= length).any():
            return
        span = length - GRAM + 1  # grams of a window
        _, down = POWERS.get(n + 1)
        grams = n - GRAM + 1
        h = mix64((self.prefix[GRAM:] - self.prefix[:grams]) * down[:grams])
        low = np.uint64((1 << grams.bit_length()) - 1)  # the place breaks ties: the leftmost minimum
        least = (h & ~low) | np.arange(grams, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if span > width:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        at = (least & low).astype(np.int64)
        windows = np.repeat(offsets[:-1], np.maximum(0, sizes - length + 1))
        windows += np.arange(len(windows)) - np.searchsorted(windows, windows)
        place = at[windows]
        new = np.ones(len(windows), bool)
        new[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)
        begin = np.flatnonzero(new)
        self.first = windows[begin]
        self.count = np.diff(np.append(begin, len(windows)))
        self.key = h[place[begin]]

    def hashes(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``first`` on."""
        _, down = POWERS.get(len(self.prefix))
        return mix64((self.prefix[first + size] - self.prefix[first]) * down[first] + size.astype(np.uint64))


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _joint(bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Bucket and 32 bits of the minimiser in one number."""
    return (bucket << 32) | (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _blocks(rows: DataFrame, length: int, n_buckets: int, kept: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part, data, offsets in sliced(batches):
            runs = Runs(data, offsets, length)
            joint, times = np.unique(_joint(_bucket(runs.key, n_buckets), runs.key), return_counts=True)
            buckets, at = np.unique(joint >> 32, return_index=True)
            keys = [{"bucket": int(b), "keys": k.astype(np.uint32).tobytes(),
                     "times": np.minimum(t, 65535).astype(np.uint16).tobytes()}
                    for b, k, t in zip(buckets, np.split(joint & 0xFFFFFFFF, at[1:]), np.split(times, at[1:]))]
            ids = np.asarray(part.column("doc").cast(pa.int64()).fill_null(NULL_ID))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([offsets.astype(np.int64).tobytes()], pa.binary()),
                 pa.array([pa.compress(data.tobytes(), "zstd", asbytes=True)], pa.binary()),
                 pa.array([_to_bytes(part.select([f"kept_{i}" for i in range(len(kept))]))], pa.binary()),
                 pa.array([keys], pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary()),
                                                      ("times", pa.binary())])))],
                names=["block", "docs", "offsets", "bytes", "rows", "found"])
            number += 1

    return written(rows.mapInArrow(
        run, "block long, docs binary, offsets binary, bytes binary, rows binary, "
             "found array<struct<bucket:int,keys:binary,times:binary>>"), "repeats-blocks")


def _to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(docs: bytes, offsets: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.frombuffer(offsets, np.int64)
    raw = pa.decompress(data, decompressed_size=int(at[-1]), codec="zstd", asbytes=True) if at[-1] else b""
    return np.frombuffer(docs, np.int64), at, np.frombuffer(raw, np.uint8)


def _repeated(blocks: DataFrame, hot: int) -> DataFrame:
    """Per block and bucket the minimisers that other blocks have too or the
    block has several times; those with more than ``hot`` runs apart."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint32) for k in rows["keys"]]
        all_, place = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(place, np.concatenate([np.frombuffer(t, np.uint16) for t in rows["times"]]))
        out = []
        for block, own, at in zip(rows["block"], keys, np.split(place, np.cumsum([len(k) for k in keys])[:-1])):
            n = times[at]
            some, much = own[(n > 1) & (n <= hot)], own[n > hot]
            if len(some) + len(much):
                out.append((block, rows["bucket"].iloc[0], some.tobytes(), much.tobytes()))
        return pd.DataFrame(out, columns=["block", "bucket", "some", "much"])

    entries = blocks.select("block", F.explode("found").alias("f")).select("block", "f.bucket", "f.keys", "f.times")
    met = entries.groupBy("bucket").applyInPandas(meet, "block long, bucket int, some binary, much binary")
    return met.groupBy("block").agg(F.collect_list(F.struct("bucket", "some", "much")).alias("repeated"))


_RUN = "key long, own long, doc long, block long, row int, start long, count int, bytes binary"


def _runs(length: int, n_buckets: int):
    """Blocks with their repeated minimisers to the runs that are to meet;
    a row without bytes is a stretch that is known to repeat."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1).to_pydict()
                ids, offsets, data = _opened(*(part[c][0] for c in ("docs", "offsets", "bytes")))
                yield from of_block(part["block"][0], ids, offsets, data, part["repeated"][0])

    def of_block(block, ids, offsets, data, repeated) -> Iterator[pa.RecordBatch]:
        runs = Runs(data, offsets, length)
        joint = _joint(_bucket(runs.key, n_buckets), runs.key)
        join = lambda name: np.concatenate([np.zeros(0, np.int64), *[
            (r["bucket"] << 32) | np.frombuffer(r[name], np.uint32).astype(np.int64) for r in repeated]])
        some, much = np.isin(joint, join("some")), np.isin(joint, join("much"))
        first, count, key = runs.first[some], runs.count[some], runs.key[some]
        if much.any():  # single windows that meet by their own hash
            wide = runs.count[much]
            single = np.repeat(runs.first[much] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
            first, count = np.append(first, single), np.append(count, np.ones(len(single), np.int64))
            key = np.append(key, runs.hashes(single, np.full(len(single), length)))
        size = count + length - 1
        own = runs.hashes(first, size)
        doc_row = np.searchsorted(offsets, first, side="right") - 1
        order = np.lexsort((first, doc_row, ids[doc_row], own, key))
        first, count, key, size, own, doc_row = (x[order] for x in (first, count, key, size, own, doc_row))
        again = np.zeros(len(first), bool)
        again[1:] = (key[1:] == key[:-1]) & (own[1:] == own[:-1])
        start = first - offsets[doc_row]
        kept = np.flatnonzero(~again)
        yield from rows(block, ids, doc_row[kept], start[kept], count[kept], key[kept].view(np.int64),
                        own[kept].view(np.int64), [data[a:b].tobytes() for a, b in zip(first[kept], (first + size)[kept])])
        # known repeats of this block: joined stretches, anywhere in the shuffle
        at = np.sort(first[again])
        ends = (first + size)[again][np.argsort(first[again])]
        r = np.searchsorted(offsets, at, side="right") - 1
        new = np.ones(len(at), bool)
        reach = np.maximum.accumulate(ends) if len(at) else ends
        new[1:] = (at[1:] > reach[:-1]) | (r[1:] != r[:-1])
        begin = np.flatnonzero(new)
        stop = reach[np.append(begin[1:] - 1, len(at) - 1)] if len(begin) else reach[:0]
        anywhere = mix64(np.arange(len(begin), dtype=np.uint64) + np.uint64(block % (1 << 62))).view(np.int64)
        yield from rows(block, ids, r[begin], at[begin] - offsets[r[begin]], stop - at[begin] - length + 1,
                        anywhere, anywhere, [None] * len(begin))

    def rows(block, ids, row, start, count, key, own, data) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(row), 20_000):
            s = slice(a, a + 20_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[s]), pa.array(own[s]), pa.array(ids[row[s]]), pa.array(np.full(len(row[s]), block)),
                 pa.array(row[s].astype(np.int32)), pa.array(start[s].astype(np.int64)),
                 pa.array(count[s].astype(np.int32)), pa.array(data[s], pa.binary())],
                names=["key", "own", "doc", "block", "row", "start", "count", "bytes"])

    return send


def _repeated_windows(text: np.ndarray, at: np.ndarray, count: np.ndarray, order_of: np.ndarray,
                      start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, first window, last window) of the stretches of windows that
    repeat an earlier one. ``order_of``: rank of each run's document."""
    run = np.repeat(np.arange(len(at)), count)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    place = at[run] + offset
    wanted = np.zeros(len(text), bool)
    wanted[place] = True
    order = suffix_order(text, wanted)
    number = np.zeros(len(text), np.int64)
    number[place] = np.arange(len(place))
    window = number[order]
    begin = np.flatnonzero(~share_prefix(text, order, length))
    # the earliest window of each group of equal ones is kept
    by_time = np.empty(len(run), np.int64)
    by_time[np.lexsort((start[run] + offset, order_of[run]))] = np.arange(len(run))
    earliest = np.minimum.reduceat(by_time[window], begin)
    group = np.zeros(len(window), np.int64)
    group[begin[1:]] = 1
    repeats = np.sort(window[by_time[window] != earliest[np.cumsum(group)]])
    new = np.ones(len(repeats), bool)
    new[1:] = (repeats[1:] != repeats[:-1] + 1) | (run[repeats[1:]] != run[repeats[:-1]])
    a = np.flatnonzero(new)
    z = np.append(a[1:] - 1, len(repeats) - 1) if len(a) else a
    return run[repeats[a]], offset[repeats[a]], offset[repeats[z]]


def _meet(length: int, sorted_bytes: int):
    """Runs in order of (minimiser, content, place) to repeated stretches,
    gathered by block: rows (block, triples of row, from, to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        held_bytes, last = 0, None
        out: list[tuple] = []
        for batch in batches:
            part = batch.to_pandas()
            known = part["bytes"].isna().to_numpy()
            key, own = part["key"].to_numpy(), part["own"].to_numpy()
            before = np.concatenate([[last if last else (0, 0)], np.stack([key, own], axis=1)[:-1]]) if len(part) else []
            if len(part):
                known |= (key == before[:, 0]) & (own == before[:, 1]) & ((np.arange(len(part)) > 0) | (last is not None))
                last = (key[-1], own[-1])
            old = part[known]
            if len(old):
                out.append(tuple(old[c].to_numpy() for c in ("block", "row", "start"))
                           + (old["start"].to_numpy() + old["count"].to_numpy() + length - 1,))
            new = part[~known]
            while len(new):
                room = np.cumsum(new["bytes"].str.len().to_numpy()) + held_bytes
                cut = int(np.searchsorted(room, sorted_bytes))
                k = new["key"].to_numpy()
                # the string may only end where the minimiser changes
                ends = np.flatnonzero(np.append(k[1:] != k[:-1], False))
                ends = ends[ends >= cut]
                if not len(ends):
                    held.append(new)
                    held_bytes = int(room[-1])
                    if held_bytes >= sorted_bytes and len(held) > 1 and held[-2]["key"].iloc[-1] != k[0]:
                        out += solve(pd.concat(held[:-1]))
                        held, held_bytes = [new], int(new["bytes"].str.len().sum())
                    break
                held.append(new[:ends[0] + 1])
                out += solve(pd.concat(held))
                held, held_bytes, new = [], 0, new[ends[0] + 1:]
            if sum(len(x[0]) for x in out) > 200_000:
                yield gathered(out)
                out = []
        if held:
            out += solve(pd.concat(held))
        if out:
            yield gathered(out)

    def solve(rows: pd.DataFrame) -> list[tuple]:
        key = rows["key"].to_numpy()
        shared = pd.Series(key).duplicated(keep=False).to_numpy()
        rows = rows[shared]
        if not len(rows):
            return []
        data = rows["bytes"].tolist()
        text = np.frombuffer(b"".join(data), np.uint8)
        sizes = np.array([len(x) for x in data], np.int64)
        rank = rows[["doc", "block", "row"]].apply(lambda c: c.to_numpy())
        order = np.lexsort((rank["row"], rank["block"], rank["doc"]))
        sorted_ = rank.to_numpy()[order]
        dense = np.empty(len(rows), np.int64)
        dense[order] = np.concatenate([[0], np.cumsum((sorted_[1:] != sorted_[:-1]).any(axis=1))])
        start = rows["start"].to_numpy()
        r, a, z = _repeated_windows(text, np.cumsum(sizes) - sizes, rows["count"].to_numpy().astype(np.int64),
                                    dense, start, length)
        return [(rows["block"].to_numpy()[r], rows["row"].to_numpy()[r], start[r] + a, start[r] + z + length)]

    def gathered(out: list[tuple]) -> pa.RecordBatch:
        block, row, a, z = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(block, kind="stable")
        triples = np.stack([row, a, z], axis=1)[order].astype(np.int64)
        blocks, at = np.unique(block[order], return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks), pa.array([t.tobytes() for t in np.split(triples, at[1:])], pa.binary())],
            names=["block", "stretches"])

    return run


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """A UTF-8 character goes as soon as one of its bytes does."""
    number = np.cumsum((data & 0xC0) != 0x80)
    hit = np.zeros(int(number[-1]) + 1 if len(number) else 1, bool)
    hit[number[gone]] = True
    return hit[number]


def _finish(kept_schema: pa.Schema, whole_characters: bool):
    """Unite a block's repeated stretches; rows of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield of_block({c: v[0] for c, v in batch.slice(i, 1).to_pydict().items()})

    def of_block(part: dict) -> pa.RecordBatch:
        ids, offsets, data = _opened(part["docs"], part["offsets"], part["bytes"])
        t = np.frombuffer(b"".join(part["stretches"] or []), np.int64).reshape(-1, 3)
        edge = np.bincount(offsets[t[:, 0]] + t[:, 1], minlength=len(data) + 1) \
            - np.bincount(offsets[t[:, 0]] + t[:, 2], minlength=len(data) + 1)
        gone = np.cumsum(edge)[:len(data)] > 0
        if whole_characters:
            gone = _whole_characters(data, gone)
        begins, stops = gone.copy(), gone.copy()
        begins[1:] &= ~gone[:-1]
        stops[:-1] &= ~gone[1:]
        inner = offsets[offsets < len(data)]
        begins[inner] = gone[inner]
        cut = offsets[(offsets > 0) & (offsets <= len(data))] - 1
        stops[cut] = gone[cut]
        a, z = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        a_at = np.searchsorted(a, offsets)
        kept = data[~gone]
        kept_at = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        spans = [[{"start": int(x - o), "stop": int(y - o)} for x, y in zip(a[p:q], z[p:q])]
                 for o, p, q in zip(offsets[:-1], a_at[:-1], a_at[1:])]
        sizes = np.diff(offsets)
        columns = [pa.array([None if x == NULL_ID else int(x) for x in ids], pa.int64()), pa.array(sizes),
                   pa.array(sizes - np.diff(kept_at)),
                   pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                   pa.array([kept[x:y].tobytes() for x, y in zip(kept_at[:-1], kept_at[1:])], pa.binary())]
        names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
        if len(kept_schema):
            rows = pa.ipc.open_stream(part["rows"]).read_all().combine_chunks().rename_columns(kept_schema.names)
            columns.append(rows.cast(kept_schema).to_struct_array().combine_chunks())
            names.append("row")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, hot: int = HOT,
                   bucket: int = BUCKET, sorted_bytes: int = SORTED_BYTES, keep: tuple[str, ...] = (),
                   whole_characters: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, stop of the maximal removed
    stretches) and kept (the remaining bytes) of every document, and with
    ``keep`` these columns of its row as the struct ``row``.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier in the input: in a row of smaller id, or earlier in the same
    row. With ``whole_characters`` a UTF-8 character goes as soon as one of
    its bytes does, so what is kept stays valid text. Strings do not cross
    rows. A null text is empty; a null id sorts first. Rows that repeat an
    id come in the order of the written blocks. An empty table gives no
    rows. Other columns are ignored. ``length`` must be from 33 to 104."""
    if not GRAM < length <= 104:
        raise ValueError("length must be from 33 to 104")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(12, 2 * total // ((length - GRAM + 2) * bucket))
    blocks = _blocks(rows, length, n_buckets, list(keep))
    # both joins read the same columns of the same rows, so the blocks are shuffled once
    content = blocks.where(F.col("block").isNotNull()).drop("found")
    runs = content.join(_repeated(blocks, hot), "block").mapInArrow(_runs(length, n_buckets), _RUN)
    met = runs.repartition("key").sortWithinPartitions("key", "own", "doc", "block", "row", "start") \
        .mapInArrow(_meet(length, sorted_bytes), "block long, stretches binary")
    stretches = met.groupBy("block").agg(F.collect_list("stretches").alias("stretches"))
    kept_type = docs.select(*keep).schema if keep else T.StructType()
    out = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, "
                               "spans array<struct<start:long,stop:long>>, kept binary")
    if keep:
        out = out.add("row", kept_type)
    return content.join(stretches, "block", "left").mapInArrow(
        _finish(to_arrow_schema(kept_type), whole_characters), out)
