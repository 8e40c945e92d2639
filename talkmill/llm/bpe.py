"""Byte-level BPE encoding and decoding by contiguous rank arrays.

A block of texts is cut into words (letters, numbers, other signs and runs
of white space, by the vocabulary's splitting rule) with array operations on
the UTF-8 bytes, and the distinct words of the block are encoded once. All
short words lie in one array of parts, each beginning as one byte, beside an
array of ranks: what merge joins a part to the next one of its word. A round
scans for the least rank of every word, deletes the boundary behind that
part and refreshes the two ranks beside it, until no word has a merge left.
Equal least ranks of one word are merged in the same round, from the left;
that is the order of single merges too, since every merge makes a part that
only later merges use (checked on loading). Long words, whose rounds would
grow with their length, take the same merges from a heap.

A text longer than a block is cut at single spaces between ASCII letters or
digits, where a word starts whatever is around, so memory does not depend on
the longest text.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkmill.llm.common import BLOCK_BYTES, sliced
from talkmill.llm.subwords import _byte_alphabet

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
NONE = np.int32(2 ** 31 - 1)
#: Bytes from which on a word takes the heap.
LONG_WORD = 512
#: Words that a worker remembers between blocks.
REMEMBERED = 1 << 16


class BytePairs:
    """A ``tokenizers`` JSON file of a byte-level BPE without normaliser,
    prefix space, dropout or unknown id (checked on loading)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or spec["normalizer"] \
                or cut["add_prefix_space"] or not cut.get("use_regex", True) \
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                              "end_of_word_suffix", "ignore_merges", "byte_fallback")):
            raise ValueError("only plain byte-level BPE vocabularies")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must be plain strings")
        alphabet = _byte_alphabet()
        vocab = model["vocab"]
        #: Strings that are one id wherever they stand in a text.
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        bytes_of = {i: bytes(alphabet[c] for c in p) for p, i in vocab.items()
                    if all(c in alphabet for c in p)} | {i: p for p, i in self.special.items()}
        self.size = max(bytes_of) + 1
        pieces = [bytes_of.get(i, b"") for i in range(self.size)]
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_id = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        by_rank = {int(i): r for r, i in reversed(list(enumerate(made)))}
        if any(max(by_rank.get(int(k) >> 32, -1), by_rank.get(int(k) & 0xFFFFFFFF, -1)) >= r
               for r, k in enumerate(keys)):
            raise ValueError("a merge uses a part that a later merge makes")
        order = np.argsort(keys, kind="stable")
        #: Sorted pairs (left id in the high half) with their ranks; what each rank makes.
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.classes = _character_classes()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of two ids, NONE where there is none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def _character_classes() -> np.ndarray:
    """OTHER, LETTER, NUMBER or SPACE of every code point, as the library's
    splitting rule sees it: what ``regex`` calls a letter or number counts
    where the library (whose Unicode tables can be older) keeps it together
    with a letter or a digit."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = np.zeros(0x110000, np.uint8)
    out[[ord(c) for c in regex.findall(r"\s", "".join(points))]] = SPACE
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for pattern, base, kind in ((r"\p{L}", "a", LETTER), (r"\p{N}", "1", NUMBER)):
        found = regex.findall(pattern, "".join(points))
        starts = np.array([span[0] for _, span in split("".join(f"\n{base}{c}" for c in found))])
        joined = np.ones(3 * len(found), bool)
        joined[starts] = False
        own = np.array([ord(c) for c in found])[joined[2::3]]
        out[own] = kind
    return out


class Encoder:
    """Encodes blocks of texts with a BytePairs model; one a worker."""

    _of: dict[int, "Encoder"] = {}

    def __init__(self, model: BytePairs) -> None:
        self.m = model
        self._pairs: dict[int, tuple[int, int]] | None = None
        self._special = re.compile(b"|".join(re.escape(s) for s in sorted(model.special, key=len, reverse=True))) \
            if model.special else None
        self._cuts = not any(b" " in s for s in model.special)
        self._known: dict[bytes, np.ndarray] = {}
        self._first = model.rank(np.repeat(model.byte_id, 256), np.tile(model.byte_id, 256))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the texts in them) of a block."""
        if len(offsets) == 2 and len(data) > BLOCK_BYTES and self._cuts:
            ids = np.concatenate([self._encode(part, np.array([0, len(part)]))[0] for part in _cut(data)])
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self._word_starts(data, offsets)
        raw = pa.py_buffer(np.ascontiguousarray(data))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), raw]).dictionary_encode()
        which = words.indices.to_numpy()
        ids, begin = self._distinct(words.dictionary)
        size = np.diff(begin)[which]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = ids[np.repeat(begin[:-1][which] - upto[:-1], size) + np.arange(upto[-1])]
        return out.astype(np.uint32), upto[np.searchsorted(starts, offsets)]

    def _word_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte places where words start."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        point = data[at].astype(np.int32)
        for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
            long = np.flatnonzero((point >= least) & (point < (0x100, 0xE0, 0xF0, 0x100)[more]))
            if len(long):
                value = point[long] & mask
                for k in range(1, more + 1):
                    value = (value << 6) | (data[at[long] + k] & 0x3F)
                # marked, so that later rounds leave them alone
                point[long] = value | (1 << 24)
        point &= (1 << 24) - 1
        kind = self.m.classes[point]
        n = len(at)
        edge = np.zeros(n + 1, bool)  # a text or a special string starts or ends here
        edge[np.searchsorted(at, offsets)] = True
        edge[0] = edge[n] = True
        inside = self._special_strings(data, offsets, at, edge)
        first = edge[:n].copy()
        first[1:] |= kind[1:] != kind[:-1]
        space, blank = kind == SPACE, point == 32
        start = first.copy()
        start[1:] &= ~(blank[:-1] & ~edge[1:n] & ~space[1:])
        start[:-1] |= space[:-1] & ~space[1:] & ~edge[1:n]
        quote = np.flatnonzero((point[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:n])
        if len(quote):
            one = np.isin(point[quote + 1], [ord(c) for c in "sdmt"])
            third = np.minimum(quote + 2, n - 1)
            pair = (point[quote + 1] << 8) | point[third]
            two = np.isin(pair, [(ord(a) << 8) | ord(b) for a, b in ("ll", "ve", "re")]) & ~edge[quote + 2] \
                & (quote + 2 < n)
            start[quote[one | two] + 1] = False
            start[quote[two] + 2] = False
            after = np.concatenate([quote[one] + 2, quote[two] + 3])
            start[after[after < n]] = True
        for a, z in inside:
            start[a + 1:z] = False
        return at[start]

    def _special_strings(self, data: np.ndarray, offsets: np.ndarray, at: np.ndarray,
                         edge: np.ndarray) -> list[tuple[int, int]]:
        """Character ranges of the special strings; marks their edges."""
        if self._special is None:
            return []
        raw = data.tobytes()
        if not any(s in raw for s in self.m.special):
            return []
        found = []
        for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for match in self._special.finditer(raw, a, z):
                own = tuple(int(x) for x in np.searchsorted(at, match.span()))
                edge[list(own)] = True
                found.append(own)
        return found

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the words in them) of distinct words; those that
        the worker has met lately are remembered."""
        listed = words.to_pylist()
        known = self._known
        new = [w for w in listed if w not in known]
        made: dict[bytes, np.ndarray] = {w: np.array([self.m.special[w]], np.int32)
                                         for w in new if w in self.m.special}
        for w in new:
            if len(w) > LONG_WORD and w not in made:
                made[w] = self._merge_long(w)
        short = [w for w in new if w not in made]
        made |= zip(short, self._merge_short(short))
        ids = [known[w] if w in known else made[w] for w in listed]
        if len(known) + len(made) > REMEMBERED:
            known.clear()
        known.update((w, x) for w, x in made.items() if len(w) <= 64)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])

    def _merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        if not words:
            return []
        raw = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        part, word = self.m.byte_id[raw], np.arange(len(words))
        rank = np.full(len(raw), NONE)
        rank[:-1] = self._first[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        rank[np.cumsum(size) - 1] = NONE
        out: list[np.ndarray] = [None] * len(words)
        while len(word):
            start = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, start)
            done = least == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[word[k]] = part[start[k]:start[k] + size[k]]
                left = np.repeat(~done, size)
                part, rank = part[left], rank[left]
                word, size, least = word[~done], size[~done], least[~done]
                if not len(word):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            # of parts that could be merged on both sides every second one
            fresh = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            begin = np.flatnonzero(fresh)
            place = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))
            hit = hit[place % 2 == 0]
            part[hit] = self.m.made[rank[hit]]
            stays = np.ones(len(part), bool)
            stays[hit + 1] = False
            owner = np.repeat(np.arange(len(word)), size)
            size = size - np.bincount(owner[hit], minlength=len(word))
            hit -= np.arange(len(hit))
            part, rank, owner = part[stays], rank[stays], owner[stays]
            near = np.unique(np.concatenate([hit, hit[hit > 0] - 1]))
            near = near[near < len(part) - 1]
            rank[near] = np.where(owner[near] == owner[near + 1], self.m.rank(part[near], part[near + 1]), NONE)
            if len(hit) and hit[-1] == len(part) - 1:
                rank[-1] = NONE
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        if self._pairs is None:
            m = self.m
            self._pairs = {int(k): (int(r), int(m.made[r])) for k, r in zip(m.keys, m.ranks)}
        pairs = self._pairs
        part = self.m.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(x[0], i) for i, (a, b) in enumerate(zip(part, part[1:])) if (x := pairs.get((a << 32) | b))]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= n:
                continue
            found = pairs.get((part[i] << 32) | part[j])
            if found is None or found[0] != r:  # one of the two has been merged since
                continue
            part[i], part[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if x := pairs.get((part[i] << 32) | part[after[i]]):
                    heapq.heappush(heap, (x[0], i))
            if before[i] >= 0 and (x := pairs.get((part[before[i]] << 32) | part[i])):
                heapq.heappush(heap, (x[0], before[i]))
        return np.array([p for p in part if p >= 0], np.int32)


def _cut(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text, cut before single spaces between ASCII letters
    or digits."""
    plain = np.zeros(256, bool)
    plain[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = True
    a = 0
    while a < len(data):
        z, step = a + BLOCK_BYTES, BLOCK_BYTES
        while z < len(data):
            window = data[z:z + step]
            safe = np.flatnonzero((window[1:-1] == 32) & plain[window[:-2]] & plain[window[2:]])
            if len(safe):
                z += int(safe[0]) + 1
                break
            z += step - 2
        yield data[a:z]
        a = min(z, len(data))


def decode_ids(model: BytePairs, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of id lists; ids outside the vocabulary give nothing, and bytes
    that are no UTF-8 are replaced."""
    known = ids < model.size
    ids = np.where(known, ids, 0).astype(np.int64)
    size = np.where(known, model.piece_length[ids], 0)
    upto = np.concatenate([[0], np.cumsum(size)])
    raw = model.piece_bytes[np.repeat(model.piece_start[ids] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
    at = upto[offsets].tolist()
    return [raw[a:z].decode("utf-8", "replace") for a, z in zip(at, at[1:])]


class _Shared:
    """A broadcast model (bounded by the vocabulary) and its encoder in a worker."""

    def __init__(self, df: DataFrame, model: BytePairs) -> None:
        self.broadcast, self.id = df.sparkSession.sparkContext.broadcast(model), id(model)

    def encoder(self) -> Encoder:
        if self.id not in Encoder._of:
            Encoder._of.clear()
            Encoder._of[self.id] = Encoder(self.broadcast.value)
        return Encoder._of[self.id]


def _with_columns(df: DataFrame, source: str, columns: dict[str, str], make: Callable) -> DataFrame:
    """``df`` with the columns that ``make(bytes, offsets)`` gives for a
    block of ``source``; a null there is null in all of them. Columns of
    those names are replaced."""
    kept = [c for c in df.columns if c not in columns]
    hidden = [f"_{i}" for i in range(len(kept))]
    place = df.columns.index(source)
    rows = df.select(*[df[c].alias(h) for c, h in zip(kept, hidden)], df[df.columns[place]].alias("_source"))
    kinds = {"binary": pa.binary(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, "_source"):
            null = np.asarray(part.column("_source").is_null())
            made = [pa.array([None if gone else x for x, gone in zip(values, null)], kinds[k])
                    for values, k in zip(make(data, offsets), columns.values())]
            yield pa.RecordBatch.from_arrays([*(part.column(h) for h in hidden), *made],
                                             names=[*hidden, *(f"_made{i}" for i in range(len(made)))])

    schema = rows.select(*hidden).schema
    for i, kind in enumerate(columns.values()):
        schema = schema.add(f"_made{i}", kind)
    return rows.mapInArrow(run, schema).toDF(*kept, *columns)


def _listed(ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * a:4 * z] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]


def encode(df: DataFrame, text_col: str, model: BytePairs, ids_col: str = "ids") -> DataFrame:
    """Add the ids of every text as a binary column of 32-bit little-endian
    numbers; a null text has null ids, an empty one no ids. A column of that
    name is replaced; other columns, whatever their names, and repeated rows
    are kept. An empty table gives an empty table."""
    shared = _Shared(df, model)
    return _with_columns(df, text_col, {ids_col: "binary"},
                         lambda data, offsets: [_listed(*shared.encoder().encode(data, offsets))])


def decode(df: DataFrame, ids_col: str, model: BytePairs, text_col: str = "decoded") -> DataFrame:
    """Add the text of every row of ids (as ``encode`` makes them): null for
    null; ids outside the vocabulary give nothing, and bytes that are no
    UTF-8 are replaced."""
    shared = _Shared(df, model)
    return _with_columns(df, ids_col, {text_col: "string"}, lambda data, offsets: [decode_ids(
        shared.broadcast.value, np.frombuffer(data[:len(data) // 4 * 4].tobytes(), "<u4"), offsets // 4)])


def encode_and_decode(df: DataFrame, text_col: str, model: BytePairs, ids_col: str = "ids",
                      decoded_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts."""
    shared = _Shared(df, model)

    def make(data: np.ndarray, offsets: np.ndarray) -> list:
        encoder = shared.encoder()
        ids, at = encoder.encode(data, offsets)
        return [_listed(ids, at), decode_ids(encoder.m, ids, at)]

    return _with_columns(df, text_col, {ids_col: "binary", decoded_col: "string"}, make)
