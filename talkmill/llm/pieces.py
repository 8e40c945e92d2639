"""SentencePiece encoding and decoding as a streaming Viterbi search.

Every place of a text has one surviving best path, known by its last piece
and a back pointer. A place only looks back as far as the longest piece, so
the paths that can still matter are those of the last few places; wherever
they all run through one boundary, the ids before it are committed and
forgotten, and no more than the open stretch is kept in memory.

Which last piece survives depends on the kind of model. In a unigram model
it is the one with the largest sum of scores. In a BPE model the library's
result is not the largest sum (merges are made in order of score), but it
has the same shape: the merge result of every prefix ends in exactly one
piece, namely the one that its neighbour on the path admits, i.e. no merge
across their border would have been made before the merges inside them. So
the same search, with that rule in place of the sum, gives the library's ids.

A piece can hold the space mark only at its start (checked), so all paths
run through every space: words are searched apart, and the results of short
ones are kept in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkmill.llm.common import sliced

MARK = "▁"
CACHE = 500_000
LONGEST_CACHED = 40
#: Places after which a search looks for a boundary to commit at.
COMMIT_EVERY = 64


class PieceModel:
    """Pieces of a SentencePiece model file with byte fallback, an identity
    normaliser and a dummy prefix (checked on loading)."""

    def __init__(self, path: str, unigram: bool = False) -> None:
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        if sp.normalize("a  ﬁ") != f"{MARK}a{MARK}{MARK}ﬁ" or sp.decode(sp.encode("͸")) != "͸":
            raise ValueError("only models with an identity normaliser, a dummy prefix and byte fallback")
        self.unigram = unigram
        n = sp.get_piece_size()
        self.byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i) for i in plain}
        #: The bytes of each id, with the mark as a space.
        self.bytes = [text[i].replace(MARK, " ").encode() if i in text else b"" for i in range(n)]
        for b, i in self.byte_ids.items():
            self.bytes[i] = bytes([b])
        runs = {i: p for i, p in text.items() if len(p) > 1 and set(p) == {MARK}}
        if any(MARK in p[1:] for i, p in text.items() if i not in runs):
            raise ValueError("a piece holds the space mark after its start")
        self.run_ids = {len(p): i for i, p in runs.items()}
        self.mark_id = next(i for i, p in text.items() if p == MARK)
        words = {i: p for i, p in text.items() if i not in runs}
        single = [i for i, p in words.items() if len(p) == 1]
        several = sorted((i for i, p in words.items() if len(p) > 1), key=lambda i: (-sp.get_score(i), i))
        #: Ranks: single characters first, then pieces in order of merging.
        self.ids = [*single, *several]
        self.rank = {words[i]: r for r, i in enumerate(self.ids)}
        self.piece = [words[i] for i in self.ids]
        self.score = [sp.get_score(i) for i in self.ids]
        self.n_single = len(single)
        self.longest = max(map(len, self.piece))
        self.parts = [(r, r) for r in range(len(self.ids))]
        if not unigram:
            dead = [r for r in range(self.n_single, len(self.ids)) if not self._set_parts(r)]
            for r in dead:  # merging never arrives at these
                del self.rank[self.piece[r]]
        #: Rank of every ending of a piece that is a piece itself, else -1: a
        #: look back stops at what ends no piece.
        self.endings = {p[k:]: -1 for p in self.rank for k in range(len(p))} | self.rank

    def _set_parts(self, r: int) -> bool:
        """The two pieces of the last merge that makes piece ``r``."""
        at = list(self.piece[r])
        while len(at) > 2:
            best = min(((self.rank.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(at, at[1:]))))
            if best[0] >= r:
                return False
            k = best[1]
            at[k:k + 2] = [at[k] + at[k + 1]]
        if len(at) < 2 or any(p not in self.rank for p in at):
            return False
        self.parts[r] = (self.rank[at[0]], self.rank[at[1]])
        return True


class Encoder:
    """Encodes texts with a PieceModel; holds the caches of a worker."""

    _of: dict[int, "Encoder"] = {}

    def __init__(self, model: PieceModel) -> None:
        self.m = model
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.borders: dict[int, bool] = {}

    def _admits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a: undoing their merges from the
        last one on, no merge across the border comes before one undone."""
        rank, piece, parts, n_single = self.m.rank, self.m.piece, self.m.parts, self.m.n_single
        limit = 1 << 60
        while True:
            across = rank.get(piece[a] + piece[b])
            if across is not None and across < limit:
                return False
            if a < n_single and b < n_single:
                return True
            # equal merges are made from the left
            if a > b:
                limit, a = a, parts[a][1]
            else:
                limit, b = b + 1, parts[b][0]

    def search(self, text: str) -> list[int]:
        """Ids of a stretch in which words and their marks are whole."""
        m, borders = self.m, self.borders
        get, unigram, n_ids = m.endings.get, m.unigram, len(m.ids)
        if len(borders) > 4 * CACHE:
            borders.clear()
        out: list[int] = []
        base, last, back, total = 0, [-1], [0], [0.0]  # of the places from ``base`` on
        for i in range(1, len(text) + 1):
            found, origin, best, pieces = None, i - 1, 0.0, []
            for j in range(i - 1, base - 1, -1):
                r = get(text[j:i])
                if r is None:
                    break
                if r >= 0:
                    pieces.append((r, j))
            if unigram:
                for r, j in pieces:
                    if found is None or total[j - base] + m.score[r] >= best:
                        found, origin, best = r, j, total[j - base] + m.score[r]
            else:
                for r, j in reversed(pieces):  # longest first; one at most is admitted
                    p = last[j - base]
                    if p >= 0:
                        admitted = borders.get(p * n_ids + r)
                        if admitted is None:
                            admitted = borders[p * n_ids + r] = self._admits(p, r)
                        if not admitted:
                            continue
                    found, origin = r, j
                    break
            if found is None:  # a character without a piece stands for its bytes
                found, best = -1 - ord(text[i - 1]), total[-1] - 1e6
            last.append(found)
            back.append(origin)
            total.append(best)
            if i % COMMIT_EVERY == 0:
                live = set(range(max(base, i + 1 - m.longest), i + 1))
                while len(live) > 1:  # step the rightmost path back until one boundary is left
                    top = max(live)
                    live.remove(top)
                    live.add(back[top - base])
                meet = live.pop()
                if meet > base:
                    self._commit(out, last, back, base, meet)
                    last, back, total = last[meet - base:], back[meet - base:], total[meet - base:]
                    back[0], base = meet, meet
        self._commit(out, last, back, base, len(text))
        return out

    def _commit(self, out: list[int], last: list[int], back: list[int], base: int, stop: int) -> None:
        path = []
        while stop > base:
            path.append(last[stop - base])
            stop = back[stop - base]
        for r in reversed(path):
            if r >= 0:
                out.append(self.m.ids[r])
            else:
                out += [self.m.byte_ids[b] for b in chr(-1 - r).encode()]

    def _run(self, n: int) -> list[int]:
        """Ids of n marks. Their merges all have the same score, so the
        leftmost one possible is made each time."""
        runs, sizes = self.m.run_ids, []
        while True:
            if len(sizes) > 1 and sizes[-2] + sizes[-1] in runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
            elif n and sizes and sizes[-1] + 1 in runs:
                sizes[-1] += 1
                n -= 1
            elif n:
                sizes.append(1)
                n -= 1
            else:
                return [runs[k] if k > 1 else self.m.mark_id for k in sizes]

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit little-endian numbers."""
        if not text:
            return b""
        words = self.words
        parts = text.replace(MARK, " ").split(" ")
        out, gap = [], 0
        for w in parts:
            if not w:
                gap += 1
                continue
            ids = words.get(w)
            if ids is None:
                ids = self.older.get(w)
                if ids is None:
                    ids = np.array(self.search(MARK + w), "<u4").tobytes()
                if len(w) <= LONGEST_CACHED:
                    if len(words) >= CACHE:  # words not met again before the next time are forgotten
                        self.older, self.words = words, {}
                        words = self.words
                    words[w] = ids
            if gap:  # a mark that the word leaves alone belongs to the run
                alone = ids[:4] == self.m.mark_id.to_bytes(4, "little")
                out.append(np.array(self._run(gap + alone), "<u4").tobytes())
                ids, gap = ids[4:] if alone else ids, 0
            out.append(ids)
        if gap:
            out.append(np.array(self._run(gap), "<u4").tobytes())
        return b"".join(out)


def _encoder(shared) -> Encoder:
    if shared.id not in Encoder._of:
        Encoder._of.clear()
        Encoder._of[shared.id] = Encoder(shared.value)
    return Encoder._of[shared.id]


class _Shared:
    """A broadcast model (bounded by the vocabulary) with a name."""

    def __init__(self, df: DataFrame, model: PieceModel) -> None:
        self.broadcast, self.id = df.sparkSession.sparkContext.broadcast(model), id(model)

    @property
    def value(self) -> PieceModel:
        return self.broadcast.value


def _with_column(df: DataFrame, name: str, kind: str, arrow: pa.DataType, source: str, make) -> DataFrame:
    kept = [c for c in df.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, source):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(make(part.column(source), data, offsets), arrow)],
                names=[*kept, name])

    return df.mapInArrow(run, df.select(*kept).schema.add(name, kind))


def encode(df: DataFrame, text_col: str, model: PieceModel, ids_col: str = "ids") -> DataFrame:
    """Add the ids of every text as a binary column of 32-bit little-endian
    numbers; a null text has null ids, an empty one no ids. A column of that
    name is replaced; other columns and repeated rows are kept."""
    shared = _Shared(df, model)

    def make(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list:
        encoder = _encoder(shared)
        return [None if t is None else encoder.encode(t) for t in texts.to_pylist()]

    return _with_column(df, ids_col, "binary", pa.binary(), text_col, make)


def decode(df: DataFrame, ids_col: str, model: PieceModel, text_col: str = "decoded") -> DataFrame:
    """Add the text of every row of ids (as ``encode`` makes them): null for
    null, bytes that are no UTF-8 replaced, the dummy prefix taken off."""
    shared = _Shared(df, model)

    def make(ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list:
        pieces = shared.value.bytes
        sizes = np.array([len(p) for p in pieces])
        begin = np.cumsum(sizes) - sizes
        all_ = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(sizes[all_])])
        raw = np.frombuffer(b"".join(pieces), np.uint8)[
            np.repeat(begin[all_] - upto[:-1], sizes[all_]) + np.arange(upto[-1])].tobytes()
        at = upto[offsets // 4]
        none = np.asarray(ids.is_null())
        return [None if gone else raw[a + (raw[a:a + 1] == b" "):z].decode("utf-8", "replace")
                for a, z, gone in zip(at[:-1].tolist(), at[1:].tolist(), none)]

    return _with_column(df, text_col, "string", pa.string(), ids_col, make)
