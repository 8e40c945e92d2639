"""Language identification by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes that cover it whole. Each byte
(A-Z as a-z) has an embedding; filters of several widths slide over a window,
each keeps its maximum, and a softmax layer over the tanh of the maxima gives
the window's language. A text's language is that of the mean window
log-probability, weighted by the bytes of the windows.

The filters are fitted in numpy on a sample of labelled rows bounded by
``TRAIN_DOCS`` documents a language and ``TRAIN_WINDOWS`` windows a document.
Prediction sees nothing but the text. A filter's response is a sum of table
entries, one per byte, so a window costs lookups and maxima only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import sliced, written

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
TRAIN_DOCS = 400
TRAIN_WINDOWS = 8
EPOCHS = 8
#: Training documents of all languages together, shared evenly where the
#: languages are many; each has one at least.
SAMPLE_DOCS = 100_000
WINDOWS_AT_ONCE = 512
#: Sums of a text and language that are held at once.
SUMS_AT_ONCE = 1 << 22
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, bytes, text number) of the windows of the texts."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = offsets[:-1][text] + number * WINDOW
    return first, np.minimum(WINDOW, offsets[1:][text] - first), text


def window_bytes(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Window contents as columns of a (WINDOW, n) matrix, padded with 0."""
    at = np.arange(WINDOW)[:, None]
    index = np.minimum(first[None, :] + at, max(len(data) - 1, 0))
    return np.where(at < sizes[None, :], _FOLD[data[index]], np.uint8(0))


class Network:
    """Parameters and passes of the byte convolutional network."""

    def __init__(self, languages: list[str], seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages)))
        self.p["bias"] = np.zeros(len(languages))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self._tables: dict = {}

    def tables(self) -> dict:
        """Response of each filter tap to each byte."""
        return {w: np.einsum("be,wef->wbf", self.p["emb"], self.p[f"f{w}"]).astype(np.float32) for w in WIDTHS}

    def responses(self, x: np.ndarray, tables: dict, w: int) -> np.ndarray:
        n = WINDOW - w + 1
        out = np.take(tables[w][0], x[:n], axis=0)
        for k in range(1, w):
            out += np.take(tables[w][k], x[k:n + k], axis=0)
        return out

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        if not self._tables:
            self._tables = self.tables()
        top = [self.responses(x, self._tables, w).max(axis=0) + self.p[f"b{w}"] for w in WIDTHS]
        z = np.tanh(np.concatenate(top, axis=1)) @ self.p["out"] + self.p["bias"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the mean cross-entropy of a batch of windows."""
        tables, n, g = self.tables(), x.shape[1], {k: np.zeros_like(v) for k, v in self.p.items()}
        where, top = {}, []
        for w in WIDTHS:
            r = self.responses(x, tables, w)
            where[w] = r.argmax(axis=0)
            top.append(np.take_along_axis(r, where[w][None], axis=0)[0] + self.p[f"b{w}"])
        h = np.tanh(np.concatenate(top, axis=1))
        z = h @ self.p["out"] + self.p["bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        g["out"], g["bias"] = h.T @ z, z.sum(axis=0)
        back = (z @ self.p["out"].T) * (1 - h * h)
        for i, w in enumerate(WIDTHS):
            d = back[:, i * FILTERS:(i + 1) * FILTERS]
            g[f"b{w}"] = d.sum(axis=0)
            for k in range(w):
                b = x[where[w] + k, np.arange(n)[:, None]]  # the byte under this tap, per window and filter
                g[f"f{w}"][k] = np.einsum("nfe,nf->ef", self.p["emb"][b], d)
                np.add.at(g["emb"], b, d[:, :, None] * self.p[f"f{w}"][k].T[None])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 4e-3) -> None:
        """Adam over shuffled batches; x is (WINDOW, n)."""
        rng = np.random.default_rng(1)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, max(1, epochs * -(-len(y) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                rows = order[at:at + batch]
                step += 1
                lr = rate * (1 - step / (total + 1))
                for k, g in self.gradients(x[:, rows], y[rows]).items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.01 * (g * g - s[k])
                    self.p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
        self._tables = {}


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
          train_docs: int = TRAIN_DOCS, train_windows: int = TRAIN_WINDOWS,
          sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Fit a network on a sample of rows with a text and a language: up to
    ``train_docs`` documents a language, drawn by a hash of the id (fewer, but
    at least one, where all languages together would pass ``sample_docs``),
    and ``train_windows`` evenly spaced windows of each. Any number of
    languages is learnt. None without such rows."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = sorted(r["lang"] for r in counts.select("lang").collect())  # the outputs of the network
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    train_docs = min(train_docs, max(1, sample_docs // len(languages)))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language sample"), "id"), 11) / F.lit(float(1 << 53))
    drawn = rows.join(counts, "lang").withColumn("draw", draw).where(F.col("draw") * F.col("n") < 2.0 * train_docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches):
            first, sizes, text = windows(data, offsets)
            out = []
            for i, (lang, d, key) in enumerate(zip(*(part.column(c).to_pylist() for c in ("lang", "draw", "id")))):
                own = np.flatnonzero(text == i)
                for j in own[np.unique(np.linspace(0, len(own) - 1, train_windows).astype(int))] if len(own) else ():
                    out.append((lang, d, key, int(j - own[0]), data[first[j]:first[j] + sizes[j]].tobytes()))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.string(), pa.int32(), pa.binary()))],
                names=["lang", "draw", "id", "number", "bytes"])

    got = sorted(tuple(r) for r in drawn.select("text", "lang", "draw", "id").mapInArrow(
        cut, "lang string, draw double, id string, number int, bytes binary").collect())
    x, y, seen = [], [], {}
    for lang, d, key, _, data in got:
        docs = seen.setdefault(lang, {})
        if docs.setdefault((d, key), len(docs)) < train_docs:
            x.append(np.frombuffer(bytes(data).ljust(WINDOW, b"\0"), np.uint8))
            y.append(number[lang])
    network = Network(languages)
    if x:
        network.fit(_FOLD[np.array(x).T], np.array(y))
    return network


def predict(docs: DataFrame, network: Network | None, text_col: str) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (mean probability of that language,
    0 to 1) to every row. A text that is null or has no letter, and any text
    without a trained network, is ``und`` with score 0. Columns named
    lang_pred or score are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, text_col):
            lang, score = _classify(network, data, offsets, part.column(text_col))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(run, schema)


def with_letters(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows whose text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, text_col):
            yield part.filter(pa.array(_has_letter(data, offsets, part.column(text_col))))

    return docs.mapInArrow(run, docs.schema)


def _has_letter(data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    folded = _FOLD[data]
    seen = np.concatenate([[0], np.cumsum((folded >= 97) & (folded <= 122))])
    plain = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~plain & (np.diff(offsets) > 0)):
        plain[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return plain


def _classify(network: Network | None, data: np.ndarray, offsets: np.ndarray,
              texts: pa.Array) -> tuple[list[str], np.ndarray]:
    n = len(offsets) - 1
    letters = _has_letter(data, offsets, texts)
    if network is None:
        return [UNDETERMINED] * n, np.zeros(n)
    best, score = np.zeros(n, np.int64), np.zeros(n)
    first, sizes, text = windows(data, offsets)
    rows = max(1, SUMS_AT_ONCE // len(network.languages))
    step = max(1, min(WINDOWS_AT_ONCE, rows))
    for low in range(0, n, rows):
        high = min(n, low + rows)
        total = np.zeros((high - low, len(network.languages)))
        begin, end = np.searchsorted(text, [low, high])
        for at in range(begin, end, step):
            part = slice(at, min(at + step, end))
            logs = network.log_probabilities(window_bytes(data, first[part], sizes[part]))
            np.add.at(total, text[part] - low, logs * sizes[part, None])
        mean = np.exp(total / np.maximum(1, np.diff(offsets[low:high + 1]))[:, None])
        mean /= mean.sum(axis=1, keepdims=True)
        best[low:high] = mean.argmax(axis=1)
        score[low:high] = mean.max(axis=1)
    return ([network.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)],
            np.where(letters, score, 0.0))
