"""Shared pieces of the training-data operators: written tables in the
shared folder and vectorised views of Arrow text batches.

Every vectorised helper works on *blocks*: consecutive rows whose texts add
up to about ``limit`` bytes (one longer text is a block of its own), so the
memory of a task is bounded by the block size plus the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.session import new_path

BLOCK_BYTES = 2 << 20
#: Bits of a table of ids for each id, and of the whole table at most.
ID_BITS, MOST_BITS = 16, 1 << 26
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MASK64 = (1 << 64) - 1


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names;
    ``session.release_tables`` deletes it after a job."""
    return new_path(spark, name)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files: the
    lineage is cut, a lost executor costs no recomputation, and the shuffle
    files that led there are deleted when the write ends."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id written as text (the contracts' fold number)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def _perhaps(rows: DataFrame, ids: DataFrame, col: str) -> tuple[DataFrame, Column]:
    """``rows`` with the column ``_bits``, and whether a row's id may be among
    ``ids``: no id of ``ids`` is missed, and about one in ID_BITS of the others
    passes too. Only bits go to the tasks (MOST_BITS in all; with more ids
    than they are made for, more of the others pass)."""
    n = max(1, -(-min(MOST_BITS, ID_BITS * ids.count()) // 32768)) * 32768
    place = F.pmod(F.xxhash64(F.col(col).cast(ids.schema[col].dataType)), F.lit(n))
    part, bit = F.shiftright(place, 15), F.pmod(place, F.lit(32768))
    bits = ids.select(part.alias("_part"), bit.alias("_bit")).groupBy("_part").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (bit % 8).cast("int")) == 1
    return rows.join(F.broadcast(bits), part == F.col("_part"), "left").drop("_part"), F.coalesce(hit, F.lit(False))


def among(rows: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` is one of ``ids`` (a written table with that
    column). Of the other rows few are shuffled, however many ids there are."""
    marked, hit = _perhaps(rows, ids, col)
    return marked.where(hit).drop("_bits").join(ids, col, "left_semi").select(*rows.columns)


def not_among(rows: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` is null or none of ``ids`` (a written table with
    that column). Those that stay are not shuffled but for a few."""
    marked, hit = _perhaps(rows, ids, col)
    left = marked.where(hit).drop("_bits").join(ids, col, "left_anti")
    return marked.where(~hit).select(*rows.columns).union(left.select(*rows.columns))


def utf8(col: str = "text") -> Column:
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into blocks of whole rows: (rows, bytes, offsets). At the
    end of the task its Python worker gives unused memory back, since it may
    wait idle beside the workers of later stages."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(n, max(start + 1, stop))
            yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                   offsets[start:stop + 1] - offsets[start])
            start = stop
    release_memory()


def release_memory() -> None:
    """Forget the powers and return freed memory to the system."""
    POWERS.forget()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on
    demand: hashes of any substring from one prefix sum."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base, inverse = np.full(n, self.BASE, np.uint64), np.full(
                n, pow(self.BASE, -1, 1 << 64), np.uint64)
            base[0] = inverse[0] = 1
            self.up, self.down = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
        return self.up, self.down


POWERS = Powers()
try:  # glibc only
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):
    _LIBC = None
#: Random 64-bit value of each byte; the folded one treats A-Z as a-z.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 64, 256, dtype=np.uint64)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """s with hash(data[a:b]) = (s[b] - s[a]) * base**-a."""
    up, _ = POWERS.get(len(data) + 1)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=s[1:])
    return s


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` of the
    texts in a block, in order, and the word offsets of the texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first = np.ones(n + 1, bool)  # a word may start here: text start or a space before
    first[1:] = False
    first[1:n] = ~inside[:-1]
    first[offsets[offsets < n]] = True
    starts = np.flatnonzero(inside & first[:n])
    last = np.ones(n, bool)
    last[:-1] = ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    last[cut - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    s = prefix_sums(data, FOLDED_VALUES)
    _, down = POWERS.get(n + 1)
    h = (s[ends] - s[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    return mix64(h), np.searchsorted(starts, offsets)
