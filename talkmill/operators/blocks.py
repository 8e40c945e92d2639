"""Lookup of list items in a table, block by block.

A join of exploded lists moves every occurrence of every item. Here
consecutive rows are a *block* of about ``BLOCK_ITEMS`` items: the lists are
kept as numbers of the block's distinct items, and only those distinct items are joined with the table, so a word that stands a thousand times in a
block is one row of the join. Rows and found values then meet by block. The
table may be of any size, and a task holds one block at a time (a longer list
is a block of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from talkmill.operators.prefix import materialize

BLOCK_ITEMS = 1 << 21


def _kind(items: int) -> type:
    return np.uint16 if items <= 1 << 16 else np.uint32


def _number(keep: Sequence[str], limit: int):
    """Rows of blocks; the first row of a block has the numbers of all its
    lists and the items they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("_items")).fill_null(0).to_numpy())])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
                yield of_block(block, batch.slice(start, stop - start), at[start:stop + 1] - at[start])
                start, block = stop, block + 1

    def of_block(block: int, rows: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        found = pc.dictionary_encode(rows.column("_items").flatten(), null_encoding="encode")
        indices, items = found.indices.to_numpy(), found.dictionary
        codes = pa.compress(indices.astype(_kind(len(items))).tobytes(), "zstd", asbytes=True)
        first = np.arange(rows.num_rows) == 0
        entries = pa.StructArray.from_arrays([items, pa.array(np.bincount(indices, minlength=len(items)), pa.int64())],
                                             names=["item", "n"])
        lists = pa.ListArray.from_arrays(np.append(0, np.full(rows.num_rows, len(items))).astype(np.int32), entries)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows.num_rows, block)), pa.array(np.arange(rows.num_rows)), pa.array(np.diff(at)),
             *[rows.column(c) for c in keep], pa.array([codes if f else None for f in first], pa.binary()), lists],
            names=["_block", "_row", "_n", *keep, "_codes", "_found"])

    return run


def number_items(df: DataFrame, items: str | Column, keep: Sequence[str], block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The columns ``keep`` of every row of ``df`` with its list ``items``
    (null: empty) as numbers, in blocks; written to the shared folder."""
    keep = list(keep)
    listed = df.select(*keep, (F.col(items) if isinstance(items, str) else items).alias("_items"))
    entry = StructType().add("item", listed.schema["_items"].dataType.elementType).add("n", "long")
    schema = StructType([*StructType.fromDDL("_block long, _row long, _n long"), *[f for f in listed.schema if f.name in keep],
                         *StructType.fromDDL("_codes binary")]).add("_found", ArrayType(entry))
    return materialize(listed.mapInArrow(_number(keep, block_items), schema))


def item_counts(blocks: DataFrame) -> DataFrame:
    """(item, n): how often each item stands in all lists of the blocks."""
    return blocks.select(F.inline("_found")).groupBy("item").agg(F.sum("n").alias("n"))


def look_up(blocks: DataFrame, table: DataFrame, item: str, value: Column,
            use: Callable[[pa.Table, np.ndarray, np.ndarray, pa.Array], list], added: str) -> DataFrame:
    """The kept columns of the rows of ``blocks`` (``number_items``) and those
    that ``use`` makes of their lists.

    Distinct items meet the column ``item`` of ``table`` (one row an item);
    ``value`` is an expression over that table's columns and the item
    (``_item``), where the table's columns are null for an item it lacks.
    ``use(rows, at, codes, values)`` runs in the tasks, once per block, and
    returns the columns of ``added`` (a DDL string): ``values[codes]`` are the
    values of all lists one after the other, ``at`` the offsets of the rows."""
    keep = [f for f in blocks.schema if f.name not in ("_block", "_row", "_n", "_codes", "_found")]
    wanted = blocks.where(F.size("_found") > 0).select("_block", F.posexplode("_found").alias("_pos", "_entry")) \
        .select("_block", "_pos", F.col("_entry.item").alias("_item"))
    found = wanted.join(table, F.col("_item") == F.col(item), "left").select(
        F.col("_block").alias("_of"), "_pos", value.alias("_value"))
    schema = StructType([*keep, *StructType.fromDDL(added)])
    arrow = to_arrow_schema(schema)

    def meet(rows: pa.Table, values: pa.Table) -> pa.Table:
        rows, values, kind = rows.sort_by("_row"), values.sort_by("_pos"), np.dtype(_kind(values.num_rows))
        at = np.concatenate([[0], np.cumsum(rows.column("_n").to_numpy())])
        codes = pa.decompress(rows.column("_codes")[0].as_py(), int(at[-1]) * kind.itemsize, "zstd")
        made = use(rows, at, np.frombuffer(codes, kind), values.column("_value").combine_chunks())
        return pa.Table.from_arrays([*[rows.column(f.name) for f in keep], *made], names=arrow.names).cast(arrow)

    return blocks.drop("_found").groupBy("_block").cogroup(found.groupBy("_of")).applyInArrow(meet, schema)
