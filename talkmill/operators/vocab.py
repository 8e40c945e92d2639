"""Vocabulary, id encoding / decoding and token-list columns
(keys C6, C7, C8, B1, B2).

A vocabulary makes lexer pieces into integer ids: id order is (count
desc, token). Encoding and decoding are joins with the vocabulary on the
distinct pieces of blocks of documents (``operators.blocks``), so a hot piece
(" the") is one row per block, not one per occurrence.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType

from talkmill.functions.text import py_strip, tokenize
from talkmill.operators.blocks import item_counts, look_up, number_items
from talkmill.operators.prefix import global_index


def piece_blocks(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The lexer pieces of ``text``, numbered in blocks. Made once, they serve
    ``build_vocabulary`` and ``encode_ids`` of the same documents."""
    return number_items(df, tokenize(text), keep)


def build_vocabulary(df: DataFrame, text: str = "text", pieces: DataFrame | None = None) -> DataFrame:
    """``(token, id, count)`` over every piece of ``text``, or of
    ``pieces``, what ``piece_blocks`` made of it."""
    if pieces is None:
        counts = df.select(F.explode(tokenize(text)).alias("token")).groupBy("token").agg(
            F.count(F.lit(1)).cast("bigint").alias("count"))
    else:
        counts = item_counts(pieces).select(F.col("item").alias("token"), F.col("n").alias("count"))
    return global_index(counts, [F.col("count").desc(), F.col("token").asc()], "id")


UNKNOWN_ID = -1


def encode_ids(df: DataFrame, vocab: DataFrame, key: str, text: str = "text", keep: Sequence[str] = (),
               pieces: DataFrame | None = None) -> DataFrame:
    """Text -> ``ids ARRAY<BIGINT>`` in token order, row by row, with the
    columns ``key`` and ``keep`` (those of ``pieces``, where ``piece_blocks``
    has already been applied). Pieces outside the vocabulary become
    ``UNKNOWN_ID``; a document without pieces keeps an empty list. Only the
    distinct pieces of a block of documents meet the vocabulary."""
    v = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_vid"))
    if pieces is None:
        pieces = piece_blocks(df, text, [key, *keep])

    def listed(rows: pa.Table, at: np.ndarray, codes: np.ndarray, ids: pa.Array) -> list:
        return [pa.ListArray.from_arrays(at.astype(np.int32), ids.take(pa.array(codes)))]

    return look_up(pieces, v, "_tok", F.coalesce("_vid", F.lit(UNKNOWN_ID)).cast("bigint"), listed, "ids array<bigint>")


def decode_ids(df: DataFrame, vocab: DataFrame, key: str, ids: str = "ids", keep: Sequence[str] = ()) -> DataFrame:
    """Id list -> text (the pieces joined; lossless for known ids), row by
    row, with the columns ``key`` and ``keep``. An id outside the vocabulary
    raises; a document without ids has empty text."""
    v = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_vid"))
    piece = F.coalesce("_tok", F.raise_error(F.concat(
        F.lit("id is not in the vocabulary: "), F.coalesce(F.col("_item").cast("string"), F.lit("null")))).cast("string"))

    def joined(rows: pa.Table, at: np.ndarray, codes: np.ndarray, pieces: pa.Array) -> list:
        lists = pa.ListArray.from_arrays(at.astype(np.int32), pieces.take(pa.array(codes)))
        return [pc.binary_join(lists, "")]

    return look_up(number_items(df, ids, [key, *keep]), v, "_vid", piece, joined, "text string")


def normalize_tokens(col: str | Column) -> Column:
    """B2: a non-empty list whose every item casts to an integer (Python
    ``int`` semantics: floats truncate) -> ``ARRAY<BIGINT>``; else null."""
    c = F.col(col) if isinstance(col, str) else col
    as_int = F.transform(c, lambda x: x.try_cast("bigint"))
    ok = (F.size(c) > 0) & ~F.exists(c, lambda x: x.try_cast("bigint").isNull())
    return F.when(ok, as_int)


def token_candidates(df: DataFrame, token_columns: Sequence[str] = ("tokens", "input_ids")
                     ) -> list[str]:
    """B1 schema step: configured names first (in order), then every other
    list column whose lower-cased name contains ``token`` or ``id``."""
    lists = {f.name: f for f in df.schema.fields if isinstance(f.dataType, ArrayType)
             and isinstance(f.dataType.elementType, (NumericType, StringType))}
    first = [c for c in token_columns if c in lists]
    rest = [n for n in lists if n not in first and ("token" in n.lower() or "id" in n.lower())]
    return first + rest


def pick_token_column(df: DataFrame, token_columns: Sequence[str] = ("tokens", "input_ids"),
                      text_column: str | None = "text") -> DataFrame:
    """B1: per row, the first usable token list (``token_source`` names the
    column, ``token_ids`` holds it); else the text when it is not blank."""
    cands = token_candidates(df, token_columns)
    ids = F.lit(None).cast("array<bigint>")
    src = F.lit(None).cast("string")
    for c in reversed(cands):
        norm = normalize_tokens(c)
        ids = F.when(norm.isNotNull(), norm).otherwise(ids)
        src = F.when(norm.isNotNull(), F.lit(c)).otherwise(src)
    out = df.withColumn("token_ids", ids).withColumn("token_source", src)
    if text_column and text_column in df.columns:
        usable = F.col("token_ids").isNull() & (py_strip(F.col(text_column)) != "")
        out = out.withColumn("token_source", F.when(usable, F.lit(text_column))
                             .otherwise(F.col("token_source")))
    return out
