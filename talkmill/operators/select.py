"""Selection and assembly of generated dialogues (keys G1, G6, H1-H4)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions.hashing import hash_order

CONTEXT_KEY = ("sample_index", "chunk_index")


def longest_conversation(df: DataFrame, tokens: str = "conversation_tokens",
                         key: Sequence[str] = CONTEXT_KEY, tie: str = "prompt_ord") -> DataFrame:
    """G1: per context keep the dialogue with the most tokens; ties go to
    the lowest ``prompt_ord``. A window partition holds one context's
    styles (at most the number of styles), and Spark plans it as a group
    limit, so no group grows with the data."""
    w = Window.partitionBy(*key).orderBy(F.col(tokens).desc(), F.col(tie).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def all_conversations(tables: Sequence[DataFrame]) -> DataFrame:
    """H1: union of per-style (or per-run) tables by column name."""
    if not tables:
        raise ValueError("at least one table is needed")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def concat_context(df: DataFrame, key: Sequence[str] = CONTEXT_KEY,
                   order: str = "prompt_ord", text: str = "conversation",
                   context: str = "context", sep: str = "\n\n") -> DataFrame:
    """H2: raw context followed by its dialogues in style order.

    Groups are one context's styles (bounded by the style count); the
    context itself is taken once per group."""
    g = df.groupBy(*key).agg(
        F.any_value(context).alias("_ctx"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
        .alias("_parts"),
        F.count(F.lit(1)).cast("bigint").alias("n_dialogues"))
    joined = F.array_join(F.transform("_parts", lambda x: x["t"]), sep)
    return g.select(*key, F.concat(F.col("_ctx"), F.lit(sep), joined).alias("text"),
                    "n_dialogues")


def combine_corpora(a: DataFrame, b: DataFrame, style: str,
                    style_col: str = "prompt_style") -> DataFrame:
    """H3: every style except ``style`` from corpus A plus ``style`` from B."""
    return (a.where(F.col(style_col) != F.lit(style)).withColumn("origin", F.lit("a"))
            .unionByName(b.where(F.col(style_col) == F.lit(style)).withColumn("origin", F.lit("b"))))


def training_mix(synthetic: DataFrame, raw: DataFrame, text_s: str = "conversation",
                 text_r: str = "text", key_s: Column | None = None,
                 key_r: Column | None = None) -> DataFrame:
    """H4: D = S' u R_pt as one ``(origin, doc_key, text)`` table."""
    s = synthetic.select(F.lit("synthetic").alias("origin"),
                         (key_s if key_s is not None else F.lit(None)).cast("string").alias("doc_key"),
                         F.col(text_s).alias("text"))
    r = raw.select(F.lit("raw").alias("origin"),
                   (key_r if key_r is not None else F.lit(None)).cast("string").alias("doc_key"),
                   F.col(text_r).alias("text"))
    return s.unionByName(r)


def sample_k(df: DataFrame, k: int, key: str, seed: int | str = 0) -> DataFrame:
    """``k`` pseudo-random rows: order by md5(seed:key), key; keep k.
    Spark runs this as a per-task top-k then one merge of k rows per task."""
    if k < 0:
        raise ValueError("k must be non-negative")
    return (df.withColumn("_h", hash_order(seed, key))
            .orderBy("_h", key).limit(k).drop("_h"))
