"""Corpus pipeline: language ID, near-dedup, repeat removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it to the shared folder and reads it again for the next stage. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import langid
from talkmill.llm.common import among, not_among, written
from talkmill.llm.minhash import near_duplicates
from talkmill.llm.packing import pack
from talkmill.llm.queries import vocabulary
from talkmill.llm.repeats import remove_repeats
from talkmill.session import release_tables, tables_written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with a letter, in its own language or, where it has
    none, in the one that the labelled documents teach (without labelled ones
    it stays null); those without a text or a letter go."""
    network = langid.train(docs, "doc_id", "text", "lang")
    hidden = [f"_{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, hidden))
    named = docs.select(*[F.col(c).alias(h) for c, h in own.items()])  # the text goes to Python once
    if network is None:
        return langid.with_letters(named, own["text"]).toDF(*docs.columns)
    found = langid.predict(named, network, own["text"]).where(F.col("score") > 0)  # 0: no letter
    lang = F.coalesce(F.col(own["lang"]), F.col("lang_pred"))
    return found.select(*[(lang if c == "lang" else F.col(h)).alias(c) for c, h in own.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of similarity 0.8 or more. Rows
    that repeat an id are one document, of which one row stays."""
    first = tables_written()
    groups = near_duplicates(docs, "doc_id", "text", percent=80)
    last = tables_written()
    found = written(groups, "pipeline-groups")
    release_tables(spark, first, last)
    gone = written(found.where(~F.col("kept")).select("doc_id").distinct(), "pipeline-gone")
    left = not_among(docs, gone, "doc_id")
    repeated = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
                       .select("doc_id"), "pipeline-repeated")
    if repeated.isEmpty():
        return left
    once = among(left, repeated, "doc_id").dropDuplicates(["doc_id"])
    return not_among(left, repeated, "doc_id").union(once)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that an earlier document, or an
    earlier place, already holds; n_chars follows the text."""
    out = remove_repeats(docs, "doc_id", "text", length=100, whole_characters=True,
                         keep=tuple(c for c in docs.columns if c != "text"))
    text = F.col("kept").cast("string")
    own = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast("long"))
           .otherwise(F.col("row.n_chars"))}
    return out.select(*[own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 1024-token sequences with their ids, every window at the
    sources' shares of the tokens."""
    return pack(docs, "doc_id", "text", "source", vocabulary("byte_bpe_50k.json"), end_id=0, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("repeat_removal", remove_repeated_passages),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
