"""Tables the registered queries start from.

Every table here is read from the given parquet files or derived from
them by Spark, so its size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.plans.generation import GenerationConfig, dry_run_table
from talkmill.sources.corpus import scan_corpus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with its (file, row) position columns."""
    return scan_corpus(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def documents_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/documents.parquet"


CARRY = ("doc_id", "lang", "source")


def dialogue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry-run chunk x style rows over ``documents`` (all statuses), with
    the document key, language and source carried along."""
    cfg = GenerationConfig(carry=CARRY)
    return dry_run_table(spark, documents_path(sf_dir), cfg)


def kept_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_table(spark, sf_dir).where(F.col("status") == "kept")


def attempt_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as a model-call ledger: each run of four consecutive
    event ids is one request's attempts 1-4; an ``error`` event is a failed
    call, a ``view`` event returned an empty reply, the rest returned the
    event's ``props`` text."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("req-"), F.floor(F.col("event_id") / 4).cast("string")).alias("request_id"),
        (F.col("event_id") % 4 + 1).cast("int").alias("attempt"),
        (F.col("event_type") != F.lit("error")).alias("ok"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(F.col("event_type") == "view", F.lit("  "))
        .otherwise(F.col("props")).alias("reply"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("call failed at event "), F.col("event_id").cast("string")))
        .alias("error"))


METRICS = ("accuracy", "coherence", "faithfulness", "fluency")


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as judge scores: conversation = user, metric cycles
    through four metrics by event id, rater = event type, score 1-5 from
    the event value."""
    e = table(spark, sf_dir, "events")
    metric = F.element_at(F.array(*[F.lit(m) for m in METRICS]),
                          (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(
        F.concat(F.lit("conv-"), F.col("user_id").cast("string")).alias("conv_key"),
        F.col("event_type").alias("rater"),
        metric.alias("metric"),
        (F.floor(F.col("value")).cast("bigint") % 5 + 1).cast("int").alias("score"))
