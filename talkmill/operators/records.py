"""Reply filtering, output records, request/reply matching and run
statistics (keys B3, B4, B6, B9, D2, D3, D4, F1)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions.text import count_tokens, py_strip

RECORD_COLUMNS = ("sample_index", "chunk_index", "prompt_style", "context", "conversation",
                  "created_at")


def utc_now_iso() -> Column:
    """Current time as ISO-8601 UTC with microseconds and ``+00:00``,
    whatever the session time zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def min_token_filter(min_tokens: int = 50, col: str = "conversation_tokens") -> tuple[str, Column]:
    """Accept when the reply has at least ``min_tokens`` tokens."""
    return ("min_tokens", F.col(col) >= F.lit(min_tokens))


def filter_chain(df: DataFrame, predicates: Sequence[tuple[str, Column]]) -> DataFrame:
    """AND of named predicates; ``rejected_by`` names the first that
    failed (null when the row is accepted)."""
    rejected = F.lit(None).cast("string")
    for name, pred in reversed(list(predicates)):
        rejected = F.when(~F.coalesce(pred, F.lit(False)), F.lit(name)).otherwise(rejected)
    return df.withColumn("rejected_by", rejected)


def classify_replies(df: DataFrame, reply_col: str = "conversation", min_tokens: int = 50,
                     extra: Sequence[tuple[str, Column]] = (),
                     tokens: Column | None = None) -> DataFrame:
    """B6 + B3 + B4: ``status`` in (failed, empty, filtered, kept).

    A reply that is null or only whitespace is ``empty`` (B6); a failed
    call keeps its ``failed`` status (E5); otherwise the filter chain
    decides between ``kept`` and ``filtered``. ``tokens`` may supply the
    reply's token count when the caller already knows it."""
    stripped = py_strip(F.col(reply_col))
    n_tok = tokens if tokens is not None else count_tokens(F.col(reply_col))
    out = df.withColumn("conversation_tokens", n_tok.cast("int"))
    out = filter_chain(out, [min_token_filter(min_tokens)] + list(extra))
    lost = F.col("status").isin("failed", "missing") if "status" in df.columns else F.lit(False)
    status = (F.when(lost, F.col("status") if "status" in df.columns else F.lit("failed"))
              .when(F.col(reply_col).isNull() | (stripped == F.lit("")), F.lit("empty"))
              .when(F.col("rejected_by").isNotNull(), F.lit("filtered"))
              .otherwise(F.lit("kept")))
    return out.withColumn("status", status)


def conversation_record(df: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The six-column output record. ``context`` is the un-stripped
    window; ``created_at`` is an ISO-8601 UTC string with microseconds
    (one value per query / micro-batch)."""
    stamp = created_at if created_at is not None else utc_now_iso()
    return df.select(F.col("sample_index").cast("bigint"), F.col("chunk_index").cast("int"),
                     "prompt_style", "context", "conversation", stamp.alias("created_at"))


def attach_replies(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Every request with its reply; no reply -> status ``missing``."""
    r = replies.select("request_id", F.col("reply").alias("conversation"),
                       F.col("status").alias("_rs"), "attempts", "error")
    out = requests.join(r, on="request_id", how="left")
    return out.withColumn("status", F.coalesce(F.col("_rs"), F.lit("missing"))).drop("_rs")


def pair_context(conversations: DataFrame, chunks: DataFrame,
                 keys: Sequence[str] = ("sample_index", "chunk_index"),
                 cols: Sequence[str] = ("context",)) -> DataFrame:
    """D3: attach the raw context (or other chunk columns) to each dialogue
    by equi-join on the context key. Both sides are hash-partitioned on the
    key; a context has at most one row per style, so no key is hot."""
    return conversations.join(chunks.select(*keys, *cols), on=list(keys), how="inner")


def pending_only(requests: DataFrame, done: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests whose key is not in ``done`` (an earlier run's answers)."""
    return requests.join(done.select(key), on=key, how="left_anti")


def best_replies(replies: DataFrame, key: str = "request_id") -> DataFrame:
    """One row per request from the replies of several runs: an answer wins
    over an empty one, that over a failure; then the fewest attempts."""
    rank = F.when(F.col("status") == "ok", 0).when(F.col("status") == "empty", 1).otherwise(2)
    row = F.struct(rank.alias("r"), F.col("attempts"), F.col("reply"), F.col("status"), F.col("error"))
    best = replies.groupBy(key).agg(F.min(row).alias("b"))
    return best.select(key, *[F.col("b")[c].alias(c) for c in ("reply", "status", "attempts", "error")])


def stat_columns() -> list[Column]:
    """F1 counters as aggregate expressions (shared by ``run_stats`` and
    the observed write).

    ``chunks_generated`` counts chunks, not chunk x style rows; samples are
    counted from their first chunk, so no distinct is needed. kept +
    filtered + failed + empty equals chunks x styles."""
    def n(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    first_style = F.col("prompt_ord") == F.lit(0)
    return [
        n(first_style & (F.col("chunk_index") == F.lit(0))).alias("samples_seen"),
        n(first_style).alias("chunks_generated"),
        n(F.col("status") == "kept").alias("conversations_kept"),
        n(F.col("status") == "filtered").alias("conversations_filtered"),
        n(F.col("status").isin("failed", "missing")).alias("conversations_failed"),
        n(F.col("status") == "empty").alias("conversations_empty"),
    ]


def run_stats(classified: DataFrame) -> DataFrame:
    """one row of counters over the chunk x style table (a single
    aggregation with map-side partial sums)."""
    return classified.agg(*stat_columns())
