"""Registered queries: one per operator key of the blueprint, each with
its DuckDB oracle SQL (``None`` where only a rows check is possible).

Every query runs over whole tables; results are sets (order is never
compared). Counts are BIGINT, indexes INT/BIGINT, doubles rounded to 6
digits on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions.text import count_tokens, py_strip, tokenize
from talkmill.operators.fanout import (RequestConfig, build_requests, context_tokens, prompt_fanout, render_messages,
                                       token_budget)
from talkmill.operators.records import classify_replies, filter_chain, run_stats
from talkmill.plans import oracle as o
from talkmill.plans.generation import (GenerationConfig, chunk_table, fanout_table,
                                       kept_conversations)
from talkmill.plans.tables import CARRY, corpus, dialogue_table, documents_path, table
from talkmill.sources.corpus import drop_empty_text, max_samples, sample_index

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


CFG = GenerationConfig(carry=CARRY)

# --------------------------------------------------------------------------- A: scan


@register("a1_scan_corpus",
          "SELECT doc_id, text, lang, source, n_chars FROM documents")
def a1(spark, sf):
    return corpus(spark, sf).select("doc_id", "text", "lang", "source", "n_chars")


@register("a3_sample_index",
          o.with_("samples") + "SELECT sample_index, doc_id FROM samples")
def a3(spark, sf):
    return sample_index(drop_empty_text(corpus(spark, sf))).select("sample_index", "doc_id")


@register("a4_max_samples",
          o.with_("samples") + "SELECT sample_index, doc_id FROM samples WHERE sample_index < 100")
def a4(spark, sf):
    s = sample_index(drop_empty_text(corpus(spark, sf)), limit=100)
    return max_samples(s, 100).select("sample_index", "doc_id")


@register("a5_drop_empty_text",
          "SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND text <> ''")
def a5(spark, sf):
    return drop_empty_text(corpus(spark, sf)).select("doc_id", "text")


# --------------------------------------------------------------------------- C: tokens

@register("c1_tokenize",
          "SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens, tk[1] AS first_token, "
          "tk[len(tk)] AS last_token, array_to_string(tk, '') = text AS rebuilds_text "
          f"FROM (SELECT doc_id, text, {o.tok('text')} AS tk FROM documents "
          "WHERE text IS NOT NULL AND text <> '')")
def c1(spark, sf):
    d = drop_empty_text(table(spark, sf, "documents")).select("doc_id", "text",
                                                              tokenize("text").alias("tk"))
    return d.select("doc_id", F.size("tk").cast("int").alias("n_tokens"),
                    F.col("tk")[0].alias("first_token"),
                    F.element_at("tk", -1).alias("last_token"),
                    (F.array_join("tk", "") == F.col("text")).alias("rebuilds_text"))


@register("c2_count_tokens",
          f"SELECT doc_id, CAST({o.ntok('text')} AS BIGINT) AS n_tokens FROM documents")
def c2(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", count_tokens("text").cast("bigint").alias("n_tokens"))


@register("c3_chunk",
          o.with_("chunks") + "SELECT sample_index, chunk_index, context, context_tokens FROM chunks")
def c3(spark, sf):
    return chunk_table(spark, documents_path(sf), CFG).select(
        "sample_index", "chunk_index", "context", "context_tokens")


# --------------------------------------------------------------------------- B / D / E

@register("d1_prompt_fanout",
          o.with_("fanout") + "SELECT sample_index, chunk_index, prompt_ord, prompt_style, "
          "context_tokens FROM fanout")
def d1(spark, sf):
    return fanout_table(spark, documents_path(sf), CFG).select(
        "sample_index", "chunk_index", "prompt_ord", "prompt_style", "context_tokens")


@register("e1_dry_run_reply",
          o.with_("classified") + "SELECT sample_index, chunk_index, prompt_style, conversation, "
          "conversation_tokens FROM classified")
def e1(spark, sf):
    return dialogue_table(spark, sf).select("sample_index", "chunk_index", "prompt_style",
                                            "conversation", "conversation_tokens")


@register("b3_min_token_filter",
          o.with_("classified") + "SELECT sample_index, chunk_index, prompt_style, "
          "conversation_tokens, status FROM classified")
def b3(spark, sf):
    return dialogue_table(spark, sf).select("sample_index", "chunk_index", "prompt_style",
                                            "conversation_tokens", "status")


@register("b9_conversation_record",
          o.with_("kept") + "SELECT sample_index, chunk_index, prompt_style, context, conversation "
          "FROM kept")
def b9(spark, sf):
    return kept_conversations(dialogue_table(spark, sf)).drop("created_at")


@register("f1_run_stats",
          o.with_("classified") +
          "SELECT CAST((SELECT count(*) FROM samples) AS BIGINT) AS samples_seen, "
          "CAST((SELECT count(*) FROM chunks) AS BIGINT) AS chunks_generated, "
          "CAST(count(*) FILTER (WHERE status = 'kept') AS BIGINT) AS conversations_kept, "
          "CAST(count(*) FILTER (WHERE status = 'filtered') AS BIGINT) AS conversations_filtered, "
          "CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS conversations_failed, "
          "CAST(count(*) FILTER (WHERE status = 'empty') AS BIGINT) AS conversations_empty "
          "FROM classified")
def f1(spark, sf):
    return run_stats(dialogue_table(spark, sf))


@register("b5_py_strip",
          o.with_("chunks") + f"SELECT sample_index, chunk_index, {o.strip('context')} AS stripped "
          "FROM chunks")
def b5(spark, sf):
    return chunk_table(spark, documents_path(sf), CFG).select(
        "sample_index", "chunk_index", py_strip("context").alias("stripped"))


@register("b6_drop_empty_reply",
          "SELECT conv_id, turn, CAST(" + o.ntok("text") + " AS INTEGER) AS conversation_tokens, "
          f"CASE WHEN text IS NULL OR {o.strip('text')} = '' THEN 'empty' "
          f"WHEN {o.ntok('text')} >= 50 THEN 'kept' ELSE 'filtered' END AS status "
          "FROM conversations")
def b6(spark, sf):
    c = table(spark, sf, "conversations")
    return classify_replies(c, "text", 50).select("conv_id", "turn", "conversation_tokens",
                                                  "status")


B4_SQL = (o.with_("classified") +
          "SELECT sample_index, chunk_index, prompt_style, CASE "
          "WHEN NOT (conversation_tokens >= 50) THEN 'min_tokens' "
          "WHEN NOT (conversation_tokens <= 120) THEN 'max_tokens' "
          "WHEN NOT regexp_matches(conversation, '[0-9]') THEN 'has_digit' "
          "ELSE NULL END AS rejected_by FROM classified")


@register("b4_filter_chain", B4_SQL)
def b4(spark, sf):
    d = dialogue_table(spark, sf)
    chained = filter_chain(d, [("min_tokens", F.col("conversation_tokens") >= 50),
                               ("max_tokens", F.col("conversation_tokens") <= 120),
                               ("has_digit", F.col("conversation").rlike("[0-9]"))])
    return chained.select("sample_index", "chunk_index", "prompt_style", "rejected_by")


@register("b7_render_messages",
          o.with_("fanout") + f"SELECT sample_index, chunk_index, prompt_style, {o.SYSTEM} AS "
          f"system_content, {o.user_msg()} AS user_content FROM fanout")
def b7(spark, sf):
    r = render_messages(fanout_table(spark, documents_path(sf), CFG))
    return r.select("sample_index", "chunk_index", "prompt_style",
                    F.col("messages")[0]["content"].alias("system_content"),
                    F.col("messages")[1]["content"].alias("user_content"))


@register("b11_token_budget",
          o.with_("fanout") +
          "SELECT sample_index, chunk_index, prompt_style, prompt_tokens, "
          "CAST(least(2048, 4096 - prompt_tokens) AS INTEGER) AS max_tokens FROM ("
          f"SELECT *, CAST({o.ntok(o.SYSTEM)} + {o.ntok(o.user_msg())} AS INTEGER) AS prompt_tokens "
          "FROM fanout) WHERE least(2048, 4096 - prompt_tokens) > 0")
def b11(spark, sf):
    """A context is counted once, before the fan-out."""
    chunks = chunk_table(spark, documents_path(sf), CFG).withColumn("_counted", context_tokens())
    t = token_budget(prompt_fanout(chunks, CFG.styles()), RequestConfig(), counted="_counted")
    return t.select("sample_index", "chunk_index", "prompt_style", "prompt_tokens",
                    F.col("max_tokens").cast("int").alias("max_tokens"))


def _request_sql() -> str:
    msgs = (f"[{{'role': 'system', 'content': {o.SYSTEM}}}, "
            f"{{'role': 'user', 'content': {o.user_msg()}}}]")
    return (o.with_("fanout") +
            "SELECT sha256(concat_ws(chr(1), CAST(sample_index AS VARCHAR), CAST(chunk_index AS VARCHAR), "
            "CAST(prompt_ord AS VARCHAR), prompt_style, payload)) AS request_id, prompt_style, payload FROM (SELECT *, "
            f"CAST(to_json({{'model': '{RequestConfig().model}', 'temperature': 1.0, 'top_p': 0.9, "
            f"'max_tokens': 2048, 'messages': {msgs}}}) AS VARCHAR) AS payload FROM fanout)")


@register("a7_request_sink", _request_sql())
def a7(spark, sf):
    r = build_requests(fanout_table(spark, documents_path(sf), CFG), RequestConfig())
    return r.select("request_id", "prompt_style", "payload")


def _load() -> None:
    import talkmill.plans.queries_tables  # noqa: F401  (registers part 2)
    import talkmill.streaming.incremental  # noqa: F401  (registers J1, J2)


def all_queries() -> dict[str, Query]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


