"""Style fan-out and chat requests (keys D1, B7, B11, A7)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions.styles import (CLOSING_RULE, CONTEXT_CLOSE, CONTEXT_OPEN,
                                       SYSTEM_PROMPT, Style, select_styles, styles_column)
from talkmill.functions.text import count_tokens, py_strip


@dataclass(frozen=True)
class RequestConfig:
    model: str = "chat-model"
    temperature: float = 1.0
    top_p: float = 0.9
    max_output_tokens: int = 2048
    total_token_cap: int = 4096
    system_prompt: str = SYSTEM_PROMPT

    def __post_init__(self) -> None:
        if self.max_output_tokens <= 0:
            raise ValueError("max_output_tokens must be positive.")


def prompt_fanout(chunks: DataFrame, styles: Sequence[Style] | None = None) -> DataFrame:
    """Every chunk x every selected style, in style order (duplicates
    kept). The style list is a driver-side literal of known length, so the
    fan-out is a Generate in the same stage as the scan."""
    styles = list(styles) if styles is not None else select_styles()
    return chunks.select("*", F.inline(styles_column(styles)))


def user_message(instruction="instruction", context="context"):
    return F.concat(F.col(instruction), F.lit("\n\n" + CONTEXT_OPEN), py_strip(F.col(context)),
                    F.lit(CONTEXT_CLOSE + CLOSING_RULE))


def render_messages(df: DataFrame, cfg: RequestConfig | None = None) -> DataFrame:
    """``messages ARRAY<STRUCT<role, content>>`` (system + user)."""
    cfg = cfg or RequestConfig()
    return df.withColumn("messages", F.array(
        F.struct(F.lit("system").alias("role"), F.lit(cfg.system_prompt).alias("content")),
        F.struct(F.lit("user").alias("role"), user_message().alias("content"))))


def request_id(*cols) -> F.Column:
    """Stable request key: sha256 over the key columns."""
    return F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols]), 256)


def context_tokens(context: str = "context") -> F.Column:
    """Lexer tokens of a user message from its context part on. Taken before
    the fan-out, it counts a context once and not once per style. Null without a context, whose message is null."""
    part = F.concat(F.lit(CONTEXT_OPEN), py_strip(F.col(context)), F.lit(CONTEXT_CLOSE + CLOSING_RULE))
    return F.when(F.col(context).isNotNull(), count_tokens(part))


def token_budget(df: DataFrame, cfg: RequestConfig | None = None, counted: str | None = None) -> DataFrame:
    """``prompt_tokens`` and ``max_tokens = least(cap_out, cap_total -
    prompt_tokens)``; requests with no room left are dropped.

    ``counted`` names a column with the ``context_tokens`` of the rows. The
    rest of a message is its instruction and a blank line. The counts add up
    exactly: the blank line and what space there is before it are one lexer
    piece, which ends where the context part starts with a letter."""
    cfg = cfg or RequestConfig()
    if "messages" not in df.columns:
        df = render_messages(df, cfg)
    if counted is None:
        prompt_tok = (count_tokens(F.col("messages")[0]["content"])
                      + count_tokens(F.col("messages")[1]["content"]))
    else:
        head = F.when(F.col("instruction").isNotNull(), count_tokens(F.concat(F.col("instruction"), F.lit("\n\n"))))
        prompt_tok = count_tokens(F.lit(cfg.system_prompt)) + F.coalesce(head + F.col(counted), F.lit(0))
    out = df.withColumn("prompt_tokens", prompt_tok.cast("int"))
    out = out.withColumn("max_tokens", F.least(F.lit(cfg.max_output_tokens),
                                               F.lit(cfg.total_token_cap) - F.col("prompt_tokens")))
    return out.where(F.col("max_tokens") > 0)


def build_requests(df: DataFrame, cfg: RequestConfig | None = None,
                   key_cols: Sequence[str] = ("sample_index", "chunk_index", "prompt_ord",
                                              "prompt_style")) -> DataFrame:
    """Chat request rows with a JSON payload. ``request_id`` hashes the
    key columns *and* the payload, so a request with another context, style
    text, model or setting is another request."""
    cfg = cfg or RequestConfig()
    df = render_messages(df, cfg)
    payload = F.to_json(F.struct(
        F.lit(cfg.model).alias("model"), F.lit(cfg.temperature).alias("temperature"),
        F.lit(cfg.top_p).alias("top_p"), F.lit(cfg.max_output_tokens).alias("max_tokens"),
        F.col("messages")))
    return df.withColumn("payload", payload).withColumn("request_id", request_id(*key_cols, "payload"))
