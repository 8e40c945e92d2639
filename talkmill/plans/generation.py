"""The generation plan: corpus -> samples -> windows -> styles -> replies
-> filter -> records, plus the run counters.

Physical shape (see ``explain``): parquet scan (text + position columns
only) -> join with the small block table of the dense index -> tokenise,
window and fan out in one codegen stage -> dry-run reply / filter / record
in the same stage. Only the model-client path (E2) leaves the JVM, and its
output is written before it is read again.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkmill.functions.styles import Style, select_styles
from talkmill.operators.chunking import ChunkConfig, chunk_windows
from talkmill.operators.fanout import RequestConfig, build_requests, prompt_fanout
from talkmill.operators.generate import dry_run_fanout, generate_replies
from talkmill.operators.ledger import ReplyLedger
from talkmill.operators.prefix import materialize
from talkmill.operators.records import classify_replies, conversation_record, run_stats
from talkmill.sources.corpus import DEFAULT_BLOCK_ROWS, SOURCE_FILE, SOURCE_ROW, join_in_place, samples


@dataclass(frozen=True)
class GenerationConfig:
    chunk: ChunkConfig = field(default_factory=ChunkConfig)
    request: RequestConfig = field(default_factory=RequestConfig)
    min_conversation_tokens: int = 50
    style_names: tuple[str, ...] | None = None
    extra_styles: tuple[Style, ...] = ()
    max_samples: int | None = None
    text_col: str = "text"
    carry: tuple[str, ...] = ()          # extra corpus columns kept on every row
    block_rows: int = DEFAULT_BLOCK_ROWS

    def styles(self) -> list[Style]:
        return select_styles(self.style_names, self.extra_styles)


def sample_table(spark: SparkSession, path: str, cfg: GenerationConfig) -> DataFrame:
    if cfg.max_samples is not None and cfg.max_samples < 0:
        raise ValueError("max_samples must be non-negative.")
    s = samples(spark, path, cfg.text_col, cfg.block_rows, limit=cfg.max_samples)
    return s.select("sample_index", cfg.text_col, *cfg.carry)


def chunk_table(spark: SparkSession, path: str, cfg: GenerationConfig) -> DataFrame:
    s = sample_table(spark, path, cfg)
    return chunk_windows(s, cfg.text_col, cfg.chunk, keep=["sample_index", *cfg.carry])


def fanout_table(spark: SparkSession, path: str, cfg: GenerationConfig) -> DataFrame:
    return prompt_fanout(chunk_table(spark, path, cfg), cfg.styles())


def dry_run_chunks(chunks: DataFrame, cfg: GenerationConfig) -> DataFrame:
    """Chunk x style rows of a chunk table with the E1 reply, token count and
    status; other columns of the chunks are carried along."""
    out = classify_replies(dry_run_fanout(chunks, cfg.styles()), "conversation", cfg.min_conversation_tokens,
                           tokens=F.col("_reply_tok"))
    return out.drop("_reply_tok")


def dry_run_table(spark: SparkSession, path: str, cfg: GenerationConfig | None = None) -> DataFrame:
    """Chunk x style rows with the E1 reply, token count and status."""
    cfg = cfg or GenerationConfig()
    return dry_run_chunks(chunk_table(spark, path, cfg), cfg)


def kept_conversations(classified: DataFrame, created_at=None) -> DataFrame:
    return conversation_record(classified.where(F.col("status") == "kept"), created_at)


def dry_run_conversations(spark: SparkSession, path: str,
                          cfg: GenerationConfig | None = None, created_at=None) -> DataFrame:
    """The reference's dry-run output as a table of B9 records."""
    return kept_conversations(dry_run_table(spark, path, cfg), created_at)


def dry_run_stats(spark: SparkSession, path: str, cfg: GenerationConfig | None = None) -> DataFrame:
    return run_stats(dry_run_table(spark, path, cfg))


PLACE = (SOURCE_FILE, SOURCE_ROW, "chunk_index")


def pending_requests(chunks: DataFrame, styles: list[Style], cfg: RequestConfig, ledger: ReplyLedger,
                     key_cols: Sequence[str]) -> DataFrame:
    """The requests of ``chunks`` (with their file and row) that the ledger
    has no answer for, with payloads. Ids are made in the scan and meet the
    ledger alone; the places of the open ones, written once, go back to the
    chunks, whose payloads are made after that join, so no context or payload
    is shuffled."""
    ids = build_requests(prompt_fanout(chunks, styles), cfg, key_cols).select("request_id", *PLACE, "prompt_ord")
    seen = Observation()
    todo = materialize(ledger.pending(ids).groupBy(*PLACE).agg(F.collect_set("prompt_ord").alias("_open"))
                       .observe(seen, F.sum(F.octet_length(SOURCE_FILE) + 96).alias("bytes")))
    open_chunks = join_in_place(chunks, todo, list(PLACE), seen.get["bytes"] or 0)
    asked = prompt_fanout(open_chunks, styles).where(F.array_contains("_open", F.col("prompt_ord"))).drop("_open")
    return build_requests(asked, cfg, key_cols)


def model_run(spark: SparkSession, path: str, replies_path: str,
              client_factory: Callable[[], Callable[[dict], str]],
              cfg: GenerationConfig | None = None, partitions: int | None = None,
              **client_opts) -> DataFrame:
    """E2 path: build requests, call the client inside tasks, append the
    replies to ``replies_path`` (shared storage), then give every request *of
    this run* its best stored reply (D2) and its context (D3) and classify.

    A request is known by its file, row, window, style and payload, so a
    rerun asks only what has no answer yet (D4): changed windows, styles,
    models or settings are new requests, failed ones are asked again, and
    stored replies of other runs are left alone."""
    from talkmill.operators.records import attach_replies, best_replies, pair_context
    cfg = cfg or GenerationConfig()
    placed = replace(cfg, carry=tuple(dict.fromkeys((*cfg.carry, SOURCE_FILE, SOURCE_ROW))))
    chunks = chunk_table(spark, path, placed)
    key_cols = (SOURCE_FILE, SOURCE_ROW, "chunk_index", "prompt_ord")
    requests = build_requests(prompt_fanout(chunks, cfg.styles()), cfg.request, key_cols=key_cols)
    ledger = ReplyLedger(spark, replies_path)
    todo = pending_requests(chunks, cfg.styles(), cfg.request, ledger, key_cols)
    ledger.append(generate_replies(todo, client_factory, partitions=partitions, **client_opts))
    replies = best_replies(ledger.replies())
    keys = ("sample_index", "chunk_index", "prompt_ord", "prompt_style")
    answered = attach_replies(requests.select("request_id", *keys), replies)
    paired = pair_context(answered, chunks, cols=("context", "context_tokens", *cfg.carry))
    return classify_replies(paired, "conversation", cfg.min_conversation_tokens)
