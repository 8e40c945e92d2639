"""Incremental generation over a growing folder of parquet shards
(keys J1, J2).

The whole chain from scan to record is stateless (tokenise, window, fan
out, reply, filter), so each micro-batch is independent: Structured
Streaming's file source tracks which shards were processed in the
checkpoint, ``maxFilesPerTrigger`` bounds a batch, and ``availableNow``
drains the backlog and stops. The dense ``sample_index`` of the batch
plan needs a global order, so the stream keys rows by their stable
position ``(source_file, source_row)`` instead.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkmill.functions.styles import Style, select_styles
from talkmill.operators.chunking import ChunkConfig, chunk_windows
from talkmill.operators.generate import dry_run_fanout
from talkmill.operators.records import classify_replies, run_stats, stat_columns, utc_now_iso
from talkmill.plans import oracle as o
from talkmill.plans.queries import register
from talkmill.session import checkpoint_dir
from talkmill.sources.corpus import SOURCE_FILE, SOURCE_ROW, non_empty
from talkmill.sources.schemas import shard_schema

STREAM_KEY = (SOURCE_FILE, SOURCE_ROW)


def _stream_rows(spark: SparkSession, source: str, text: str,
                 max_files_per_trigger: int | None, file_glob: str,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Non-empty rows of new shards with their (file, row) key. Without
    ``max_files_per_trigger`` a trigger takes every new shard (Spark's
    default); set it to bound the size of a micro-batch."""
    schema = shard_schema(spark, source, file_glob) or \
        spark.read.option("pathGlobFilter", file_glob).parquet(source).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(source)
    return raw.where(non_empty(text)).select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW), text, *carry)


def stream_dialogues(spark: SparkSession, source: str, text: str = "text",
                     chunk: ChunkConfig | None = None, styles: Sequence[Style] | None = None,
                     min_tokens: int = 50, max_files_per_trigger: int | None = None,
                     file_glob: str = "*.parquet", carry: Sequence[str] = ()) -> DataFrame:
    """Streaming DataFrame of classified chunk x style rows (dry-run
    replies) over the shards of folder ``source`` matching ``file_glob``."""
    rows = _stream_rows(spark, source, text, max_files_per_trigger, file_glob, carry)
    chunks = chunk_windows(rows, text, chunk or ChunkConfig(), keep=[*STREAM_KEY, *carry])
    fan = dry_run_fanout(chunks, list(styles) if styles is not None else select_styles())
    return classify_replies(fan, "conversation", min_tokens,
                            tokens=F.col("_reply_tok")).drop("_reply_tok")


def incremental_run(spark: SparkSession, source: str, out_path: str, checkpoint: str,
                    stats_path: str | None = None, **kw) -> None:
    """Append kept records of every new shard to ``out_path`` (parquet)
    and stop when the backlog is drained; rerunning resumes from the
    checkpoint and processes only new shards.

    With ``stats_path`` (J2) the F1 counters of every micro-batch are
    collected in the pass that writes its records, and stand there as soon as
    the batch is done, so they also show the progress of a long run. Records
    and counters of a batch have a folder of its number, which a replay of
    the batch overwrites: sums on read stay exact."""
    d = stream_dialogues(spark, source, **kw)
    columns = [*STREAM_KEY, *kw.get("carry", ()), "chunk_index", "prompt_style", "context", "conversation",
               "conversation_tokens"]

    def records(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("status") == "kept").select(*columns, utc_now_iso().alias("created_at"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        records(batch.observe(seen, *stat_columns())).write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch_id={batch_id}")
        counted = seen.get
        row = [(*(int(counted[c] or 0) for c in STAT_COLS), batch_id)]
        schema = ", ".join(f"{c} BIGINT" for c in (*STAT_COLS, "batch_id"))
        batch.sparkSession.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").parquet(
            f"{stats_path.rstrip('/')}/batch_id={batch_id}")

    if stats_path is None:
        writer = records(d).writeStream.format("parquet").option("path", out_path)
    else:
        writer = d.writeStream.foreachBatch(per_batch)
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def incremental_stats(spark: SparkSession, source: str, stats_path: str, checkpoint: str,
                      **kw) -> None:
    """J2 without records: F1 counters per micro-batch, one folder per batch
    id (a replayed batch overwrites its own folder)."""
    d = stream_dialogues(spark, source, **kw)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (run_stats(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{stats_path.rstrip('/')}/batch_id={batch_id}"))

    q = (d.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def incremental_generate(spark: SparkSession, source: str, out_path: str, checkpoint: str,
                         client_factory, text: str = "text", chunk: ChunkConfig | None = None,
                         styles: Sequence[Style] | None = None, min_tokens: int = 50,
                         max_files_per_trigger: int | None = None, file_glob: str = "*.parquet",
                         partitions: int | None = None, **client_opts) -> None:
    """J1 with a model client: every micro-batch of new shards is chunked,
    fanned out, sent through ``generate_replies`` (E2) and written as
    classified records to ``out_path/batch_id=N``. Replies are written first
    (``out_path_replies/batch_id=N``) and read back, so the model is called
    once per request of the batch. A replayed batch (after a failure)
    overwrites its own folders, so output stays exactly-once even though
    the model may be called again for that batch."""
    from talkmill.operators.fanout import build_requests, prompt_fanout
    from talkmill.operators.generate import generate_replies
    from talkmill.operators.records import pair_context
    rows = _stream_rows(spark, source, text, max_files_per_trigger, file_glob)
    picked = list(styles) if styles is not None else select_styles()
    keys = [*STREAM_KEY, "chunk_index", "prompt_ord", "prompt_style"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        chunks = chunk_windows(batch, text, chunk or ChunkConfig(), keep=list(STREAM_KEY))
        requests = build_requests(prompt_fanout(chunks, picked), key_cols=keys)
        replies = generate_replies(requests, client_factory, partitions=partitions, carry=keys,
                                   **client_opts).withColumnRenamed("reply", "conversation")
        target = f"{out_path.rstrip('/')}/batch_id={batch_id}"
        reply_dir = f"{out_path.rstrip('/')}_replies/batch_id={batch_id}"
        replies.write.mode("overwrite").parquet(reply_dir)
        stored = batch.sparkSession.read.parquet(reply_dir)
        paired = pair_context(stored, chunks, keys=[*STREAM_KEY, "chunk_index"],
                              cols=("context", "context_tokens"))
        out = classify_replies(paired, "conversation", min_tokens)
        out.select(*STREAM_KEY, "chunk_index", "prompt_style", "context", "conversation",
                   "conversation_tokens", "status", "attempts", "error",
                   utc_now_iso().alias("created_at")).write.mode("overwrite").parquet(target)

    q = (rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


STAT_COLS = ("samples_seen", "chunks_generated", "conversations_kept", "conversations_filtered",
             "conversations_failed", "conversations_empty")


def read_stats(spark: SparkSession, stats_path: str) -> DataFrame:
    s = spark.read.parquet(stats_path)
    return s.agg(*[F.sum(c).cast("bigint").alias(c) for c in STAT_COLS])


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


SHARD_BYTES = 64 << 20


def _shards(spark: SparkSession, sf: str, base: str, shard_bytes: int = SHARD_BYTES) -> tuple[str, int]:
    """``documents`` as a folder of shards of about ``shard_bytes`` of text,
    four at least, and half their number, which one trigger takes."""
    rows = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-size // shard_bytes))
    rows.repartition(shards, "doc_id").write.parquet(f"{base}/in")
    return f"{base}/in", -(-shards // 2)


@register("j1_incremental_run",
          o.with_("kept") + "SELECT doc_id, chunk_index, prompt_style, conversation_tokens FROM kept")
def j1(spark, sf):
    """Two triggers over the shards, then a restart that finds nothing new."""
    base = _scratch(spark, "stream-run")
    source, per_trigger = _shards(spark, sf, base)
    for _ in range(2):
        incremental_run(spark, source, f"{base}/out", f"{base}/ckpt", f"{base}/stats", max_files_per_trigger=per_trigger,
                        carry=("doc_id",))
    out = spark.read.parquet(f"{base}/out")
    return out.select("doc_id", F.col("chunk_index").cast("int"), "prompt_style", "conversation_tokens")


@register("j2_incremental_stats",
          o.with_("classified") +
          "SELECT CAST((SELECT count(*) FROM samples) AS BIGINT) AS samples_seen, "
          "CAST((SELECT count(*) FROM chunks) AS BIGINT) AS chunks_generated, "
          "CAST(count(*) FILTER (WHERE status = 'kept') AS BIGINT) AS conversations_kept, "
          "CAST(count(*) FILTER (WHERE status = 'filtered') AS BIGINT) AS conversations_filtered, "
          "CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS conversations_failed, "
          "CAST(count(*) FILTER (WHERE status = 'empty') AS BIGINT) AS conversations_empty "
          "FROM classified")
def j2(spark, sf):
    """The counters that the run of J1 leaves, batch by batch."""
    base = _scratch(spark, "stream-stats")
    source, per_trigger = _shards(spark, sf, base)
    for _ in range(2):
        incremental_run(spark, source, f"{base}/out", f"{base}/ckpt", f"{base}/stats", max_files_per_trigger=per_trigger)
    return read_stats(spark, f"{base}/stats")
