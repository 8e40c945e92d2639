import os
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from talkmill.operators.records import run_stats
from talkmill.plans.generation import GenerationConfig, dry_run_table
from talkmill.session import checkpoint_dir
from talkmill.streaming.incremental import incremental_run, incremental_stats, read_stats


def split_corpus(spark, parts=3):
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}".replace("file:", "")
    os.makedirs(f"{base}/in")
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    step = (t.num_rows + parts - 1) // parts
    for i in range(parts):
        pq.write_table(t.slice(i * step, step), f"{base}/in/part-{i}.parquet")
    return base


def test_stream_equals_batch_and_resumes(spark):
    base = split_corpus(spark)
    incremental_run(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    stream = spark.read.parquet(f"{base}/out")
    batch = dry_run_table(spark, f"{base}/in", GenerationConfig(carry=("doc_id",))) \
        .where("status = 'kept'")
    # the stream keys rows by (file, row); the batch by dense index - compare on content
    s = sorted((r.chunk_index, r.prompt_style, r.conversation) for r in stream.collect())
    b = sorted((r.chunk_index, r.prompt_style, r.conversation) for r in batch.collect())
    assert s == b
    n_before = stream.count()
    # a new shard arrives: a rerun only adds its rows
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).slice(0, 5)
    pq.write_table(t, f"{base}/in/part-9.parquet")
    incremental_run(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    after = spark.read.parquet(f"{base}/out")
    added = after.where(F.col("source_file").endswith("part-9.parquet")).count()
    assert after.count() == n_before + added and added > 0


def test_stream_stats_add_up(spark):
    base = split_corpus(spark)
    incremental_stats(spark, f"{base}/in", f"{base}/stats", f"{base}/ckpt",
                      max_files_per_trigger=1)
    s = read_stats(spark, f"{base}/stats").first()
    b = run_stats(dry_run_table(spark, f"{base}/in", GenerationConfig())).first()
    assert s.asDict() == b.asDict()
    assert spark.read.parquet(f"{base}/stats").select("batch_id").distinct().count() == 3


def test_stream_with_model_client(spark):
    from talkmill.functions.styles import select_styles
    from talkmill.plans.echo_client import echo_client_factory, no_jitter, no_wait
    from talkmill.plans.generation import model_run
    from talkmill.streaming.incremental import incremental_generate
    base = split_corpus(spark, parts=2)
    styles = select_styles(["debate", "interview"])
    incremental_generate(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", echo_client_factory,
                         styles=styles, max_attempts=2, sleep=no_wait, jitter=no_jitter,
                         max_files_per_trigger=1)
    stream = spark.read.parquet(f"{base}/out")
    assert stream.select("batch_id").distinct().count() == 2
    cfg = GenerationConfig(style_names=("debate", "interview"))
    batch = model_run(spark, f"{base}/in", f"{base}/batch-replies", echo_client_factory, cfg,
                      max_attempts=2, sleep=no_wait, jitter=no_jitter)
    s = sorted((r.chunk_index, r.prompt_style, r.status, r.conversation) for r in stream.collect())
    b = sorted((r.chunk_index, r.prompt_style, r.status, r.conversation) for r in batch.collect())
    assert s == b


def test_records_and_counters_in_one_stream_survive_a_replay(spark):
    base = split_corpus(spark)
    out, stats, ckpt = (f"{base}/{x}" for x in ("out", "stats", "ckpt"))
    incremental_run(spark, f"{base}/in", out, ckpt, stats, max_files_per_trigger=1)
    wanted = run_stats(dry_run_table(spark, f"{base}/in", GenerationConfig())).first().asDict()
    assert read_stats(spark, stats).first().asDict() == wanted
    batches = spark.read.parquet(stats).count()
    assert batches == 3 and spark.read.parquet(out).count() == wanted["conversations_kept"]
    # the last batch was written, but its commit was lost
    os.remove(f"{ckpt}/commits/2")
    for name in (".2.crc",):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    incremental_run(spark, f"{base}/in", out, ckpt, stats, max_files_per_trigger=1)
    assert read_stats(spark, stats).first().asDict() == wanted
    assert spark.read.parquet(out).count() == wanted["conversations_kept"]


def test_shards_of_the_registered_runs_follow_the_input(spark, tmp_path):
    import os

    from talkmill.streaming.incremental import _shards
    rows = [(i, "word " * 100) for i in range(200)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    source, per_trigger = _shards(spark, str(tmp_path), str(tmp_path / "many"), shard_bytes=10_000)
    assert len([f for f in os.listdir(source) if f.endswith(".parquet")]) == 10 and per_trigger == 5
    assert sorted(r.doc_id for r in spark.read.parquet(source).collect()) == list(range(200))
    assert _shards(spark, str(tmp_path), str(tmp_path / "few"))[1] == 2
