import json
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from talkmill.functions.styles import select_styles
from talkmill.operators.chunking import ChunkConfig
from talkmill.operators.fanout import RequestConfig, build_requests, prompt_fanout, render_messages
from talkmill.operators.records import run_stats
from talkmill.plans.echo_client import echo_reply, no_jitter, no_wait
from talkmill.plans.generation import GenerationConfig, chunk_table, model_run
from talkmill.session import checkpoint_dir
from talkmill.sources.sinks import write_requests

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DOCS = "/root/testdata/sf0.001/documents.parquet"


def counting_factory():
    """Echo client that also appends one line per call to a shared file, so
    the test can count calls made inside the tasks."""
    def call(req):
        with open(COUNTER, "a") as f:
            f.write("x\n")
        return echo_reply(req["messages"][1]["content"])
    return call


def test_model_run_writes_once_and_resumes(spark, tmp_path):
    global COUNTER
    COUNTER = str(tmp_path / "calls.txt")
    replies = f"{checkpoint_dir(spark)}/replies-{uuid.uuid4().hex}"
    cfg = GenerationConfig(style_names=("debate", "interview"))
    out = model_run(spark, DOCS, replies, counting_factory, cfg,
                    max_attempts=2, sleep=no_wait, jitter=no_jitter)
    statuses = {r.status: r.n for r in out.groupBy("status").agg(F.count("*").alias("n")).collect()}
    n_req = sum(statuses.values())
    assert n_req == chunk_table(spark, DOCS, cfg).count() * 2
    assert set(statuses) <= {"kept", "filtered", "failed"}
    assert statuses.get("failed", 0) > 0
    first_calls = sum(1 for _ in open(COUNTER))
    assert first_calls >= n_req
    # rerun: only the failed requests are asked again, nothing is doubled
    out2 = model_run(spark, DOCS, replies, counting_factory, cfg,
                     max_attempts=2, sleep=no_wait, jitter=no_jitter)
    second = sum(1 for _ in open(COUNTER)) - first_calls
    assert second == 2 * statuses["failed"]
    assert out2.count() == n_req


def steady_factory():
    return lambda req: "Speaker: " + str(len(req["messages"][1]["content"]))


def down_factory():
    def call(req):
        raise RuntimeError("endpoint is down")
    return call


def _run(spark, replies, factory, **cfg):
    out = model_run(spark, DOCS, replies, factory, GenerationConfig(max_samples=3, **cfg),
                    max_attempts=1, sleep=no_wait, jitter=no_jitter)
    return out.collect()


def test_failed_requests_are_asked_again(spark):
    replies = f"{checkpoint_dir(spark)}/replies-{uuid.uuid4().hex}"
    down = _run(spark, replies, down_factory, style_names=("debate",))
    assert {r.status for r in down} == {"failed"}
    back = _run(spark, replies, steady_factory, style_names=("debate",))
    assert {r.status for r in back} == {"filtered"} and len(back) == len(down)


def test_other_windows_styles_and_settings_are_other_requests(spark):
    replies = f"{checkpoint_dir(spark)}/replies-{uuid.uuid4().hex}"
    _run(spark, replies, steady_factory, style_names=("debate",))
    small = _run(spark, replies, steady_factory, style_names=("interview",), chunk=ChunkConfig(40, 0))
    assert {r.prompt_style for r in small} == {"interview"}
    for r in small:  # every reply was made from the row's own context
        context = render_messages(spark.createDataFrame([(r.context, select_styles(["interview"])[0].instruction)],
                                                        "context STRING, instruction STRING")).first()
        assert r.conversation == "Speaker: " + str(len(context.messages[1].content))
        break
    stats = run_stats(model_run(spark, DOCS, replies, steady_factory,
                                GenerationConfig(max_samples=3, style_names=("interview",), chunk=ChunkConfig(40, 0)),
                                max_attempts=1)).first()
    assert stats.samples_seen == 3


def test_storage_errors_are_not_taken_for_a_first_run(spark, tmp_path):
    bad = tmp_path / "replies"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        _run(spark, str(bad), steady_factory, style_names=("debate",))


def test_write_requests_partitioned(spark):
    path = f"{checkpoint_dir(spark)}/requests-{uuid.uuid4().hex}"
    cfg = GenerationConfig(style_names=("debate", "two_students"))
    req = build_requests(prompt_fanout(chunk_table(spark, DOCS, cfg), cfg.styles()), RequestConfig())
    write_requests(req, path)
    back = spark.read.json(path)
    assert back.select("prompt_style").distinct().count() == 2
    one = json.loads(back.where("prompt_style = 'debate'").first().payload)
    assert [m["role"] for m in one["messages"]] == ["system", "user"]
    assert one["max_tokens"] == 2048
