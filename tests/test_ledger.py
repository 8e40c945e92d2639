import re
import uuid

import pytest
from pyspark.sql import functions as F

from talkmill.operators.fanout import build_requests, prompt_fanout
from talkmill.operators.ledger import ReplyLedger
from talkmill.plans.generation import GenerationConfig, chunk_table, pending_requests
from talkmill.session import checkpoint_dir
from talkmill.sources.corpus import SOURCE_FILE, SOURCE_ROW

DOCS = "/root/testdata/sf0.001/documents.parquet"
KEYS = (SOURCE_FILE, SOURCE_ROW, "chunk_index", "prompt_ord")


def _ledger(spark, buckets=4):
    return ReplyLedger(spark, f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}", buckets)


def _replies(requests, status):
    return requests.select("request_id", F.lit("x").alias("reply"), F.lit(status).alias("status"),
                           F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"))


def _shuffled_columns(df):
    df.collect()
    details = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) (?:ShuffleQueryStage|Exchange)\n(.*?)\n\n", details, flags=re.S)


@pytest.mark.parametrize("status,open_", [("ok", 10), ("failed", 100), ("empty", 100)])
def test_only_answers_close_a_request(spark, status, open_):
    requests = spark.range(100).select(F.concat(F.lit("r"), "id").alias("request_id"), "id")
    ledger = _ledger(spark)
    assert ledger.pending(requests).count() == 100
    ledger.append(_replies(requests.where("id >= 10"), status))
    ledger.append(_replies(requests.where("id >= 50"), status))
    assert ledger.pending(requests).count() == open_
    again = ReplyLedger(spark, ledger.path, 99)
    assert again.buckets == 4 and again.pending(requests).count() == open_


def test_the_ledger_is_read_by_bucket(spark):
    requests = spark.range(2000).select(F.concat(F.lit("r"), "id").alias("request_id"))
    ledger = _ledger(spark, buckets=8)
    ledger.append(_replies(requests.where("substr(request_id, 2, 1) < '9'"), "ok"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = ledger.pending(requests)
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in final  # the requests' ids
        assert found.count() == requests.where("substr(request_id, 2, 1) >= '9'").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_rerun_shuffles_no_text(spark):
    cfg = GenerationConfig(carry=(SOURCE_FILE, SOURCE_ROW), style_names=("debate", "interview"))
    rows = chunk_table(spark, DOCS, cfg)
    path = f"{checkpoint_dir(spark)}/chunks-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    chunks = spark.read.parquet(path)
    every = build_requests(prompt_fanout(chunks, cfg.styles()), cfg.request, KEYS)
    ledger = _ledger(spark)
    ledger.append(_replies(every.where("substr(request_id, 1, 1) != '0'"), "ok"))
    todo = pending_requests(chunks, cfg.styles(), cfg.request, ledger, KEYS)
    wanted = sorted((r.request_id, r.payload) for r in every.where("substr(request_id, 1, 1) = '0'").collect())
    assert wanted and sorted((r.request_id, r.payload) for r in todo.collect()) == wanted
    assert not [x for x in _shuffled_columns(todo) if "context" in x or "payload" in x]
    ids = ledger.pending(every.select("request_id", *KEYS[:3]))
    assert not [x for x in _shuffled_columns(ids) if "context" in x or "payload" in x]


def test_other_files_are_no_ledger(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError):
        ReplyLedger(spark, str(tmp_path / "x"))
