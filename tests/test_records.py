from pyspark.sql import functions as F

from talkmill.operators.records import (attach_replies, classify_replies, filter_chain,
                                        pending_only, run_stats)
from talkmill.plans.generation import GenerationConfig, dry_run_table


def test_min_token_edges(texts):
    values = ["".join(" w" for _ in range(n)) for n in (49, 50, 51)] + [None, "   "]
    rows = classify_replies(texts(values, "conversation"), "conversation", 50) \
        .orderBy("id").select("status").collect()
    assert [r.status for r in rows] == ["filtered", "kept", "kept", "empty", "empty"]


def test_filter_chain_names_first_failure(spark):
    df = spark.createDataFrame([(1,), (5,), (20,)], "x INT")
    out = filter_chain(df, [("pos", F.col("x") > 2), ("small", F.col("x") < 10)]).orderBy("x")
    assert [r.rejected_by for r in out.collect()] == ["pos", None, "small"]


def test_stats_identity(spark):
    d = dry_run_table(spark, "/root/testdata/sf0.001/documents.parquet", GenerationConfig())
    s = run_stats(d).first()
    n_rows = d.count()
    assert s.conversations_kept + s.conversations_filtered + s.conversations_failed + \
        s.conversations_empty == n_rows
    assert n_rows == s.chunks_generated * 7
    assert s.samples_seen == 200


def test_attach_and_pending(spark):
    req = spark.createDataFrame([("a",), ("b",)], "request_id STRING")
    rep = spark.createDataFrame([("a", "hi", "ok", 1, None)],
                                "request_id STRING, reply STRING, status STRING, attempts INT, error STRING")
    out = {r.request_id: r.status for r in attach_replies(req, rep).collect()}
    assert out == {"a": "ok", "b": "missing"}
    assert [r.request_id for r in pending_only(req, rep).collect()] == ["b"]


def test_created_at_is_utc_iso(spark):
    import re
    from datetime import datetime, timezone

    from talkmill.operators.records import conversation_record
    df = spark.createDataFrame([(0, 1, "debate", "c", "x")],
                               "sample_index BIGINT, chunk_index INT, prompt_style STRING, "
                               "context STRING, conversation STRING")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        stamp = conversation_record(df).first().created_at
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", stamp)
    parsed = datetime.fromisoformat(stamp)
    assert abs((datetime.now(timezone.utc) - parsed).total_seconds()) < 120
