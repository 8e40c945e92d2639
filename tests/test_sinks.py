import uuid

import pytest
from pyspark.errors import AnalysisException

from talkmill.session import checkpoint_dir
from talkmill.sources.sinks import write_jsonl


def test_refuse_then_overwrite(spark):
    path = f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}/nested/out"
    a = spark.createDataFrame([(1, "é", None)], "k INT, v STRING, n STRING")
    write_jsonl(a, path)
    with pytest.raises(AnalysisException):
        write_jsonl(a, path)
    assert spark.read.json(path).count() == 1
    b = spark.createDataFrame([(2, "x", None), (3, "y", None)], "k INT, v STRING, n STRING")
    write_jsonl(b, path, overwrite=True)
    assert sorted(r.k for r in spark.read.json(path).collect()) == [2, 3]
    lines = spark.read.text(path).collect()
    assert all('"n":null' in r.value for r in lines)


def test_write_with_observed_stats(spark):
    from talkmill.operators.records import run_stats
    from talkmill.plans.generation import GenerationConfig, dry_run_table
    from talkmill.sources.sinks import write_records_with_stats
    d = dry_run_table(spark, "/root/testdata/sf0.001/documents.parquet", GenerationConfig())
    path = f"{checkpoint_dir(spark)}/observed-{uuid.uuid4().hex}"
    stats = write_records_with_stats(d, path)
    assert stats == run_stats(d).first().asDict()
    assert spark.read.json(path).count() == stats["conversations_kept"]
