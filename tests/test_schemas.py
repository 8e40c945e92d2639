import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from talkmill.session import checkpoint_dir
from talkmill.sources.corpus import scan_corpus
from talkmill.sources.inspect import footer_profile
from talkmill.sources.schemas import SchemaClash


def folder(spark, tables):
    import os
    base = f"{checkpoint_dir(spark)}/schemas-{uuid.uuid4().hex}".replace("file:", "")
    os.makedirs(base)
    for i, t in enumerate(tables):
        pq.write_table(pa.table(t), f"{base}/part-{i:03d}.parquet")
    return base


def test_columns_and_types_of_all_shards(spark):
    path = folder(spark, [
        {"text": pa.array(["a"]), "n": pa.array([1], pa.int32()), "x": pa.array([0.5], pa.float32())},
        {"text": pa.array(["b"]), "n": pa.array([2 ** 40], pa.int64()), "lang": pa.array(["en"])},
        {"text": pa.array([None], pa.string()), "x": pa.array([1e300], pa.float64())},
        {"lang": pa.array(["de"]), "n": pa.array([3], pa.int32()), "text": pa.array(["c"])},
    ])
    df = scan_corpus(spark, path)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields if not f.name.startswith("source_")} == {
        "text": "string", "n": "bigint", "x": "double", "lang": "string"}
    rows = [(r.text, r.n, r.x, r.lang) for r in df.orderBy("source_file").collect()]
    assert rows == [("a", 1, 0.5, None), ("b", 2 ** 40, None, "en"), (None, None, 1e300, None), ("c", 3, None, "de")]


def test_types_that_clash_are_refused_by_file(spark):
    tables = [{"text": pa.array(["a"])}] * 5 + [{"text": pa.array([1], pa.int64())}] + [{"text": pa.array(["b"])}] * 3
    with pytest.raises(SchemaClash, match=r"column text is .*part-00[0-9].parquet and .*part-00[0-9].parquet") as e:
        scan_corpus(spark, folder(spark, tables))
    assert "part-005.parquet" in str(e.value) and "bigint" in str(e.value)


def test_counts_come_from_the_footers(spark):
    path = folder(spark, [{"text": pa.array(["a", None, "c"]), "n": pa.array([1, 2, None], pa.int32())},
                          {"text": pa.array(["d"]), "lang": pa.array([None], pa.string())}])
    df = footer_profile(spark, path)
    got = {r.column_name: (r.n_rows, r.n_nonnull, r.ordinal) for r in df.collect()}
    assert got == {"text": (4, 3, 0), "n": (4, 2, 1), "lang": (4, 0, 2)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    one = footer_profile(spark, "/root/testdata/sf0.001/documents.parquet")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(doc_id), COUNT(text)" in plan
    nested = footer_profile(spark, "/root/testdata/sf0.001/embeddings.parquet")
    assert {r.column_name: r.n_nonnull for r in nested.collect()}["embedding"] == 500
