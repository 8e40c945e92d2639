"""Plans stay balanced when one key holds a large share of the rows."""
import re

from pyspark.sql import functions as F

from talkmill.operators import budget as B
from talkmill.sources.corpus import drop_empty_text, sample_index, samples, scan_corpus


def skewed(spark, n=3000):
    # source "hot" holds two thirds of the rows
    rows = [(i, (i * 13) % 40 + 1, "hot" if i % 3 else f"s{i % 7}") for i in range(n)]
    return spark.createDataFrame(rows, "k BIGINT, n_tok BIGINT, source STRING")


def row_level_keys(plan: str):
    """Partition keys of joins and windows (aggregations are excluded: they
    combine map-side, so a hot key sends one row per task)."""
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    # the offsets window runs over per-(group, bucket) totals: at most
    # 2**bits rows per group whatever the data size, so it is exempt
    windows = [m.group(2) for m in re.finditer(r"Window \[(.*?)\], \[([^\]]*)\], \[", plan)
               if "_rt_bt" not in m.group(1)]
    return joins + windows


def test_blend_never_shuffles_on_source_alone(spark):
    df = skewed(spark)
    out = B.blend(df, "n_tok", "k", "source", {"hot": 0.2, "s1": 0.3, "s2": 0.5}, 20000, seed=1)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    for keys in row_level_keys(plan):
        if "source" in keys:
            assert "_hb" in keys, keys
    got = {r.source: r.t for r in out.groupBy("source").agg(F.sum("n_tok").alias("t")).collect()}
    for src, share in {"hot": 0.2, "s1": 0.3, "s2": 0.5}.items():
        assert share * 20000 <= got[src] < share * 20000 + 41


def test_dense_index_spreads_one_big_file(spark):
    """One file of one row group, default settings: rows reach every core,
    and no shuffle but the dealing out itself carries the text."""
    out = samples(spark, "/root/testdata/sf0.01/documents.parquet")
    parts = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in parts) < 2 * 1000 / len(parts)
    assert sorted(r.sample_index for r in out.select("sample_index").collect()) == list(range(1000))


def test_dense_index_moves_no_text(spark):
    docs = scan_corpus(spark, "/root/testdata/sf0.01/documents.parquet")
    out = sample_index(drop_empty_text(docs))
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
