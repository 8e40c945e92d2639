import uuid

import pytest
from pyspark.sql import functions as F

from talkmill.session import checkpoint_dir
from talkmill.sources.corpus import (drop_empty_text, first_n, max_samples, sample_index,
                                     scan_corpus, skipped_count)


def shards(spark, parts):
    """Write each list of texts as its own parquet file (names sort in
    list order) in a fresh folder."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}".replace("file:", "")
    os.makedirs(base)
    for i, values in enumerate(parts):
        pq.write_table(pa.table({"text": pa.array(values, pa.string())}),
                       f"{base}/part-{i:03d}.parquet", row_group_size=2)
    return base


def expected_order(parts):
    out = []
    for values in parts:
        out.extend(v for v in values if v)
    return out


def test_dense_index_across_files_and_blocks(spark):
    parts = [["a", None, "b", "", "c", "d", "e"], ["f", "g", "", "h"], ["i"]]
    path = shards(spark, parts)
    df = drop_empty_text(scan_corpus(spark, path))
    got = sample_index(df, block_rows=2).orderBy("sample_index").select("sample_index", "text").collect()
    assert [r.text for r in got] == expected_order(parts)
    assert [r.sample_index for r in got] == list(range(len(got)))


def test_skip_count_and_whitespace_kept(spark):
    path = shards(spark, [[None, "", "  \n", "x"]])
    df = scan_corpus(spark, path)
    assert df.agg(skipped_count(df).alias("s")).first().s == 2
    assert [r.text for r in drop_empty_text(df).collect()] == ["  \n", "x"]


def test_max_samples(spark):
    path = shards(spark, [["a", "", "b", "c", "d"]])
    s = sample_index(drop_empty_text(scan_corpus(spark, path)))
    assert max_samples(s, 0).count() == 0
    assert sorted(r.text for r in max_samples(s, 3).collect()) == ["a", "b", "c"]
    assert max_samples(s, None).count() == 4
    with pytest.raises(ValueError):
        max_samples(s, -1)


def test_empty_folder_raises(spark):
    with pytest.raises(FileNotFoundError):
        scan_corpus(spark, f"{checkpoint_dir(spark)}/nothing-{uuid.uuid4().hex}")


def test_first_n_in_file_order(spark):
    parts = [["a", "b"], ["c", "d"]]
    path = shards(spark, parts)
    assert [r.text for r in first_n(scan_corpus(spark, path), 3).collect()] == ["a", "b", "c"]


def test_position_columns(spark):
    df = scan_corpus(spark, "/root/testdata/sf0.001/documents.parquet")
    r = df.where(F.col("doc_id") == 5).select("source_row").first()
    assert r.source_row == 5


@pytest.mark.parametrize("limit", [0, 1, 3, 5, 8, 100])
def test_limit_prunes_blocks_with_same_result(spark, limit):
    parts = [["a", None, "b", "", "c", "d", "e"], ["f", "g", "", "h"], ["i"]]
    path = shards(spark, parts)
    df = drop_empty_text(scan_corpus(spark, path))
    full = sample_index(df, block_rows=2).where(F.col("sample_index") < limit)
    pruned = sample_index(df, block_rows=2, limit=limit)
    assert sorted([(r.sample_index, r.text) for r in full.collect()], key=str) == \
        sorted([(r.sample_index, r.text) for r in pruned.collect()], key=str)
    assert pruned.count() == min(limit, 9)


def test_file_names_sort_as_plain_names(spark):
    import os
    base = shards(spark, [["first"], ["second"], ["third"]])
    for old, new in (("part-000", "a b"), ("part-001", "a!b"), ("part-002", "a+é")):
        os.rename(f"{base}/{old}.parquet", f"{base}/{new}.parquet")
    got = sample_index(scan_corpus(spark, base)).orderBy("sample_index").collect()
    assert [r.text for r in got] == ["first", "second", "third"]


def _positions(spark, rows):
    return spark.createDataFrame(rows, "source_file string, source_row long, text string")


@pytest.mark.parametrize("block_rows", [1, 7, 64, 4096, 32768])
def test_index_counts_every_kind_of_block(spark, block_rows):
    """Full blocks, few and many missing rows, blocks without any row."""
    import random
    rng = random.Random(3)
    rows = [("f/a", i, "x") for i in range(5000)]
    rows += [("f/b", i, "x") for i in range(6000) if rng.random() < 0.99]
    rows += [("f/c", i, "x") for i in range(6000) if rng.random() < 0.3]
    rows += [("f/d", i, "x") for i in (70_000, 70_001, 140_000)]
    wanted = {r[:2]: i for i, r in enumerate(rows)}
    got = sample_index(_positions(spark, rows).repartition(5), block_rows=block_rows).collect()
    assert {(r.source_file, r.source_row): r.sample_index for r in got} == wanted and len(got) == len(rows)


def _exchanges(df, column):
    """Shuffles of the final plan whose rows hold ``column``."""
    import re
    df.collect()
    details = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = re.findall(r"\(\d+\) (?:ShuffleQueryStage|Exchange)\n(.*?)\n\n", details, flags=re.S)
    return [n for n in nodes if column in n]


def test_no_exchange_carries_text_at_one_percent_empty(spark):
    parts = [[None if (i * 7 + p) % 100 == 0 else f"text {p} {i}" for i in range(2000)] for p in range(3)]
    path = shards(spark, parts)
    df = sample_index(drop_empty_text(scan_corpus(spark, path)))
    assert not _exchanges(df, "text") and _exchanges(df.repartition(3, "text"), "text")
    assert [r.text for r in df.orderBy("sample_index").collect()] == expected_order(parts)


def test_groups_of_files_give_the_same_index(spark, monkeypatch):
    from talkmill.sources import corpus
    parts = [[f"{p} {i}" if i % 9 else "" for i in range(50)] for p in range(8)]
    path = shards(spark, parts)
    monkeypatch.setattr(corpus.join_in_place, "__defaults__", (300,))
    df = sample_index(drop_empty_text(scan_corpus(spark, path)))
    assert df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") > 1
    assert not _exchanges(df, "text")
    assert [r.text for r in df.orderBy("sample_index").collect()] == expected_order(parts)
    monkeypatch.setattr(corpus, "IN_PLACE_GROUPS", 1)
    again = sample_index(drop_empty_text(scan_corpus(spark, path)))
    assert [r.text for r in again.orderBy("sample_index").collect()] == expected_order(parts)


def test_offsets_are_small(spark):
    from talkmill.sources.corpus import _blocks, _offsets
    rows = spark.range(32768 * 20).select(F.lit("f").alias("source_file"), F.expr("id div 32768").alias("_blk"),
                                          F.expr("id % 32768").alias("_pos")).where("_pos % 5000 != 4999")
    table, size = _offsets(_blocks(rows, 32768))
    assert size < 100 * 20
    table = table.select(F.explode("blocks").alias("e")).select("e.*")
    assert table.where("bits is not null").count() == 0 and table.agg(F.max(F.size("gaps"))).first()[0] == 6
