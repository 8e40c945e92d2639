import zlib

from pyspark.sql import functions as F

from talkmill.llm.sharding import _sample, shard


def _size():
    return F.octet_length(F.coalesce("text", F.lit(""))) + 16


def _check(rows, n):
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], []).append(r)
    for own in sizes.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert set(sizes) <= set(range(n))
    return {s: sum(r["size"] for r in own) for s, own in sizes.items()}


def test_odd_rows_are_all_placed(odd_docs):
    out = shard(odd_docs.withColumn("size", _size()), 3, F.col("size"), F.col("text"), "doc_id")
    rows = out.collect()
    assert len(rows) == odd_docs.count() and "block" in out.columns
    _check(rows, 3)


def test_empty_table_and_own_column_names(no_docs, odd_docs):
    assert shard(no_docs, 4, _size(), F.col("text"), "doc_id").count() == 0
    named = odd_docs.withColumn("shard", F.lit("old")).withColumn("slot", F.lit("old"))
    assert dict(shard(named, 2, _size(), F.col("text"), "doc_id").dtypes)["shard"] == "int"


def test_sizes_are_near_equal_with_a_hot_text_and_large_records(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same words " * 20))
        .when(F.col("id") % 500 == 1, F.repeat(F.lit("long "), 4000))
        .otherwise(F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), (F.col("id") % 40).cast("int")))
        .alias("text")).withColumn("size", _size())
    out = shard(docs, 10, F.col("size"), F.col("text"), "doc_id", samples=200).collect()
    assert len(out) == 3000 and len({r["doc_id"] for r in out}) == 3000
    sums = _check(out, 10)
    largest = max(r["size"] for r in out)
    assert max(sums.values()) - min(sums.values()) <= 2 * largest


def test_columns_named_like_the_operators_own_are_kept(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("mine").alias("_key"),
                                  F.lit("size").alias("_size"), F.lit("x").alias("_row"), F.lit(1.5).alias("a.b"))
    out = shard(docs, 3, F.col("doc_id") + 1, F.col("text"), "doc_id")
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert {(r["_key"], r["_size"], r["_row"], r["a.b"]) for r in out.collect()} == {("mine", "size", "x", 1.5)}


def test_placement_equals_a_plain_walk_over_the_sorted_keys(spark):
    docs = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("text"),
        (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("size"), F.xxhash64(F.when(F.col("id") % 3 == 0, "hot").otherwise(
            (F.col("id") % 97).cast("string"))).alias("hash"))
    rows = sorted(docs.collect(), key=lambda r: (r["hash"], r["doc_id"]))
    total, upto, slots, want = sum(r["size"] for r in rows), 0, {}, {}
    for r in rows:
        upto += r["size"]
        own = min((upto - r["size"] // 2) * 7 // total, 6)
        want[r["doc_id"]] = (own, slots.get(own, 0))
        slots[own] = slots.get(own, 0) + 1
    got = shard(docs, 7, F.col("size"), F.col("text"), "doc_id", samples=100).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want


def test_the_sample_leaves_the_tasks_below_a_threshold(spark):
    keyed = spark.range(40_000, numPartitions=20).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("_key"))
    few = _sample(keyed, F.lit(1.0), 40_000.0, 200, 0)
    assert len(few) == 200
    every = _sample(keyed, F.lit(1.0), 1e-300, 200, 0)  # no threshold: the same keys
    assert few == every


def test_overfull_ranges_are_cut_again(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"),
                                    F.when(F.col("id") < 1990, 1).otherwise(100).alias("size"))
    out = shard(docs, 4, F.col("size"), F.col("text"), "doc_id", samples=32).collect()
    sums = _check(out, 4)
    assert max(sums.values()) - min(sums.values()) <= 200


def test_crc_is_unsigned_utf8(spark):
    text = "naïve 日本"
    got = spark.createDataFrame([(text,)], "t string").select(F.crc32(F.col("t").cast("binary"))).first()[0]
    assert got == zlib.crc32(text.encode())
