from talkmill.operators.vocab import (build_vocabulary, decode_ids, encode_ids,
                                      normalize_tokens, pick_token_column)


def test_vocab_order_and_round_trip(spark, texts):
    docs = texts(["the cat the", "a cat", "zebra"])
    v = build_vocabulary(docs).collect()
    ids = {r.token: r.id for r in v}
    counts = sorted(((-r["count"], r.token) for r in v))
    assert [ids[t] for _, t in counts] == list(range(len(v)))
    enc = encode_ids(docs, build_vocabulary(docs), "id")
    dec = {r.id: r.text for r in decode_ids(enc, build_vocabulary(docs), "id").collect()}
    assert dec == {0: "the cat the", 1: "a cat", 2: "zebra"}


def test_normalize_tokens_cases(spark):
    df = spark.createDataFrame([([1, 2],), ([],), ([1, None],)], "t ARRAY<BIGINT>")
    got = [r.n for r in df.select(normalize_tokens("t").alias("n")).collect()]
    assert got == [[1, 2], None, None]
    s = spark.createDataFrame([(["7"],), (["x"],)], "t ARRAY<STRING>")
    assert [r.n for r in s.select(normalize_tokens("t").alias("n")).collect()] == [[7], None]
    f = spark.createDataFrame([([1.9, -2.5],)], "t ARRAY<DOUBLE>")
    assert f.select(normalize_tokens("t").alias("n")).first().n == [1, -2]


def test_pick_token_column_order(spark):
    df = spark.createDataFrame(
        [([], [5, 6], [9], "txt"), ([1], None, None, "txt"), (None, None, None, " "),
         (None, None, None, "body")],
        "tokens ARRAY<INT>, input_ids ARRAY<INT>, my_ids ARRAY<INT>, text STRING")
    got = [(r.token_source, r.token_ids) for r in pick_token_column(df).collect()]
    assert got == [("input_ids", [5, 6]), ("tokens", [1]), (None, None), ("text", None)]


def test_unknown_pieces_and_documents_without_pieces_are_kept(spark, texts):
    import pytest
    docs = texts(["the cat the", "zzz the", "", None])
    enc = encode_ids(docs, build_vocabulary(texts(["the cat the"])), "id")
    got = {r.id: r.ids for r in enc.collect()}
    assert len(got) == 4 and got[2] == got[3] == []
    assert got[1][0] == -1 and len(got[1]) == 2
    v = build_vocabulary(texts(["the cat the"]))
    back = {r.id: r.text for r in decode_ids(enc.where("id <> 1"), v, "id").collect()}
    assert back == {0: "the cat the", 2: "", 3: ""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode_ids(enc, v, "id").collect()


def test_blocks_of_few_items_give_the_same_ids_row_by_row(spark):
    from pyspark.sql import functions as F

    from talkmill.functions.text import tokenize
    from talkmill.operators.blocks import item_counts, look_up, number_items
    from talkmill.operators.vocab import piece_blocks
    rows = [(1, "the cat the"), (1, "the"), (None, "a cat"), (4, ""), (5, None), (6, "the the the the the")]
    docs = spark.createDataFrame(rows, "id BIGINT, text STRING").coalesce(1)
    v = build_vocabulary(docs).cache()
    assert v.orderBy("id").collect() == build_vocabulary(docs, pieces=piece_blocks(docs)).orderBy("id").collect()
    dec = decode_ids(encode_ids(docs, v, "id", keep=["text"]).withColumnRenamed("text", "own"), v, "id", keep=["own"])
    # a repeated key keeps its rows apart, a null one keeps its row
    assert sorted((r.id or 0, r.own or "", r.text) for r in dec.collect()) == sorted(
        (i or 0, t or "", t or "") for i, t in rows)
    small = number_items(docs, tokenize("text"), ["id"], block_items=3)
    assert small.select("_block").distinct().count() > 2
    sums = look_up(small, v, "token", F.col("count"), lambda rows, at, codes, values: [
        [int(values.take(codes[a:b]).to_numpy().sum()) if b > a else 0 for a, b in zip(at, at[1:])]], "s long")
    n = {r.token: r["count"] for r in v.collect()}
    assert {r["item"]: r.n for r in item_counts(small).collect()} == n
    assert sorted((r.id or 0, r.s) for r in sums.collect()) == sorted(
        (r.id or 0, sum(n[p] for p in r.p or [])) for r in docs.select("id", tokenize("text").alias("p")).collect())
