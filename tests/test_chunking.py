import math

import pytest
from pyspark.sql import functions as F

from talkmill.functions.text import tokenize
from talkmill.operators.chunking import ChunkConfig, chunk_windows


def words(n):
    # " w" pieces: one lexer token each
    return "".join(" w" for _ in range(n))


def run(texts, values, cfg):
    df = texts(values)
    return chunk_windows(df, "text", cfg, keep=["id"]).orderBy("id", "chunk_index").collect()


@pytest.mark.parametrize("n,expected", [(500, [500, 50]), (451, [451, 1]), (450, [450]),
                                        (1000, [500, 500, 100]), (1, [1])])
def test_window_counts(texts, n, expected):
    rows = run(texts, [words(n)], ChunkConfig())
    assert [r.context_tokens for r in rows] == expected
    assert [r.chunk_index for r in rows] == list(range(len(expected)))


def test_starts_and_overlap(texts):
    rows = run(texts, [words(1000)], ChunkConfig())
    assert rows[1].context == words(1000)[450 * 2: 950 * 2]
    assert rows[2].context == words(1000)[900 * 2:]


def test_zero_overlap(texts):
    text = "".join(f" {chr(97 + i)}" for i in range(10))  # ten one-letter words
    rows = run(texts, [text], ChunkConfig(5, 0))
    assert [r.context_tokens for r in rows] == [5, 5]
    assert rows[0].context + rows[1].context == text


def test_empty_and_whitespace(texts):
    rows = run(texts, ["", "  \n"], ChunkConfig())
    assert [(r.id, r.context) for r in rows] == [(1, "  \n")]


def test_drop_redundant_tail(texts):
    rows = run(texts, [words(500)], ChunkConfig(drop_redundant_tail=True))
    assert [r.context_tokens for r in rows] == [500]


@pytest.mark.parametrize("size,overlap", [(0, 0), (10, -1), (10, 10)])
def test_bad_config(size, overlap):
    with pytest.raises(ValueError):
        ChunkConfig(size, overlap)


def test_properties_on_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("id"), "text")
    cfg = ChunkConfig(120, 20)
    ch = chunk_windows(docs, "text", cfg, keep=["id"])
    n = {r.id: r.n for r in docs.select("id", F.size(tokenize("text")).alias("n")).collect()}
    got = {}
    for r in ch.collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.context))
    for doc_id, parts in got.items():
        parts.sort()
        assert len(parts) == math.ceil(n[doc_id] / cfg.stride)
    # dropping the overlaps rebuilds the text
    text = {r.id: r.text for r in docs.collect()}
    toks = {r.id: r.t for r in docs.select("id", tokenize("text").alias("t")).collect()}
    for doc_id, parts in got.items():
        rebuilt = "".join("".join(toks[doc_id][i * cfg.stride: i * cfg.stride + cfg.stride])
                          for i, _ in parts)
        assert rebuilt == text[doc_id]
        for i, ctx in parts:
            assert ctx == "".join(toks[doc_id][i * cfg.stride: i * cfg.stride + cfg.chunk_size])
