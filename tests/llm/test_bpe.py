import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.llm import bpe, queries
from talkmill.llm.common import text_bytes


@pytest.fixture(scope="module")
def path(vocabularies):
    return vocabularies("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model(path):
    return bpe.BytePairs(path)


@pytest.fixture(scope="module")
def encoder(model):
    return bpe.Encoder(model)


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _same(encoder, library, texts):
    ids, at = encoder.encode(*text_bytes(pa.array(texts, pa.string())))
    for text, a, z in zip(texts, at, at[1:]):
        assert ids[a:z].tolist() == library.encode(text, add_special_tokens=False).ids, text[:200]
    assert bpe.decode_ids(encoder.m, ids, at) == texts


ODD = ["a  b", " a", "a ", "", "\n\tx\x00", "  ", " " * 40 + "x", "don't you've we'll 's 'strange '", "'", "x'",
       "'l", "a 's", "\"'s", "a'\n's", "日本語テキスト" * 30, "x" * 3000, "ab" * 2000, "a\x85b\xa0 c  　d",
       "<|endoftext|>", " <|endoftext|> a<|endoftext|><|endoftext|>  ", "<|endoftext", "ﬁ Å ͸ ½ ²", "12 3x4"]


def test_ids_of_the_library(encoder, library):
    _same(encoder, library, ODD)
    for text in ODD:
        _same(encoder, library, [text])


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdmtlvreé日🙂.\x855<|>"),
                                           st.characters(codec="utf-8")), max_size=60), max_size=4))
@settings(max_examples=300, deadline=None)
def test_ids_of_the_library_on_any_text(encoder, library, texts):
    _same(encoder, library, texts)


def test_every_character_has_the_library_class(encoder, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    _same(encoder, library, ["".join(points), "a".join(points[:70000]), "1".join(points[:70000])])


def test_long_words_and_texts(encoder, library, monkeypatch):
    rng = random.Random(5)
    word = "".join(rng.choice("abcdefgh") for _ in range(5000))
    _same(encoder, library, [word, "a" + word, word + " " + "z" * 1500])
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 64)
    text = "".join(rng.choice(["one", " ", "  ", "'s", "\n", "日本", " 12", "<|endoftext|>"]) for _ in range(3000))
    _same(encoder, library, [text])
    _same(encoder, library, ["日" * 500])


def test_any_ids_are_decoded_as_by_the_library(model, library):
    ids = np.random.default_rng(3).integers(0, 50257, 4000).astype(np.uint32)
    at = np.arange(0, 4001, 8)
    assert bpe.decode_ids(model, ids, at) == [
        library.decode(ids[a:a + 8].tolist(), skip_special_tokens=False) for a in at[:-1]]
    assert bpe.decode_ids(model, np.array([60000, 0], np.uint32), np.array([0, 2])) == ["!"]


def test_tables(odd_docs, no_docs, model, library):
    docs = odd_docs.withColumnRenamed("block", "_0").withColumnRenamed("source", "_source")
    out = bpe.decode(bpe.encode(docs, "text", model), "ids", model)
    both = bpe.encode_and_decode(docs, "text", model)
    assert sorted(map(str, out.collect())) == sorted(map(str, both.collect()))
    assert both.columns == ["doc_id", "text", "lang", "_source", "_0", "score", "ids", "decoded"]
    rows = both.collect()
    assert len(rows) == odd_docs.count() and sum(r["doc_id"] == 1 for r in rows) == 2
    for r in rows:
        assert r["decoded"] == r["text"] and (r["ids"] is None) == (r["text"] is None)
        assert r["_0"] == (None if r["doc_id"] is None else r["doc_id"] * 10)
        if r["text"] is not None:
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"], add_special_tokens=False).ids
    assert bpe.encode_and_decode(no_docs, "text", model).count() == 0


def test_query_equals_the_library(spark, library, tmp_path, odd_docs):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(r) for r in queries.op13_bpe(spark, str(tmp_path)).collect()]
    wanted = []
    for r in odd_docs.collect():
        text = r["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(found, key=str) == sorted(wanted, key=str)
