import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.llm import packing
from talkmill.llm.packing import mixtures, pack
from talkmill.llm.subwords import BytePairEncoder


@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 300), max_size=6),
       st.one_of(st.none(), st.dictionaries(st.sampled_from("abcdef"), st.floats(0, 1), max_size=6)), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_mixtures_place_every_token_once(totals, shares, window):
    plan = mixtures(totals, shares, window)
    places = []
    for q, n in totals.items():
        at = 0
        for m in plan:
            for start, to, count in m.runs(q, at, n):
                assert start == at
                places += range(to, to + count)
                at += count
        assert at == n
    assert sorted(places) == list(range(sum(totals.values())))


def test_windows_have_the_wanted_shares():
    plan = mixtures({"a": 1000, "b": 3000}, {"a": 0.5, "b": 0.5}, 100)
    assert plan[0].length == 2000
    for w in range(20):
        assert plan[0].taken("a", 100 * (w + 1)) - plan[0].taken("a", 100 * w) == 50


@pytest.fixture(scope="module")
def bpe(vocabularies):
    return vocabularies("byte_bpe_50k.json")


def _library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return lambda s: t.encode(s, add_special_tokens=False).ids


@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sré日🙂. \x85\x1c5"), st.characters(codec="utf-8")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoder_has_the_library_ids(bpe, text):
    assert BytePairEncoder.of(bpe).encode(text).tolist() == _library(bpe)(text)


def test_special_strings_have_the_library_ids(bpe):
    for text in ("<|endoftext|>", "a <|endoftext|> b<|endoftext|>"):
        assert BytePairEncoder.of(bpe).encode(text).tolist() == _library(bpe)(text)


def _pieces(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r["doc_id"], r["doc_tokens"])].append(r)
    return out


def test_every_id_lies_in_one_piece(odd_docs, bpe):
    encode = _library(bpe)
    docs = odd_docs.dropDuplicates(["doc_id"])
    rows = pack(docs, "doc_id", "text", "source", bpe, with_ids=True, window=2048).collect()
    wanted = {r["doc_id"]: np.array(encode(r["text"] or "") + [0], "<u4") for r in docs.collect()}
    for (doc, n), own in _pieces(rows).items():
        own.sort(key=lambda r: r["start"])
        ids = wanted.pop(doc)
        assert n == len(ids) and b"".join(bytes(r["ids"]) for r in own) == ids.tobytes()
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    assert not wanted
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for s, o, n in places:
        assert s * 1024 + o == at and o + n <= 1024
        at += n


def test_repeated_rows_shares_and_empty_table(odd_docs, no_docs, bpe):
    rows = pack(odd_docs, "doc_id", "text", "source", bpe, shares={"a": 0.9, "b": 0.1}).collect()
    assert sum(r["doc_id"] == 1 and r["start"] == 0 for r in rows) == 2
    assert pack(odd_docs, "doc_id", "text", None, bpe, end_id=None).where("doc_id = 4").count() == 0
    assert pack(no_docs, "doc_id", "text", "source", bpe).count() == 0


@pytest.mark.parametrize("shares", [None, {"s11": 0.5}])
def test_any_number_of_sources(spark, vocabularies, monkeypatch, shares):
    """Sources beyond the largest ones are packed whole from one queue."""
    bpe = vocabularies("byte_bpe_50k.json")
    rows = [(i, f"text {i} " * (1 + 40 * (i % 12 < 2)), None if i % 12 == 5 else f"s{i % 12}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    out = packing.pack(docs, "doc_id", "text", "source", bpe, shares=shares, length=32, window=512,
                       with_ids=True).collect()
    out.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    upto = 0
    for r in out:
        assert r["sequence_id"] * 32 + r["offset"] == upto
        upto += r["length"]
    parts = {}
    for r in sorted(out, key=lambda r: r["start"]):
        parts[r["doc_id"]] = parts.get(r["doc_id"], b"") + bytes(r["ids"])
    encoder = packing.BytePairEncoder.of(bpe)
    assert parts == {i: encoder.encode(t).astype("<u4").tobytes() + bytes(4) for i, t, _ in rows}
    assert {(r["doc_id"], r["source"]) for r in out} == {(i, s) for i, _, s in rows}
    if shares is None:
        total = sum(r["length"] for r in out)
        big = sum(r["length"] for r in out if r["source"] == "s0")
        first = sum(r["length"] for r in out if r["source"] == "s0" and r["sequence_id"] < 16)
        assert abs(first - 512 * big / total) <= 4
