import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.llm import pieces


@pytest.fixture(scope="module")
def path(vocabularies):
    return vocabularies("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model(path):
    return pieces.PieceModel(path)


@pytest.fixture(scope="module")
def library(path):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=path)


ODD = ["a  b", " a", "a ", "ﬁ Å", "", "\n\tx\x00", "<s> </s> <unk>", "  ", " " * 40 + "x", "門 門  門", "😀͸ x",
       "thequickbrownfox" * 300, "https://www.example.com/" * 20, " " * 15, " " * 33 + "門", "x" * 3000]


def _ids(model, text):
    return np.frombuffer(pieces.Encoder(model).encode(text), "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_ids_of_the_library(model, library, text):
    assert _ids(model, text) == library.encode(text)


@given(st.text(alphabet=st.one_of(st.sampled_from("abthein \n%é門😀▁"), st.characters(codec="utf-8")), max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_of_the_library_on_any_text(model, library, text):
    assert _ids(model, text) == library.encode(text)


def test_unigram_search_finds_the_largest_sum(path):
    model = pieces.PieceModel(path, unigram=True)
    encoder = pieces.Encoder(model)
    for text in ("▁thequickbrown", "▁international", "▁abc" * 40):
        best = [(0.0, [])]  # all places kept, no commits
        for i in range(1, len(text) + 1):
            best.append(max((best[j][0] + model.score[model.rank[text[j:i]]], best[j][1] + [text[j:i]])
                            for j in range(max(0, i - model.longest), i) if text[j:i] in model.rank))
        got = encoder.search(text)
        assert sum(model.score[model.ids.index(i)] for i in got) == pytest.approx(best[-1][0])


def test_commits_keep_the_window_bounded(model, monkeypatch):
    text = "▁" + "internationalisation" * 200
    want = pieces.Encoder(model).search(text)
    monkeypatch.setattr(pieces, "COMMIT_EVERY", 1)
    assert pieces.Encoder(model).search(text) == want
    monkeypatch.setattr(pieces, "COMMIT_EVERY", 10 ** 9)
    assert pieces.Encoder(model).search(text) == want


def test_round_trip_and_odd_rows(odd_docs, no_docs, model, spark):
    out = pieces.decode(pieces.encode(odd_docs, "text", model), "ids", model)
    rows = out.collect()
    assert len(rows) == 12 and out.columns.count("ids") == 1 and "block" in out.columns
    assert all(r["decoded"] == r["text"] for r in rows)
    assert all((r["ids"] is None) == (r["text"] is None) for r in rows)
    assert pieces.encode(no_docs, "text", model).count() == 0
    texts = spark.createDataFrame([(t,) for t in ODD], "text string")
    assert all(r["decoded"] == r["text"] for r in pieces.decode(pieces.encode(texts, "text", model), "ids", model).collect())


def test_cache_generations(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 2)
    encoder = pieces.Encoder(model)
    first = encoder.encode("one two three four one two")
    assert encoder.encode("one two three four one two") == first and len(encoder.words) <= 2
