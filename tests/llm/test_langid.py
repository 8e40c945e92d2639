import numpy as np
import pyarrow as pa
import pytest

from talkmill.llm import langid
from talkmill.llm.common import text_bytes


def _corpus(spark, n=120):
    rng = np.random.default_rng(2)
    parts = {"en": "the of and ing tion er on at".split(), "de": "der die sch ung keit ich ein und".split(),
             "fr": "le la eux ment que ou ais une".split()}
    rows = []
    for lang, p in parts.items():
        for _ in range(n):
            words = ["".join(rng.choice(p, rng.integers(1, 4))) for _ in range(rng.integers(5, 60))]
            rows.append((len(rows), " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = _corpus(spark)
    network = langid.train(docs.where("doc_id % 4 != 2"), "doc_id", "text", "lang", train_docs=60)
    out = langid.predict(docs.where("doc_id % 4 = 2"), network, "text").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_odd_rows(spark, odd_docs, no_docs):
    network = langid.train(_corpus(spark, 20), "doc_id", "text", "lang")
    out = langid.predict(odd_docs, network, "text")
    assert out.columns.count("score") == 1 and "ids" in out.columns
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert len(got) == 11
    for doc, text in ((3, None), (4, ""), (5, "   \n\t "), (9, "12345 --- 678")):
        assert (got[doc, text]["lang_pred"], got[doc, text]["score"]) == ("und", 0.0)
    assert got[7, got_text(got, 7)]["lang_pred"] in {"en", "de", "fr"}
    assert langid.predict(no_docs, network, "text").count() == 0


def got_text(got, doc):
    return next(t for d, t in got if d == doc)


def test_letters_of_other_scripts_count(spark):
    network = langid.train(_corpus(spark, 10), "doc_id", "text", "lang")
    out = langid.predict(spark.createDataFrame([("日本",), ("🙂 12",)], "text string"), network, "text").collect()
    assert [r["lang_pred"] == "und" for r in out] == [False, True]


def test_without_labels_all_is_undetermined(no_docs, odd_docs):
    assert langid.train(no_docs, "doc_id", "text", "lang") is None
    assert {r["lang_pred"] for r in langid.predict(odd_docs, None, "text").collect()} == {"und"}


def test_windows_cover_every_byte():
    data = np.arange(1000, dtype=np.int64).astype(np.uint8)
    offsets = np.array([0, 0, 5, 128, 600, 1000])
    first, sizes, text = langid.windows(data, offsets)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(first, sizes)])
    assert covered.tolist() == list(range(1000)) and set(text) == {1, 2, 3, 4}


def test_gradients_match_differences():
    net = langid.Network(["a", "b"])
    rng = np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(97, 105, (langid.WINDOW, 6)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    g = net.gradients(x, y)

    def loss():
        net._tables = {w: np.einsum("be,wef->wbf", net.p["emb"], net.p[f"f{w}"]) for w in langid.WIDTHS}
        return -net.log_probabilities(x)[np.arange(6), y].mean()

    for k, at in (("out", (3, 1)), ("f3", (1, 2, 4)), ("emb", (100, 3)), ("b2", (5,))):
        own = net.p[k][at]
        net.p[k][at] = own + 1e-4
        up = loss()
        net.p[k][at] = own - 1e-4
        down = loss()
        net.p[k][at] = own
        assert abs((up - down) / 2e-4 - g[k][at]) < 1e-3


def test_more_than_a_thousand_languages(spark, monkeypatch):
    rows = [(i, f"text number {i} of its own tongue", f"l{i % 1100:04d}") for i in range(2200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "EPOCHS", 1)
    network = langid.train(docs, "doc_id", "text", "lang", train_windows=1, sample_docs=1100)
    assert len(network.languages) == 1100
    found = langid.predict(docs.limit(50), network, "text").collect()
    assert len(found) == 50 and {r["lang_pred"] for r in found} <= set(network.languages)
    assert all(0 < r["score"] <= 1 for r in found)


def test_texts_are_summed_in_parts_alike(spark, monkeypatch):
    network = langid.Network(["a", "b", "c"])
    texts = pa.array(["one two " * i for i in range(40)] + [None, ""])
    data, offsets = text_bytes(texts)
    whole = langid._classify(network, data, offsets, texts)
    monkeypatch.setattr(langid, "SUMS_AT_ONCE", 12)
    parts = langid._classify(network, data, offsets, texts)
    assert parts[0] == whole[0] and parts[1] == pytest.approx(whole[1], abs=1e-6)
