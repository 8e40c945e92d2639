import hashlib
import random

import numpy as np
import pytest

from talkmill.llm.repeats import remove_repeats
from talkmill.llm.suffix_sort import DEPTH, share_prefix, suffix_order


def brute(docs, length):
    """{doc: (bytes, removed, spans, kept)}; a byte goes if a string that
    covers it was met before."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        spans, at = [], 0
        while at < len(b):
            if gone[at]:
                stop = at
                while stop < len(b) and gone[stop]:
                    stop += 1
                spans.append((at, stop))
                at = stop
            else:
                at += 1
        out[d] = (len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def _got(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], [(s["start"], s["stop"]) for s in r["spans"]], bytes(r["kept"]))
            for r in rows}


def _corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 40, 60, 100)]
    texts = []
    for _ in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        texts.append(" ".join(parts))
    texts += texts[:15] + [None, "", "x", "ab" * 400, "ab" * 90, "z" * 500, "Chgeä " * 100, "z" * 99, "z" * 100]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot,bucket,sorted_bytes", [(50_000, 400_000, 4 << 20), (3, 50, 2000), (50_000, 100, 1)])
def test_equals_brute_force(spark, hot, bucket, sorted_bytes):
    docs = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = remove_repeats(df, "doc_id", "text", 100, hot, bucket, sorted_bytes)
    assert _got(out.collect()) == brute(docs, 100)


def test_odd_rows_and_kept_columns(odd_docs, no_docs):
    out = remove_repeats(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]), "doc_id", "text", 40,
                         keep=("block", "ids", "score", "lang")).collect()
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    assert _got(out) == brute(docs, 40)
    assert {r["row"]["block"] for r in out} == {d * 10 for d, _ in docs} and {r["row"]["ids"] for r in out} == {"x"}
    whole = remove_repeats(odd_docs, "doc_id", "text", 40).collect()
    assert len(whole) == 12 and sum(r["n_removed"] == r["n_bytes"] > 0 for r in whole) >= 2
    assert remove_repeats(no_docs, "doc_id", "text").count() == 0


def test_whole_characters(spark):
    shared = "é" * 60
    docs = [(1, "a" + shared), (2, "à" + shared[:-1] + "ü")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    exact = _got(remove_repeats(df, "doc_id", "text", 100).collect())
    assert exact == brute(docs, 100)
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in remove_repeats(
        df, "doc_id", "text", 100, whole_characters=True).collect()}
    assert all(set(t) <= set("aàüé") for t in kept.values())


def test_length_is_checked(no_docs):
    with pytest.raises(ValueError):
        remove_repeats(no_docs, "doc_id", "text", 20)


@pytest.mark.parametrize("seed", range(12))
def test_suffix_order_and_shared_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 98 + seed % 4, int(rng.integers(1, 500))).astype(np.uint8)
    if seed % 3 == 0:
        text = np.tile(text[:max(1, len(text) // 5)], 5)
    wanted = rng.random(len(text)) < rng.random()
    b = text.tobytes() + b"\x00\xff" + bytes(10)
    order = suffix_order(text, wanted)
    assert sorted(order) == np.flatnonzero(wanted).tolist()
    assert [b[i:i + DEPTH] for i in order] == sorted(b[i:i + DEPTH] for i in np.flatnonzero(wanted))
    fits = np.array([i for i in order if i + 30 <= len(text)], np.int64)
    same = share_prefix(text, fits, 30)
    assert same.tolist()[1:] == [b[i:i + 30] == b[j:j + 30] for i, j in zip(fits, fits[1:])]


def test_digest_of_kept_bytes(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "y" * 300)], "doc_id long, text string")
    row = remove_repeats(df, "doc_id", "text").select(F.sha2("kept", 256).alias("h"), F.size("spans").alias("n")).first()
    assert row["h"] == hashlib.sha256(b"y" * 0 + brute([(1, "y" * 300)], 100)[1][3]).hexdigest() and row["n"] == 1
