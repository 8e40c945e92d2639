import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill.llm import phrases, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def _brute(rows, longest=3, least=10, share=50, top=2000):
    """Counts of all contiguous phrases, held as text, with whole numbers."""
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in often.items():
            for k in range(2, len(p)):
                covered.update(p[i:i + k] for i in range(len(p) - k + 1) if 100 * a >= share * f[p[i:i + k]])
        found = []
        for p, a in often.items():
            if p not in covered:
                score, _, left, right = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _prose(seed, n):
    rng = random.Random(seed)
    fixed = ["New York city", "to be or not to be that is the question", "a a a a", "Straße über Äpfel", "x"]
    vocabulary = [f"w{i}" for i in range(25)] + fixed * 2
    for _ in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "  \t", ", ", ". ", "\n", "\x0b", "\xa0"])
                       for _ in range(rng.randrange(60)))
        yield text, rng.choice(["en", "en", "en", "de", None])


@pytest.fixture(scope="module")
def corpus():
    rows = list(_prose(1, 150)) + [(None, "en"), ("", "fr"), (" . ,", "fr"), ("one two", "und")]
    return rows + rows[:20]


def _table(spark, rows):
    return spark.createDataFrame([(t, x, 1, "b", 2.0) for t, x in rows],
                                 "text string, lang string, w1 int, f string, score double").repartition(3)


@pytest.mark.parametrize("options", [{}, {"longest": 2, "least": 5}, {"longest": 4, "least": 3, "share": 80, "top": 40}])
def test_equals_brute_force(spark, corpus, options):
    found = phrases.mine(_table(spark, corpus), "text", "lang", **options).collect()
    assert sorted(map(tuple, found)) == _brute(corpus, **options)


def test_query_equals_brute_force(spark, corpus, tmp_path):
    _table(spark, corpus).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_phrases(spark, str(tmp_path)).collect()
    assert found and sorted(map(tuple, found)) == _brute(corpus)


def test_paths_hold_every_edge_once(spark, corpus):
    docs = spark.createDataFrame([(x or "und", t) for t, x in corpus], "lang string, text string")
    counts = phrases.phrase_counts(docs, 3, 2, 0)
    nodes, edges = counts[2], counts[3]
    paths = phrases.compact(phrases.with_extensions(nodes, edges, 2), edges, 3).collect()
    found = Counter()
    for r in paths:
        for i in range(len(r["words"]) - 2):
            found[(*r["words"][i:i + 3], r["f"])] += 1
    assert found == Counter((r["w1"], r["w2"], r["w3"], r["f"]) for r in edges.collect())
    assert max(len(r["words"]) for r in paths) >= 6  # to be or not to be


def test_empty_and_odd_tables(spark, odd_docs, no_docs):
    assert phrases.mine(no_docs, "text", "lang").count() == 0
    assert phrases.mine(odd_docs.where("length(text) < 30"), "text", "lang").count() == 0
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, phrases.mine(odd_docs, "text", "lang").collect())) == _brute(rows)
    with pytest.raises(ValueError):
        phrases.mine(odd_docs, "text", longest=1)


def test_a_collision_takes_another_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("a b c, " * 12, "en")], "text string, lang string")
    wanted = _brute([("a b c, " * 12, "en")])
    made, seeds = phrases.dictionary, []

    def colliding(rows, seed):
        seeds.append(seed)
        out = made(rows, seed)
        return out.withColumn("h", F.lit(5).cast("long")) if seed == 0 else out

    monkeypatch.setattr(phrases, "dictionary", colliding)
    assert sorted(map(tuple, phrases.mine(docs, "text", "lang").collect())) == wanted and seeds == [0, 1]


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(10 ** 13 + 7, 10 ** 14 + 3, 3 * 10 ** 13 + 1), (999_999_999_999_999, 10 ** 15, 10 ** 15), (10, 10, 10)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    found = df.select("a", phrases.cohesion(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert {r["a"]: r["s"] for r in found} == {a: 10 ** 6 * a * a // (x * y) for a, x, y in rows}


def test_long_texts_are_cut_at_piece_ends(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 20)
    text = "one two three, four five six. seven eight nine ten eleven twelve thirteen; x"
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    parts = [data.tobytes().decode() for _, data, _ in phrases._parts(iter([batch]))]
    assert len(parts) > 1 and "".join(parts) == text
    assert all(p[0] in ",.;" for p in parts[1:])


@pytest.mark.parametrize("m", [2, 3, 7])
def test_counts_of_edges_nodes_and_packed_buckets(m, monkeypatch):
    rng = np.random.default_rng(0)
    hashes = rng.integers(1, 1 << 63, 3000).astype(np.uint64)[rng.integers(0, 3000, 9000)]
    same = rng.random(9000) < 0.9
    wanted, nodes = Counter(), Counter()
    for i in range(9000):
        key, j = [int(hashes[i])], i
        while len(key) < m and j < 8999 and same[j]:
            j += 1
            key.append(int(hashes[j]))
        key = tuple(key + [0] * (m - len(key)))
        wanted[key] += 2
        nodes[key[:-1]] += 2

    def listed(counts):
        assert len(set(zip(*counts.ids.tolist()))) == len(counts.f)
        return Counter(dict(zip(zip(*counts.words[counts.ids].tolist()), counts.f.tolist())))

    monkeypatch.setattr(phrases, "CHUNK", 4000)
    adder = phrases.Adder()
    for _ in range(2):
        adder.add(phrases.Counts.edges(hashes, same, m))
    whole = adder.take()
    assert listed(whole) == wanted and listed(whole.shorter()) == nodes and adder.take() is None
    again = dict(whole.buckets(7))
    assert len(again) == 7
    back = phrases.Counts.combined([phrases.Counts.unpacked(x) for x in again.values()])
    assert listed(back) == wanted


def test_blocks_without_words():
    none = phrases.Counts.edges(np.zeros(0, np.uint64), np.zeros(0, bool), 3)
    assert len(phrases.Counts.combined([none]).f) == 0 and not list(none.buckets(3))
