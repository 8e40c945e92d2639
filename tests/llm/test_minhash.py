import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from talkmill.llm import common, minhash
from talkmill.llm.components import connected_components
from talkmill.llm.minhash import near_duplicates, shingles


def _sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, percent):
    """{doc: (set size, smallest reachable doc)} by comparing all pairs."""
    sets = {d: _sets(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = defaultdict(list)
    for d, s in sorted(sets.items()):
        both = Counter(o for g in s for o in seen[g])
        for o, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
        for g in s:
            seen[g].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def _family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.random()}"
        out.append(" ".join(w))
    return out


def _corpus(families=((60, 3), (40, 6), (25, 1), (30, 10)), seed=0):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for n, edits in families:
        texts += _family(rng, [rng.choice(words) for _ in range(150)], n, edits)
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(100)]
    texts += texts[:20] + ["Same  Words here", "same words\there", "x"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent,bucket_rows,families", [
    (85, 2000, ((60, 3), (40, 6), (25, 1), (30, 10))),
    (85, 4, ((8, 3), (6, 6)))])  # small buckets only: the rest meets further hubs
def test_components_equal_all_pairs(spark, percent, bucket_rows, families):
    docs = _corpus(families)
    out = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text",
                          percent, bucket_rows).collect()
    want = brute(docs, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_odd_rows(odd_docs, no_docs):
    out = near_duplicates(odd_docs, "doc_id", "text").collect()
    assert len(out) == 12
    by = {r["doc_id"]: r for r in out}
    assert [by[d]["n_shingles"] for d in (3, 4, 5, 8, 10)] == [0, 0, 0, 1, 1]
    assert [by[d]["component_id"] for d in (1, 2, 3, 4, 5, 8, 10)] == [1, 1, 3, 4, 5, 8, 8]
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert near_duplicates(no_docs, "doc_id", "text").count() == 0


def test_shingles_across_documents_of_a_block():
    texts = ["a b c d e f", "", "A B c d e", "x", "a b", "  a\tb  ", "é à b c d e É"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, at = shingles(data, offsets)
    sets = [set(h[a:b].tolist()) for a, b in zip(at, at[1:])]
    assert [len(s) for s in sets] == [len(_sets(t)) for t in texts]
    assert len(sets[0] & sets[2]) == 1 and sets[4] == sets[5] and not sets[3] & sets[4]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:1800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    m = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((m[0] == m[1]).mean() - true) < 0.15


def test_connected_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)] + [(100, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(path + star, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("most", [common.MOST_BITS, 1 << 15])  # few bits: more rows to join, the same result
def test_rows_by_their_ids(spark, most, monkeypatch):
    monkeypatch.setattr(common, "MOST_BITS", most)
    rows = spark.createDataFrame([(i, f"text {i}") for i in [*range(40_000), 7, 8, None]], "doc int, text string")
    ids = common.written(spark.range(0, 40_000, 8).withColumnRenamed("id", "doc"), "test-ids")
    assert {r["doc"] for r in common.among(rows, ids, "doc").collect()} == set(range(0, 40_000, 8))
    left = [r["doc"] for r in common.not_among(rows, ids, "doc").collect()]
    assert len(left) == 35_002 and set(left) == {i for i in range(40_000) if i % 8} | {None}
    none = common.written(ids.limit(0), "test-none")
    assert common.among(rows, none, "doc").count() == 0 and common.not_among(rows, none, "doc").count() == 40_003


def test_few_of_the_other_rows_are_joined(spark):
    ids = common.written(spark.range(0, 200_000, 10).withColumnRenamed("id", "doc"), "test-ids")
    marked, hit = common._perhaps(spark.range(200_000).withColumnRenamed("id", "doc"), ids, "doc")
    hits = {r["doc"] for r in marked.where(hit).select("doc").collect()}
    assert set(range(0, 200_000, 10)) <= hits and len(hits) < 20_000 + 0.08 * 180_000


def _groups(spark, docs, percent=85, **kw):
    out = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", percent, **kw)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()}


def test_passes_do_not_grow_with_a_bucket(spark, monkeypatch):
    merges, merge = [], minhash._merge
    monkeypatch.setattr(minhash, "_merge", lambda *a: merges.append(1) or merge(*a))
    docs = _corpus(((90, 4), (40, 3)))  # much of a group is alike, but below the threshold
    assert _groups(spark, docs, bucket_rows=6) == brute(docs, 85)
    assert len(merges) <= 3


@pytest.mark.parametrize("few,bits", [(0, 1 << 28), (0, 0), (1000, 0)])
def test_all_ways_of_comparing_a_task_agree(spark, monkeypatch, few, bits):
    monkeypatch.setattr(minhash, "_FEW", few)
    monkeypatch.setattr(minhash, "_BITS_AT_ONCE", bits)
    texts = _family(random.Random(4), [f"w{i % 97}" for i in range(150)], 70, 4)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    h, at = shingles(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    minima = minhash.signatures(h, at)
    keys = minhash.band_keys(minima).view(np.int64)
    sets = [set(h[a:b].tolist()) for a, b in zip(at, at[1:])]
    alike = {(i, j) for i in range(70) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}

    def compared(a, b, side, docs):
        rows = [(int(keys[d, band]), a, b, side(d), d, d, minima[d].tobytes(), h[at[d]:at[d + 1]].tobytes())
                for band in range(minhash.BANDS) for d in docs]
        links = minhash._links_of_tasks(pa.table(dict(zip(
            ("key", "a", "b", "side", "doc", "group", "minima", "shingles"), map(list, zip(*rows))))), 85)
        return {(max(p), min(p)) for p in zip(links["u"].to_pylist(), links["v"].to_pylist())}

    def reached(links):
        parent = list(range(70))
        for i, j in sorted(links):
            parent = [min(parent[i], parent[j]) if p in (parent[i], parent[j]) else p for p in parent]
        return parent

    whole = compared(0, 0, lambda d: 0, range(70))
    assert whole <= alike and reached(whole) == reached(alike) and len(alike) > 20
    halves = compared(0, 1, lambda d: d % 2, range(70))
    across = {(i, j) for i, j in alike if (i - j) % 2}
    assert halves <= across and reached(halves) == reached(across)


def test_blocks_of_a_bucket_meet(spark):
    rows = [(1, d, d if d % 3 else 0, 10) for d in range(60)] + [(2, d, 7, 10) for d in range(9)] \
        + [(3, d, d, 2) for d in range(4)] + [(4, d, d, 900) for d in range(3)]
    tasks = minhash._tasks(spark.createDataFrame(rows, "key long, doc long, group long, n long"), 8, 1000).collect()
    met = defaultdict(set)
    for r in tasks:
        met[r["key"], r["a"], r["b"]].add((r["side"], r["doc"]))
    pairs = Counter((k, *sorted((x, y))) for (k, a, b), m in met.items() for s, x in m for t, y in m
                    if (s, x) < (t, y) and (s != t or a == b))
    groups = {(k, d): g for k, d, g, _ in rows}
    want = {(k, x, y) for k, x, g, _ in rows for l, y, f, _ in rows if k == l and x < y and g != f}
    assert want <= set(pairs) and max(pairs.values()) == 1 and 2 not in {k for k, _, _ in met}
    assert all(len(m) < 40 for m in met.values()) and {r["small"] for r in tasks if r["key"] == 3} == {True}
    main = [p for p in pairs if groups[p[:2]] == groups[p[0], p[2]]]
    assert not main  # the largest group's blocks do not meet


def test_an_id_with_an_empty_text_too(spark):
    docs = _corpus(((20, 4),))
    docs += [(d, t) for d, _ in docs[:30] for t in ("", None)]
    assert len(_groups(spark, docs)) == len({d for d, _ in docs})
