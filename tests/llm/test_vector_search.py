import numpy as np
import pytest

from talkmill.llm import exact_topk as et
from talkmill.llm import vectors as vs
from talkmill.llm.exact_topk import exact_topk
from talkmill.llm.rabitq import build_index, search


def _table(spark, x, extra=()):
    rows = [(i, [float(c) for c in v], "n") for i, v in enumerate(x)] + [(*r, "n") for r in extra]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def _brute(ids, x, queries, k, measure):
    out = {}
    for q in queries:
        s = [(-measure(x[q], x[j]), ids[j]) for j in range(len(ids)) if ids[j] != ids[q]]
        out[ids[q]] = [(v, -s_) for s_, v in sorted(s)[:k]]
    return out


def _got(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


ODD = [(900, None), (901, [0.5] * 7), (902, [float("nan")] + [0.1] * 7), (903, [None] + [0.1] * 7),
       (904, [float("inf")] + [0.1] * 7), (905, []), (None, [0.1] * 8)]


@pytest.fixture()
def points():
    x = np.random.default_rng(0).normal(size=(400, 8)).astype(np.float32)
    x[100:250] = x[3]  # a hot vector: ties broken by id
    return x


@pytest.mark.parametrize("k", [3, 10])
def test_exact_topk_equals_brute_force(spark, points, k, monkeypatch):
    monkeypatch.setattr(et, "SLACK", 1)  # more refinement rounds
    df = _table(spark, points, ODD)
    got = _got(exact_topk(df, df.where("vec_id % 20 = 0"), k, "vec_id", "embedding").collect())
    whole = np.floor(points.astype(float) * 1024).astype(int)
    want = _brute(list(range(400)), whole, range(0, 400, 20), k, lambda a, b: int(a @ b))
    assert got == want


def test_exact_topk_in_several_query_batches(spark, points, monkeypatch):
    df = _table(spark, points)
    one = _got(exact_topk(df, df.where("vec_id % 20 = 0"), 5, "vec_id", "embedding").collect())
    monkeypatch.setattr(vs, "QUERY_BATCH", 4)
    assert _got(exact_topk(df, df.where("vec_id % 20 = 0"), 5, "vec_id", "embedding").collect()) == one


def test_fewer_candidates_than_k_and_empty_tables(spark, points):
    df = _table(spark, points[:4])
    assert len(exact_topk(df, df.where("vec_id = 0"), 10, "vec_id", "embedding").collect()) == 3
    assert len(search(build_index(df, "vec_id", "embedding"), df.where("vec_id = 0"), 20,
                      "vec_id", "embedding").collect()) == 3
    none = df.limit(0)
    assert exact_topk(none, none, 10, "vec_id", "embedding").count() == 0
    assert search(build_index(none, "vec_id", "embedding"), none, 5, "vec_id", "embedding").count() == 0


def test_repeated_ids_are_candidates_each(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.0]), (2, [0.25, 0.0])], "vec_id long, embedding array<double>")
    got = exact_topk(df, df.where("vec_id = 1"), 5, "vec_id", "embedding").orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 1024 * 512), (2, 1024 * 256)]


def test_scores_too_large_for_exact_doubles_raise(spark):
    df = spark.createDataFrame([(0, [1e12, 0.0]), (1, [1e12, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2\\*\\*53"):
        exact_topk(df, df, 1, "vec_id", "embedding")


def test_rotated_codes_recall_scores_and_odd_rows(spark):
    x = np.random.default_rng(1).normal(size=(3000, 32)).astype(np.float32)
    x[7] = 0
    df = _table(spark, x, [(5000, None), (5001, [0.5] * 7), (5002, [None] + [0.1] * 31)])
    index = build_index(df, "vec_id", "embedding")
    assert index.table.count() == 2999  # every vector but the zero one and the odd ones
    got = _got(search(index, df.where("vec_id % 100 = 0"), 20, "vec_id", "embedding").collect())
    ids = [i for i in range(3000) if i != 7]
    want = _brute(ids, x[ids].astype(float), [ids.index(q) for q in range(0, 3000, 100)], 20, lambda a, b: float(a @ b))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, pairs in got.items():
        assert [s for _, s in pairs] == pytest.approx([float(x[q].astype(float) @ x[v].astype(float)) for v, _ in pairs])
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


def test_queries_beyond_single_precision_find_their_neighbours(spark):
    x = np.random.default_rng(5).normal(size=(60, 8))
    x[0] *= 1e39
    x[20] *= 1e-42
    df = spark.createDataFrame([(i, [float(c) for c in v], "n") for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, code string")
    got = _got(search(build_index(df, "vec_id", "embedding"), df.where("vec_id % 20 = 0"), 5, "vec_id", "embedding").collect())
    want = _brute(list(range(60)), x, [0, 20, 40], 5, lambda a, b: float(a @ b))
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
