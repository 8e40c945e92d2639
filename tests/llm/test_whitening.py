import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.llm import queries, whitening


@given(st.integers(1, 9), st.integers(0, 9), st.integers(0, 10 ** 6), st.booleans())
@settings(max_examples=100, deadline=None)
def test_eigenvalues_and_components(size, rank, seed, graded):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(size, min(rank, size)))
    if graded:
        base *= 10.0 ** -np.arange(base.shape[1])
    a = base @ base.T
    factor = whitening.pivoted_cholesky(a)
    np.testing.assert_allclose(factor @ factor.T, a, atol=1e-12 * max(1, np.abs(a).max()))
    rotated = whitening.one_sided_jacobi(factor)
    norms = np.sqrt((rotated ** 2).sum(axis=0))
    wanted = np.linalg.eigvalsh(a)[::-1][:len(norms)]
    np.testing.assert_allclose(norms ** 2, wanted, rtol=1e-10, atol=1e-12 * max(1, np.abs(a).max()))
    unit = rotated / norms
    np.testing.assert_allclose(unit.T @ unit, np.eye(len(norms)), atol=1e-10)
    assert (np.diff(norms) <= 1e-12).all()


def test_factor_is_triangular_in_the_order_of_its_pivots():
    a = np.cov(np.random.default_rng(0).normal(size=(7, 50)) * np.arange(1, 8)[:, None])
    factor = whitening.pivoted_cholesky(a)
    order = np.argsort((factor != 0).argmin(axis=1) + 8 * (factor != 0).all(axis=1))
    assert np.allclose(factor[order], np.tril(factor[order])) and factor.shape == (7, 7)


def _brute(rows, k=8):
    """ids, whole sums and numpy's eigenvectors of all vectors at once."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    y = np.array((n * x - s) / n, float)
    e, u = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in kept], n, deviation, y, e[::-1][:k], u[:, ::-1][:, :k], e.sum()


def _check(rows, found, k=8):
    ids, n, deviation, y, e, u, trace = _brute(rows, k)
    k = int((e > 1e-9 * e.max()).sum())
    got = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / trace, rel=1e-9)
        got.setdefault((r["vec_id"], int(r["deviation"])), []).append((r["component"], r["whitened"]))
    assert sorted(map(str, got)) == sorted({str((i, int(d))) for i, d in zip(ids, deviation)})
    w = y @ u[:, :k] / np.sqrt(e[:k])
    signs = None
    for i, d, row in zip(ids, deviation, w):
        own = dict(sorted(got[(i, int(d))]))
        assert sorted(own) == list(range(1, k + 1))
        own = np.array([own[c] for c in range(1, k + 1)])
        if signs is None:
            signs = np.sign(own * row)
        np.testing.assert_allclose(own * signs, row, atol=1e-8)
    assert len(found) == len(ids) * k


@pytest.fixture()
def table(spark):
    rng = np.random.default_rng(11)
    mix = rng.normal(size=(12, 12)) * 2.0 ** -np.arange(12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(300, 12)) @ mix)]
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 11), (903, [float("nan")] * 12),
             (904, [float("inf")] * 12), (None, [0.25] * 12), (5, rows[5][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def test_equals_numpy(table):
    rows, df = table
    found = whitening.whiten(df.selectExpr("*", "1 as n", "'x' as v", "2 as id"), "vec_id", "embedding").collect()
    _check(rows, found)


def test_odd_tables(spark, table):
    rows, df = table
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(df.limit(0), "vec_id", "embedding").count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [float("nan")])], schema),
                            "vec_id", "embedding").count() == 0
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    assert whitening.whiten(equal, "vec_id", "embedding").count() == 0
    # of two dimensions that move together only one component is left; other lengths take no part
    line = [(i, [i / 4, -i / 2]) for i in range(9)] + [(100, [1.0])]
    out = whitening.whiten(spark.createDataFrame(line, schema), "vec_id", "embedding").collect()
    assert len(out) == 9 and {r["component"] for r in out} == {1} and out[0]["explained"] == pytest.approx(1)


def test_numbers_that_are_no_longs_and_long_sums(spark):
    big = 2.0 ** 46
    rows = [(i, [big * (i - 3), float(i * i)]) for i in range(8)]
    more = spark.createDataFrame([*rows, (50, [1e30, 0.0])], "vec_id long, embedding array<double>")
    found = whitening.whiten(more, "vec_id", "embedding").collect()
    ids, n, deviation, *_ = _brute(rows)
    assert {(r["vec_id"], int(r["deviation"])) for r in found} == set(zip(ids, map(int, deviation)))


def test_query(spark, table, tmp_path):
    rows, df = table
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.op12_whitening(spark, str(tmp_path))
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                "whitened": "double", "explained": "double", "identity_error": "double"}
    _check(rows, out.collect())
