import math
from collections import Counter

import pytest

from talkmill.operators import metrics as M

HYP = [("s1", 0, "A", "the cat sat on the mat"), ("s1", 0, "B", "a dog"),
       ("s2", 0, "A", "cat cat cat the"), ("s2", 0, "B", "nothing in common here at all")]
REF = {"s1": "The cat sat on a mat and the cat", "s2": "the cat is a cat"}


def py_counts(n_max=4):
    out = {}
    for k, _, g, h in HYP:
        hw, rw = h.lower().split(), REF[k].lower().split()
        for n in range(1, n_max + 1):
            hc = Counter(tuple(hw[i:i + n]) for i in range(len(hw) - n + 1))
            rc = Counter(tuple(rw[i:i + n]) for i in range(len(rw) - n + 1))
            m = sum(min(c, rc[x]) for x, c in hc.items())
            t = out.setdefault((g, n), [0, 0, 0])
            t[0] += m
            t[1] += max(0, len(hw) - n + 1)
            t[2] += max(0, len(rw) - n + 1)
    return out


@pytest.fixture()
def pairs(spark):
    rows = [(k, c, g, h, REF[k]) for k, c, g, h in HYP]
    return spark.createDataFrame(rows, "k STRING, c INT, g STRING, hyp STRING, ref STRING")


def test_overlap_counts_brute_force(pairs):
    got = {(r.g, r.n): [r.matches, r.hyp_grams, r.ref_grams]
           for r in M.overlap_counts(pairs, "hyp", "ref", "g").collect()}
    assert got == py_counts()


def test_bleu_formula(pairs):
    counts = M.overlap_counts(pairs, "hyp", "ref", "g")
    got = {r.g: r.bleu for r in M.bleu(counts, "g").collect()}
    c = py_counts()
    for g in ("A", "B"):
        if any(c[(g, n)][0] == 0 for n in range(1, 5)):
            assert got[g] == 0.0
        else:
            bp = min(1.0, math.exp(1 - c[(g, 1)][2] / c[(g, 1)][1]))
            want = bp * math.exp(sum(math.log(c[(g, n)][0] / c[(g, n)][1]) for n in range(1, 5)) / 4)
            assert got[g] == pytest.approx(round(want, 6))
    r = {(x.g, x.n): x for x in M.rouge_n(counts, "g").collect()}
    m, h, t = c[("A", 1)]
    assert r[("A", 1)].precision == pytest.approx(round(m / h, 6))
    assert r[("A", 1)].recall == pytest.approx(round(m / t, 6))


def avg_ranks(xs):
    order = sorted(range(len(xs)), key=lambda i: xs[i])
    ranks = [0.0] * len(xs)
    i = 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and xs[order[j + 1]] == xs[order[i]]:
            j += 1
        for k in range(i, j + 1):
            ranks[order[k]] = (i + j) / 2 + 1
        i = j + 1
    return ranks


def pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    cov = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    return cov / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))


def test_spearman_with_ties(spark):
    xs = [1, 2, 2, 3, 5, 5, 5, 8, 9, 1]
    ys = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]
    df = spark.createDataFrame(list(zip(xs, ys)), "x INT, y INT")
    got = M.spearman(df, "x", "y").first()
    assert got.n == 10
    assert got.spearman == pytest.approx(round(pearson(avg_ranks(xs), avg_ranks(ys)), 6))


def test_majority_ties_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "q INT, a STRING")
    got = {r.q: (r.majority, r.votes, r.n_votes) for r in M.majority_answer(df, "q", "a").collect()}
    assert got == {1: ("a", 2, 4), 2: ("z", 1, 1)}


def test_score_filter_and_histogram(spark):
    rows = [("c1", "m1", 5), ("c1", "m1", 3), ("c1", "m2", 1), ("c2", "m1", 4), ("c2", "m2", 4)]
    df = spark.createDataFrame(rows, "conv_key STRING, metric STRING, score INT")
    got = {r.conv_key: (r.mean_score, r.kept) for r in M.score_filter(df).collect()}
    assert got == {"c1": (2.5, False), "c2": (4.0, True)}
    h = {r.score_bin: r.share for r in M.score_histogram(M.score_filter(df)).collect()}
    assert sum(h.values()) == pytest.approx(1.0)


def test_scorecard_gain(spark):
    rows = [("base", "gsm8k", 12.96), ("base", "math", 4.92), ("syn", "gsm8k", 26.38),
            ("syn", "math", 7.22), ("syn", "arc", 70.0)]
    df = spark.createDataFrame(rows, "dataset STRING, task STRING, score DOUBLE")
    out = {(r.dataset, r.task_group): r for r in
           M.scorecard(df, M.task_groups({"math": ["gsm8k", "math"]}), baseline="base").collect()}
    assert out[("syn", "math")].avg_score == pytest.approx(16.8)
    assert out[("syn", "math")].gain == pytest.approx(16.8 - 8.94)


def test_style_length_with_median(spark):
    rows = [("a", 1, 0, t) for t in (10, 20, 30, 40, 50)] + [("b", 2, 1, 7)]
    df = spark.createDataFrame(rows, "prompt_style STRING, sample_index INT, prompt_ord INT, "
                                     "conversation_tokens INT")
    got = {r.prompt_style: r for r in M.style_length(df, approx_median=True).collect()}
    assert got["a"].median_tokens == 30 and got["a"].avg_tokens == 30.0 and got["b"].n_dialogues == 1


def test_scale_settings():
    from talkmill.session import scale_settings
    conf = scale_settings(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_settings(10 * 2**20, 8)["spark.sql.shuffle.partitions"]) == 24


def test_styles_come_from_the_data_and_may_repeat(spark):
    rows = [("rephrase", "the cat", "the cat sat"), ("rephrase", "the cat sat", "the cat sat")]
    df = spark.createDataFrame(rows, "g STRING, hyp STRING, ref STRING")
    got = {r.n: (r.matches, r.hyp_grams, r.ref_grams) for r in M.overlap_counts(df, "hyp", "ref", "g").collect()}
    assert got[1] == (5, 5, 6) and got[2] == (3, 3, 4)


def test_spearman_with_a_hot_value_and_strings_of_ties(spark):
    df = spark.range(4000).selectExpr("int(id % 2) AS x", "id AS y")
    assert M.spearman(df, "x", "y").first().n == 4000
    assert M.spearman(df.limit(0), "x", "y").first().n == 0


def test_overlap_counts_of_a_fan_out_with_words_made_before_it(spark):
    from pyspark.sql import functions as F
    rows = [("the cat the cat sat", 0), ("", 1), (None, 2), ("b b b b", 3), ("b b b b", 4)]
    chunks = spark.createDataFrame(rows, "ref STRING, k INT").coalesce(1)
    hyps = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(h).alias("hyp")) for g, h in (
        ("x", "the cat b b"), ("y", ""), (None, "sat the cat"), ("x", "b b b b b"))])
    early = chunks.withColumn("w", M.word_numbers("ref")).select("*", F.inline(hyps))
    got = sorted(M.overlap_counts(early, "hyp", "ref", "g", ref_words="w").collect(), key=str)
    late = M.overlap_counts(chunks.select("*", F.inline(hyps)).orderBy(F.rand(1)), "hyp", "ref", "g").collect()
    assert got == sorted(late, key=str)
    by = {(r.g, r.n): (r.matches, r.hyp_grams, r.ref_grams) for r in got}
    assert by["x", 1] == (2 + 2 * 2 + 2 * 4, 5 * 4 + 5 * 5, 2 * (5 + 4 + 4))
    assert by["x", 4] == (2, 5 * 1 + 5 * 2, 2 * (2 + 1 + 1)) and by["y", 1] == (0, 0, 13)
    assert by[None, 2] == (1, 10, 10)
