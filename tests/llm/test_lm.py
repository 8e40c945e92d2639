import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.llm import attention, lm
from talkmill.llm.common import word_hashes
from talkmill.llm.subwords import BytePairEncoder


@pytest.fixture(scope="module")
def bpe(vocabularies):
    return vocabularies("byte_bpe_50k.json")


def _base(docs, trains):
    words = {d: (t or "").encode().lower().split() + [b"\x00 end"] for d, t in docs}
    c = Counter(w for d in words if d in trains for w in words[d])
    n, v = sum(c.values()), len(c)
    return {d: (len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for d, w in words.items()}


def test_base_scores_and_counts(odd_docs, bpe, monkeypatch):
    monkeypatch.setattr(lm, "SLICES", 1)
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = lm.score(docs, "doc_id", "text", F.col("doc_id") % 3 != 2, bpe).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = _base(texts, {d for d, _ in texts if d % 3 != 2})
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_special_strings_are_words_like_others(spark, bpe):
    end = "<|endoftext|>"
    texts = [f"one two {end} three", end, f"un{end}known words one", f"{end}{end} zwei", "one three words zwei two",
             f"{end.upper()} x{end}", "a b c d e f g h"]
    docs = list(enumerate(texts))
    rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), "doc_id", "text",
                    F.col("doc_id") % 3 != 2, bpe).collect()
    want = _base(docs, {d for d, _ in docs if d % 3 != 2})
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_odd_rows_without_training_and_empty_table(odd_docs, no_docs, bpe):
    assert lm.score(no_docs, "doc_id", "text", F.lit(True), bpe).count() == 0
    rows = lm.score(odd_docs, "doc_id", "text", F.lit(None).cast("boolean"), bpe).collect()
    assert len(rows) == 12 and {r["train_tokens"] for r in rows} == {0}
    assert all(math.isfinite(r["score"]) for r in rows)


def test_model_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    counts = np.append(rng.integers(0, 50, 400) * (rng.random(400) < 0.6), 30)
    classes = lm.Classes(counts)
    assert set(classes.output) == set(range(lm.OUTPUTS)) and classes.input.max() < lm.INPUTS
    seen = np.zeros(int((counts > 0).sum()) + 1, bool)
    seen[classes.used] = True
    assert seen.all()


def test_in_class_probabilities_sum_to_one(spark, bpe):
    docs = spark.createDataFrame([(i, "some words that come again and again " * (i + 1)) for i in range(6)],
                                 "doc long, text string").withColumn("trains", F.lit(True))
    blocks = lm._blocks(docs, bpe, 12)
    counts = lm._token_counts(blocks, 50257)
    classes = lm.Classes(counts)
    table = lm._pair_table(blocks, counts, classes)
    assert np.exp(table.prior.astype(float)).sum(axis=1) == pytest.approx(np.ones(lm.INPUTS), rel=1e-4)
    held = set()
    for row in range(lm.INPUTS):
        p = 10.0 ** table.log10(np.full(len(counts), row), classes.used).astype(float)
        sums = np.bincount(classes.output, p, minlength=lm.OUTPUTS)
        assert sums[sorted(set(classes.output))] == pytest.approx(np.ones(len(set(classes.output))), rel=1e-4)
        held.update(np.flatnonzero(p > 0.9).tolist())
    assert len(held) > 4  # what always follows is likely


def test_pair_table_equals_a_dense_one():
    rng = np.random.default_rng(6)
    counts = np.append(rng.integers(0, 50, 300) * (rng.random(300) < 0.7), 30)
    classes = lm.Classes(counts)
    columns = int((counts > 0).sum()) + 1
    keys = np.sort(rng.choice(lm.INPUTS * columns, 20000, replace=False))
    times = rng.integers(1, 100, len(keys))
    table = lm.PairTable(counts, classes, keys, times)
    pairs = np.zeros(lm.INPUTS * columns)
    pairs[keys] = times
    pairs = pairs.reshape(lm.INPUTS, columns)
    of_class = np.bincount(classes.output, counts, minlength=lm.OUTPUTS)
    members = np.bincount(classes.output, minlength=lm.OUTPUTS)
    row, token = rng.integers(0, lm.INPUTS, 5000), rng.integers(0, len(counts), 5000)
    got = table.log10(row, classes.used[token])
    seen = {c: k for c, k in zip(classes.used, classes.output)}
    of_column = np.array([seen.get(c, lm.OUTPUTS - 1) for c in range(columns)])
    for r, t, value in zip(row[:500], token[:500], got):
        k = classes.output[t]
        alone = (counts[t] + 0.01) / (of_class[k] + 0.01 * members[k])
        if not counts[t]:  # unseen tokens share a column, and one probability
            k = of_column[classes.used[t]]
            alone = 0.01 / (of_class[k] + 0.01 * members[k])
        total = pairs[r, of_column == k].sum()
        want = np.log10((pairs[r, classes.used[t]] + lm.SMOOTH * alone) / (total + lm.SMOOTH))
        assert value == pytest.approx(want, abs=1e-4)


def test_scoring_equals_the_training_pass():
    """Overlapping half windows give what a window gives at places whose
    whole context lies in it."""
    p = attention.initial(30, 7)
    rng = np.random.default_rng(1)
    prior = rng.normal(size=(30, 7)).astype(np.float32)
    counts = np.array([1, 5, 16, 17, 32, 100])
    x, y = rng.integers(0, 30, counts.sum()), rng.integers(0, 7, counts.sum())
    got = attention.Scorer(p, prior).log_probabilities(x, y, counts)
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, n in enumerate(counts):
        for t in range(n):
            begin = max(0, (t // attention.HALF - 1) * attention.HALF)  # the place's context
            window = np.zeros((1, attention.WINDOW), int)
            goal = np.zeros((1, attention.WINDOW), int)
            own = slice(at[i] + begin, at[i] + t + 1)
            window[0, :t + 1 - begin], goal[0, :t + 1 - begin] = x[own], y[own]
            assert got[at[i] + t] == pytest.approx(_reference(p, prior, window, goal, t - begin), abs=1e-4)


def _reference(p, prior, x, y, t):
    e = p["embed"][x[0, :t + 1]].astype(float)
    s = (e[t] @ p["q"]) @ (e @ p["k"]).T / np.sqrt(attention.WIDTH) + p["far"][t - np.arange(t + 1)]
    a = np.exp(s - s.max())
    z = (a / a.sum()) @ (e @ p["v"])
    h = np.maximum(e[t] @ p["own"] + z @ p["seen"] + p["hidden"], 0)
    o = h @ p["out"] + p["bias"] + prior[x[0, t]]
    return o[y[0, t]] - o.max() - np.log(np.exp(o - o.max()).sum())


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in attention.initial(12, 5).items()}
    x, y = rng.integers(0, 12, (3, attention.WINDOW)), rng.integers(0, 5, (3, attention.WINDOW))
    prior = rng.normal(size=(12, 5))
    _, g = attention.gradients(p, prior, x, y)
    for k in p:
        at = tuple(rng.integers(0, n) for n in p[k].shape)
        own = p[k][at]
        p[k][at] = own + 1e-5
        up = attention.gradients(p, prior, x, y)[0]
        p[k][at] = own - 1e-5
        down = attention.gradients(p, prior, x, y)[0]
        p[k][at] = own
        assert (up - down) / 2e-5 == pytest.approx(g[k][at], abs=1e-4)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 8, (256, attention.WINDOW))
    y = np.concatenate([x[:, :1] * 0, x[:, :-1]], axis=1) % 4  # the last but one input class decides
    adam = attention.Adam(attention.initial(8, 4), np.zeros((8, 4), np.float32), 1e-2)
    losses = [adam.step(x[i % 4 * 64:i % 4 * 64 + 64], y[i % 4 * 64:i % 4 * 64 + 64]) for i in range(240)]
    assert np.mean(losses[-8:]) < 0.5 * np.mean(losses[:8])


def test_windows_cover_every_training_token_in_one_round(spark, bpe):
    sizes = [0, 3, 31, 32, 40, 700, 5000]
    docs = spark.createDataFrame([(i, "word " * n) for i, n in enumerate(sizes)], "doc long, text string") \
        .withColumn("trains", F.col("doc") != 4)
    rows = lm._blocks(docs, bpe, 12).toArrow().to_batches()
    classes = lm.Classes(np.arange(50258)[::-1])
    wanted, got = Counter(), Counter()

    def add(part):
        last, nxt, _ = part.pairs(50257, True)
        wanted.update(zip(classes.input[last].tolist(), classes.output[nxt].tolist()))
        x, y, real, _ = lm._windows(part, 50257, classes)
        for a, b, n in zip(x.tolist(), y.tolist(), real.tolist()):
            got.update(zip(a[:n], b[:n]))

    lm._each(add, rows)
    assert got == wanted and sum(got.values()) > 5000


def test_padding_has_no_effect():
    rng = np.random.default_rng(5)
    p, prior = attention.initial(12, 5), rng.normal(size=(12, 5)).astype(np.float32)
    x, y = rng.integers(0, 12, (3, attention.WINDOW)), rng.integers(0, 5, (3, attention.WINDOW))
    real = np.array([attention.WINDOW, 1, 9])
    loss, g = attention.gradients(p, prior, x, y, real)
    x[1, 1:], y[1, 1:], x[2, 9:], y[2, 9:] = 3, 4, 5, 0
    again, g2 = attention.gradients(p, prior, x, y, real)
    assert again == pytest.approx(loss, rel=1e-6)
    assert all(g2[k] == pytest.approx(g[k], abs=1e-6) for k in g)


def test_short_texts_train_the_attention(spark, bpe):
    docs = spark.createDataFrame([(i, "a b a b a b") for i in range(200)], "doc long, text string") \
        .withColumn("trains", F.lit(True))
    blocks = lm._blocks(docs, bpe, 12)
    counts = lm._token_counts(blocks, 50257)
    classes = lm.Classes(counts)
    table = lm._pair_table(blocks, counts, classes)
    params = lm._train(blocks, counts, classes, table.prior)
    start = attention.initial(lm.INPUTS, lm.OUTPUTS)
    assert not np.array_equal(params["out"], start["out"])
    assert all(np.isfinite(v).all() for v in params.values())


def test_warm_up_draws_leave_a_bounded_number_of_windows():
    rng = np.random.default_rng(8)
    for sizes in (np.full(100_000, 3), np.full(20_000, 1000), rng.integers(1, 5, 10)):
        windows = int((-(-sizes // attention.WINDOW)).sum())
        upto = lm._warm_up_draws(np.array([sizes.sum() - len(sizes), len(sizes)]))
        kept = int((rng.integers(0, 1 << 64, windows, dtype=np.uint64) <= upto).sum())
        assert min(windows, lm.WARM_UP) <= kept <= 4.5 * lm.WARM_UP


def test_gradients_and_scores_in_parts_equal_those_of_single_windows():
    """Rows are multiplied PART at a time; logits past LIMIT are held."""
    rng = np.random.default_rng(5)
    p = {k: v.astype(np.float64) for k, v in attention.initial(40, 9).items()}
    n = 2 * attention.PART // attention.WINDOW
    x, y = rng.integers(0, 40, (n, attention.WINDOW)), rng.integers(0, 9, (n, attention.WINDOW))
    prior, space = rng.normal(size=(40, 9)), attention.Space()
    loss, g = attention.gradients(p, prior, x, y, space=space)
    g = {k: v.copy() for k, v in g.items()}
    ones = [attention.gradients(p, prior, x[i:i + 1], y[i:i + 1], space=space) for i in range(n)]
    assert loss == pytest.approx(np.mean([one for one, _ in ones]))
    for k in p:
        assert g[k] == pytest.approx(np.mean([one[k] for _, one in ones], axis=0), abs=1e-9)
    far = np.where(np.arange(9) == 3, 900.0, -900.0) * np.ones((40, 1))
    loss, g = attention.gradients(p, far, x, y)
    assert np.isfinite(loss) and all(np.isfinite(v).all() for v in g.values())
    logs = attention.Scorer(attention.initial(40, 9), far.astype(np.float32)).log_probabilities(
        x.ravel(), y.ravel(), np.full(n, attention.WINDOW))
    assert np.isfinite(logs).all()


def test_windows_are_made_for_the_chosen_only():
    counts = np.arange(1, 31)
    classes = lm.Classes(counts)
    b = lm.Slice([1, 2, 3], np.array([True, False, True]), np.array([70, 50, 200]), np.arange(320) % 29)
    x, y, real, draw = lm._windows(b, 29, classes)
    some = np.array([4, 0, 7])
    for got, all_ in zip(lm._windows(b, 29, classes, lambda d: some), (x, y, real, draw)):
        assert (got == all_[some]).all()


def _odd_texts(n):
    rng = np.random.default_rng(n)
    bits = [" ", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x85", "\x1c", "\x7f", "a", "B", "don't", "'s", "12", "é",
            "ß", "中", "文", "à", "😀", "<|endoftext|>", "<|endof", "text|>", ".", "!?", "_", " ever", " after", " one", "one"]
    return [None if rng.random() < 0.05 else "".join(rng.choice(bits, int(rng.choice([0, 1, 2, 5, 40])))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 40, 400])
def test_units_give_the_ids_and_words_of_whole_texts(bpe, n, monkeypatch):
    """Only distinct units between texts' cuts are encoded."""
    encoder, asked = BytePairEncoder.of(bpe), []
    monkeypatch.setattr(encoder, "encode", lambda t, own=encoder.encode: asked.append(len(t)) or own(t))
    morse = "a"
    for _ in range(11):  # equal sums of powers
        morse += morse.translate(str.maketrans("ab", "ba"))
    texts = _odd_texts(n) + ["again and again and again " * 50] * 20 + [morse, morse.translate(str.maketrans("ab", "ba"))]
    offsets = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])])
    data = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8)
    ids, sizes, keys, places, lengths = lm._tokenised(data, offsets, encoder)
    assert sum(asked) < len(data) - 20_000
    want = [encoder.encode(t or "") for t in texts]
    assert ids.tolist() == np.concatenate(want).tolist() and sizes.tolist() == [len(x) for x in want]
    words, at = word_hashes(data, offsets)
    assert (keys[places] == words).all() and (np.diff(keys.astype(object)) > 0).all()
    assert lengths.tolist() == np.diff(at).tolist()
    empty = lm._tokenised(data[:0], np.zeros(4, np.int64), encoder)
    assert [len(x) for x in empty] == [0, 3, 0, 0, 3]


def test_ids_are_not_shuffled_and_words_not_hashed_again(odd_docs, bpe, monkeypatch):
    """By block only the words' places and a few numbers a document meet."""
    out = lm.score(odd_docs, "doc_id", "text", F.col("doc_id") % 3 != 2, bpe)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2
    for side in plan.split("Join")[1:]:
        assert "ids#" not in side.splitlines()[1]
    assert any("Project" in line and "ids#" in line for line in plan.splitlines())


def test_windows_of_few_and_of_many_documents_are_the_same():
    """A window doesn't depend on the texts around it, its padding included."""
    counts = np.arange(1, 31)
    classes, rng = lm.Classes(counts), np.random.default_rng(2)
    sizes = np.array([0, 70, 31, 32, 5, 64, 1])
    parts = [rng.integers(0, 29, n) for n in sizes]
    trains = np.array([True, True, False, True, True, True, True])
    whole = lm._windows(lm.Slice(list(range(7)), trains, sizes, np.concatenate(parts)), 29, classes)
    ones = [lm._windows(lm.Slice([i], trains[i:i + 1], sizes[i:i + 1], parts[i]), 29, classes) for i in range(7)]
    for got, want in zip(whole, zip(*ones)):
        assert (got == np.concatenate(want)).all()


def test_pairs_are_found_however_full_their_buckets_are(monkeypatch):
    rng = np.random.default_rng(7)
    counts = np.append(rng.integers(1, 50, 60), 30)
    classes, columns = lm.Classes(counts), 62
    keys = np.sort(rng.choice(lm.INPUTS * columns, 3000, replace=False))
    keys = keys[keys % columns < columns - 1]  # what was never seen is in no pair
    times = rng.integers(1, 100, len(keys))
    row, column = (t.ravel() for t in np.meshgrid(np.arange(lm.INPUTS), np.arange(columns)))
    want = lm.PairTable(counts, classes, keys, times).log10(row, column)
    monkeypatch.setattr(lm.PairTable, "_bucket", lambda self, key: (key % np.uint32(2)))
    assert (lm.PairTable(counts, classes, keys, times).log10(row, column) == want).all()
