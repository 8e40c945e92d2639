from pyspark.sql import functions as F

from talkmill.operators.curation import (domain_additions, domain_yield, math_signal,
                                         score_quality, train_quality_model)
from talkmill.sources.corpus import scan_corpus
from talkmill.sources.inspect import column_report, corpus_profile, file_profile, sample_preview

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_profile_and_preview(spark):
    df = scan_corpus(spark, DOCS)
    prof = {r.column_name: r for r in corpus_profile(df).collect()}
    assert prof["text"].spark_type == "string" and prof["doc_id"].n_rows == 200
    assert file_profile(df).first().n_rows == 200
    prev = sample_preview(df, n=3).collect()
    assert [r.row for r in prev] == [0, 1, 2]
    long = sample_preview(df).where("text_length > 1000").first()
    assert f" [+{long.text_length - 1000}] " in long.text_view


def test_column_report(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rep = column_report(e, key="vec_id")
    assert rep.count() == e.count() * 3
    emb = rep.where("column_name = 'embedding'").first()
    assert emb.spark_type == "array<float>" and emb.length > 0


def test_math_and_domains(spark):
    df = spark.createDataFrame([(1, "we have $x^2$ here"), (2, "plain"), (3, "3 + 4 = 7")],
                               "doc_id INT, text STRING")
    got = {r.doc_id: r.has_math for r in math_signal(df).collect()}
    assert got == {1: True, 2: False, 3: True}
    pages = spark.createDataFrame(
        [("http://a.example.com/1", True), ("https://A.example.com/2?x", False),
         ("http://b.org/1", False), ("http://b.org/2", False)], "url STRING, hit BOOLEAN")
    y = {r.host: (r.n_pages, r.n_hits, r.selected) for r in domain_yield(pages, F.col("hit")).collect()}
    assert y == {"a.example.com": (2, 1, True), "b.org": (2, 0, False)}
    add = [r.url for r in domain_additions(pages, F.col("hit")).collect()]
    assert add == ["https://A.example.com/2?x"]


def test_quality_model_scores(spark):
    docs = spark.read.parquet(DOCS)
    labelled = docs.join(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), "doc_id")
    model = train_quality_model(labelled, max_iter=5)
    scored = score_quality(model, docs.select("doc_id", "text"))
    r = scored.agg(F.min("quality_score").alias("lo"), F.max("quality_score").alias("hi")).first()
    assert 0.0 <= r.lo <= r.hi <= 1.0
    assert scored.count() == 200


def test_preview_prefers_token_column(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    p = str(tmp_path / "toks")
    import os
    os.makedirs(p)
    pq.write_table(pa.table({"input_ids": [[5, 6, 7], []], "text": ["abc def", "x"]}),
                   f"{p}/part-0.parquet")
    rows = sorted(sample_preview(scan_corpus(spark, p)).collect(), key=lambda r: r.row)
    assert (rows[0].token_count, rows[0].first_tokens) == (3, "5 6 7")
    assert (rows[1].token_count, rows[1].first_tokens) == (1, "x")
    assert rows[0].file.endswith("part-0.parquet")


def test_long_inline_math_and_odd_urls(spark):
    from talkmill.operators.curation import math_signal, url_host
    long = "$" + "x" * 5000 + "$"
    df = spark.createDataFrame([(long, "http://u:p@Ex.com:80/a"), ("a $ b", "no url"), ("3 + 4 $y$", None)],
                               "text STRING, url STRING")
    assert [r.math_hits for r in math_signal(df).collect()] == [1, 0, 2]
    assert [r.h for r in df.select(url_host().alias("h")).collect()] == ["ex.com", "", ""]


def test_preview_prefers_the_text_to_other_id_lists(spark):
    from talkmill.sources.inspect import sample_preview
    cols = "source_file STRING, source_row BIGINT, "
    t = spark.createDataFrame([("f", 0, "two words", [7, 8, 9])], cols + "text STRING, entity_ids ARRAY<INT>")
    assert sample_preview(t).first().first_tokens == "two words"
    n = spark.createDataFrame([("f", 0, [7, 8, 9])], cols + "entity_ids ARRAY<INT>")
    assert sample_preview(n).first().first_tokens == "7 8 9"
    k = spark.createDataFrame([("f", 0, "two words", [1, 2])], cols + "text STRING, tokens ARRAY<INT>")
    assert sample_preview(k).first().first_tokens == "1 2"


def test_cross_fitted_scores_equal_a_plain_fit(spark):
    """Each fold's model, fitted in plain Python on the other folds."""
    import math
    import re
    from collections import Counter

    from talkmill.operators.curation import cross_fitted_scores, fold_of
    from talkmill.operators.metrics import rank_auc
    texts = ["good fine text", "bad spam spam", "fine text again good", "spam bad words", None, "", "neutral thing",
             "good spam", "fine fine fine", "bad"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, "good spam")]
    labels = [(0, 1), (1, 0), (2, 1), (3, 0), (4, 1), (5, 0), (7, None), (8, 1), (9, 0), (55, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    fold = {r.doc_id: r.f for r in d.select("doc_id", fold_of("doc_id", 3).alias("f")).collect()}
    got = {r.doc_id: r for r in cross_fitted_scores(d, y).collect()}
    counts = {i: Counter() for i, _ in docs}
    for i, t in docs:
        counts[i].update(re.findall(r"\w+", t or ""))
    known = {i: q for i, q in labels if q is not None and i in counts}
    size = len(set().union(*(counts[i] for i in known)))
    assert sorted(got) == list(range(10))
    for i, own in counts.items():
        sides = [Counter(), Counter()]
        n = [1, 1]
        for j, q in known.items():
            if fold[j] != fold[i]:
                sides[q].update(counts[j])
                n[q] += 1
        odds = math.log(n[1] / n[0]) + sum(c * (
            math.log((sides[1][w] + 1) / (sides[1].total() + size)) - math.log((sides[0][w] + 1) / (sides[0].total() + size)))
            for w, c in own.items())
        assert got[i].fold == fold[i] and abs(got[i].log_odds - odds) < 1e-4
    rows = [(1.0, 1), (2.0, 0), (2.0, 1), (3.0, 1), (0.5, 0), (None, 1), (9.0, None)]
    r = rank_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert (r.n_pos, r.n_neg) == (3, 2) and abs(r.auc - (1 + 0.5 + 1 + 1 + 1) / 6) < 1e-6
    assert rank_auc(spark.createDataFrame([(1.0, 1)], "s double, y int"), "s", "y").first().auc is None


def test_only_distinct_words_of_blocks_meet_the_quality_model(spark):
    from talkmill.operators.curation import cross_fitted_scores
    d = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, None), (1, "c c")], "doc_id BIGINT, text STRING")
    y = spark.createDataFrame([(1, 1), (2, 0)], "doc_id BIGINT, quality INT")
    scored = cross_fitted_scores(d, y)
    assert "FlatMapCoGroupsInArrow" in scored._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in scored.collect()) == [1, 2, 3]
